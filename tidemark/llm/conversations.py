"""Repair of damaged conversations at the least cost, with the least of the cheapest edit lists.

A conversation's rows pass through an automaton with the states start, after a system row, after a
user row, after an assistant row. An edit is a letter: K keeps a row, R gives it the role user or
assistant, D deletes it, I inserts an empty row. Every letter leads from a state to one state.

Cost. The rows of a conversation are cut into blocks of consecutive rows. A block is a matrix: the
least cost from each state before it to each state behind it. The matrices of a conversation,
multiplied from its end in the (min, +) sense, give the cost still to come at every block, so even a
conversation with a third of all rows is worked on by many tasks.

Least audit. Inside a block the arcs on cheapest paths are known once the cost to come is. Their
nodes are ranked by prefix doubling: first by the least letter that can follow, then, round by
round, by audits of twice the length, from the rank of a node and that of the node its audit leads
to. A node takes the arc whose letter and target's rank are least (in this automaton a letter has
one target, so the letter decides). The doubled pointers then yield the letters in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches
from tidemark.session import settle

#: Rows of a conversation that one block holds (a power of two) and codes solved in one go.
BLOCK_BITS = 13
CODES_AT_ONCE = 1 << 16
WHITE = " \t\n\x0b\f\r"

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
FAR = 1 << 40
#: Costs of the edits, and what an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Letters in ASCII order; 0 is the end of an audit.
LETTERS = b"\0DIKR"
_D, _I, _K, _R = 1, 2, 3, 4
#: Where a user or assistant row leads (the other role is illegal there).
TURN = np.array([USER, USER, ASSISTANT, USER])
#: Where a kept row leads by state and role initial s, u, a, other; -1 is illegal.
KEPT = np.array([[SYSTEM, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSISTANT, -1],
                 [-1, USER, -1, -1]])
#: Cost to come at the end of a conversation: start and after an assistant row are complete.
AT_END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)


def _row_arcs() -> tuple[np.ndarray, np.ndarray]:
    """Cost and target by code, state and letter; a code is initial + 4 * (fine, cut, must go)."""
    cost = np.full((12, STATES, len(LETTERS)), FAR, np.int64)
    target = np.zeros((12, STATES, len(LETTERS)), np.int64)
    for code in range(12):
        initial, kind = code % 4, code // 4
        extra = TRUNCATED if kind == 1 else 0
        for state in range(STATES):
            cost[code, state, _D], target[code, state, _D] = DELETE, state
            if kind == 2:
                continue
            cost[code, state, _R], target[code, state, _R] = REROLE + extra, TURN[state]
            if KEPT[state, initial] >= 0:
                cost[code, state, _K] = KEEP + extra
                target[code, state, _K] = KEPT[state, initial]
    return cost, target


ARC_COST, ARC_TARGET = _row_arcs()


def _step_matrices() -> np.ndarray:
    """Least cost by code from the state before a row to the state behind it, inserts included."""
    inserts = np.full((STATES, STATES), FAR, np.int64)
    for state in range(STATES):
        at = state
        for n in range(3):
            inserts[state, at] = min(inserts[state, at], n * INSERT)
            at = TURN[at]
    step = np.full((12, STATES, STATES), FAR, np.int64)
    for code in range(12):
        for state in range(STATES):
            for letter in (_D, _K, _R):
                to = ARC_TARGET[code, state, letter]
                step[code, state, to] = min(step[code, state, to], ARC_COST[code, state, letter])
    return (inserts[None, :, :, None] + step[:, None, :, :]).min(axis=2).clip(max=FAR)


STEP = _step_matrices()


def costs_to_come(codes: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Cost to come before every row of the blocks and, as last row of each, ``ends``.

    ``ends`` has one column of costs per wanted end: blocks x states x ends. The result has
    ``sum(sizes + 1)`` rows of states x ends.
    """
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    out = np.empty((int((sizes + 1).sum()), *ends.shape[1:]), np.int64)
    out[starts + sizes] = ends
    order = np.argsort(-sizes, kind="stable")
    longest_first = sizes[order]
    for back in range(int(sizes.max(initial=0))):
        block = order[:np.searchsorted(-longest_first, -back)]  # those with more than `back` rows
        at = starts[block] + sizes[block] - back
        step = STEP[codes[first[block] + sizes[block] - 1 - back]]
        out[at - 1] = (step[..., None] + out[at][:, None]).min(axis=2).clip(max=FAR)
    return out


def _rank_pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return np.unique(first * (second.max(initial=0) + 1) + second, return_inverse=True)[1]


def least_audits(codes: np.ndarray, sizes: np.ndarray, ends: np.ndarray, last: np.ndarray,
                 entries: Sequence[tuple[int, int]]) -> tuple[list[bytes], np.ndarray]:
    """The least cheapest audit of ``(block, state)`` and the state it ends in, for all entries.

    ``ends`` are the costs to come behind each block, ``last`` tells the blocks that end their
    conversation.
    """
    come = costs_to_come(codes, sizes, ends[:, :, None])[:, :, 0]
    rows = len(come)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    inner = np.ones(rows, bool)
    inner[starts + sizes] = False
    code = np.zeros(rows, np.int64)
    code[inner] = codes
    # the arcs of node (row, state) by letter: target node, or -1 where it is not on a cheapest path
    target = np.full((rows, STATES, len(LETTERS)), -1, np.int64)
    below = np.minimum(np.arange(rows) + 1, rows - 1)
    for letter in (_D, _K, _R):
        to = ARC_TARGET[code, :, letter]
        fits = (ARC_COST[code, :, letter] + np.take_along_axis(come[below], to, 1) == come) \
            & inner[:, None] & (come < FAR)
        target[:, :, letter] = np.where(fits, below[:, None] * STATES + to, -1)
    goes_on = inner.copy()
    goes_on[starts + sizes] = last  # behind a block that is not the last another one takes over
    fits = (INSERT + come[:, TURN] == come) & goes_on[:, None] & (come < FAR)
    target[:, :, _I] = np.where(fits, np.arange(rows)[:, None] * STATES + TURN[None], -1)
    target = target.reshape(-1, len(LETTERS))
    nodes = len(target)
    here = np.arange(nodes)
    open_ = (target >= 0).any(axis=1)

    # prefix doubling: ranks of audits cut to 1, 2, 4 ... letters, and the nodes they lead to
    letter = np.where(open_, (target >= 0).argmax(axis=1), 0)
    rank, jump = letter, np.where(open_, target[here, letter], here)
    jumps = [jump]
    while open_[jump].any():
        rank = _rank_pairs(rank, rank[jump])
        jump = jump[jump]
        jumps.append(jump)
    # of its cheapest arcs a node takes the one whose letter and target's rank are least
    weight = np.arange(len(LETTERS)) * (int(rank.max(initial=0)) + 1) + rank[target]
    chosen = np.where(target >= 0, weight, np.iinfo(np.int64).max).argmin(axis=1)

    begin = np.array([starts[b] * STATES + s for b, s in entries], np.int64)
    owner = np.flatnonzero(open_[begin])
    at, place = begin[owner], np.zeros(len(owner), np.int64)
    for k, jump in enumerate(jumps):
        far = jump[at]
        more = open_[far]
        owner, place = np.append(owner, owner[more]), np.append(place, place[more] + (1 << k))
        at = np.append(at, far[more])
    order = np.lexsort((place, owner))
    text = np.frombuffer(LETTERS, np.uint8)[chosen[at[order]]].tobytes()
    cuts = np.searchsorted(owner[order], np.arange(len(begin) + 1))
    return ([text[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
            jumps[-1][begin] % STATES)


def _chunks(sizes: np.ndarray) -> Iterator[slice]:
    """Stretches of blocks of about CODES_AT_ONCE codes together."""
    turn = np.cumsum(sizes) // CODES_AT_ONCE
    cuts = [0, *(np.flatnonzero(np.diff(turn)) + 1), len(sizes)]
    yield from (slice(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a)


def _block_codes(blocks: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """``slice, codes, sizes`` of stretches of blocks; the code is in the low bits of ``codes``."""
    column = blocks.column("codes")
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False) & 15
    first = np.concatenate([[0], np.cumsum(sizes)])
    for part in _chunks(sizes):
        yield part, flat[first[part.start]:first[part.stop]], sizes[part]


def _longs(rows: Sequence[np.ndarray], width: int) -> pa.Array:
    """A list column out of matrices of ``width`` columns below each other."""
    whole = np.concatenate([np.empty((0, width), np.int64), *rows])
    return pa.ListArray.from_arrays(pa.array(np.arange(len(whole) + 1, dtype=np.int32) * width),
                                    pa.array(whole.ravel()))


def _summaries(blocks: pa.RecordBatch) -> pa.RecordBatch:
    """The cost matrix of every block, its illegal neighbours, its first and last initial."""
    unit = np.where(np.eye(STATES, dtype=bool), 0, FAR)
    costs, illegal, ends = [], [np.empty(0, np.int64)], []
    legal = np.zeros((4, 4), bool)
    legal[[0, 1, 2], [1, 2, 1]] = True  # su, ua, au
    for _, codes, sizes in _block_codes(blocks):
        come = costs_to_come(codes, sizes, np.broadcast_to(unit, (len(sizes), STATES, STATES)))
        starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        costs.append(come[starts].reshape(len(sizes), -1))
        initial, block = codes % 4, np.repeat(np.arange(len(sizes)), sizes)
        wrong = ~legal[initial[:-1], initial[1:]] & (block[1:] == block[:-1])
        illegal.append(np.bincount(block[1:][wrong], minlength=len(sizes)))
        last = np.cumsum(sizes) - 1
        ends.append(np.stack([initial[last - sizes + 1], initial[last]], axis=1))
    return pa.RecordBatch.from_arrays(
        [blocks.column("conv"), blocks.column("block"), _longs(costs, STATES * STATES),
         _longs(ends, 2), pa.array(np.concatenate(illegal))],
        names=["conv", "block", "costs", "ends", "illegal"])


def _records(rows: Sequence[tuple], **kinds: pa.DataType) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([] for _ in kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kind) for c, kind in zip(columns, kinds.values(), strict=True)],
        names=list(kinds))


def _chain_costs(convs: pa.RecordBatch) -> pa.RecordBatch:
    """Per block what the rest of its conversation costs from each state behind it; with the
    first block of a conversation its whole cost and its illegal neighbours."""
    rows = []
    for conv, parts in zip(convs.column("conv").to_pylist(), convs.column("parts").to_pylist(),
                           strict=True):
        bad = sum(p["illegal"] for p in parts) + sum(
            (a["ends"][1], b["ends"][0]) not in ((0, 1), (1, 2), (2, 1))
            for a, b in zip(parts, parts[1:], strict=False))
        come = AT_END.tolist()
        for k in range(len(parts) - 1, -1, -1):
            behind, costs = come, parts[k]["costs"]
            come = [min(costs[s * STATES + t] + behind[t] for t in range(STATES))
                    for s in range(STATES)]
            rows.append((conv, parts[k]["block"], behind, k == len(parts) - 1,
                         None if k else come[START], None if k else bad))
    return _records(rows, conv=pa.string(), block=pa.int64(), come=pa.list_(pa.int64()),
                    last=pa.bool_(), cost=pa.int64(), illegal=pa.int64())


def _solve(blocks: pa.RecordBatch) -> pa.RecordBatch:
    """The least audit of every block from every state before it, and the state behind."""
    audits, exits = [], []
    come = blocks.column("come").flatten().to_numpy(zero_copy_only=False).reshape(-1, STATES)
    last = blocks.column("last").to_numpy(zero_copy_only=False).astype(bool)
    for part, codes, sizes in _block_codes(blocks):
        entries = [(b, s) for b in range(len(sizes)) for s in range(STATES)]
        found, ends = least_audits(codes, sizes, come[part], last[part], entries)
        found = [audit.decode() for audit in found]
        audits += [found[i:i + STATES] for i in range(0, len(found), STATES)]
        exits.append(ends.reshape(-1, STATES))
    return pa.RecordBatch.from_arrays(
        [blocks.column("conv"), blocks.column("block"), pa.array(audits, pa.list_(pa.string())),
         _longs(exits, STATES)], names=["conv", "block", "audits", "exits"])


def _chain_audits(convs: pa.RecordBatch) -> pa.RecordBatch:
    """Per block its audit from the state in which the blocks before it end."""
    rows = []
    for conv, parts in zip(convs.column("conv").to_pylist(), convs.column("parts").to_pylist(),
                           strict=True):
        state = START
        for part in parts:
            rows.append((conv, part["block"], part["audits"][state]))
            state = part["exits"][state]
    return _records(rows, conv=pa.string(), block=pa.int64(), audit=pa.string())


class _Script:
    """Writes a repaired conversation into a digest, row by row."""

    def __init__(self) -> None:
        self.digest, self.state, self.lines = hashlib.sha256(), START, 0
        self.audit, self.at, self.tail = "", 0, 0

    def follow(self, audit: str) -> None:
        """The audit of the rows that come next."""
        self.audit, self.at, self.tail = audit, 0, len(audit.rstrip("I"))

    def row(self, role: bytes, text: bytes) -> None:
        self._insert()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = int(KEPT[self.state, b"sua".index(role[:1])])
            self._line(role, text)
        elif letter == "R":
            self._turn(text)
        if self.at == self.tail:
            self._insert()

    def _insert(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self._turn(b"")

    def _turn(self, text: bytes) -> None:
        self.state = int(TURN[self.state])
        self._line(b"user" if self.state == USER else b"assistant", text)

    def _line(self, role: bytes, text: bytes) -> None:
        self.digest.update((b"\n" if self.lines else b"") + role + b":" + text)
        self.lines += 1


def _digests(rows: DataFrame) -> DataFrame:
    """``conv, repaired_sha256`` out of rows sorted by conversation and place, the audit of each
    block ahead of its rows. A digest runs along the text, so one task streams a conversation; it
    holds the audit of one block and a batch of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, script = None, None
        for batch in batches:
            done = []
            for key, audit, role, text in zip(
                    batch.column("conv").to_pylist(), batch.column("audit").to_pylist(),
                    batch.column("role").cast(pa.binary()).to_pylist(),
                    batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                if key != conv:
                    if script:
                        done.append((conv, script.digest.hexdigest()))
                    conv, script = key, _Script()
                if audit is not None:
                    script.follow(audit)
                else:
                    script.row(role, text)
            yield _records(done, conv=pa.string(), repaired_sha256=pa.string())
        if script:
            yield _records([(conv, script.digest.hexdigest())], conv=pa.string(),
                           repaired_sha256=pa.string())
    return rows.mapInArrow(run, "conv string, repaired_sha256 string")


def conversation_key(conv: Column) -> Column:
    """A conversation's name without nulls."""
    return F.when(conv.isNull(), "").otherwise(F.concat(F.lit("="), conv.cast("string")))


def damage(table: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> DataFrame:
    """``conv_id, turn, role, text, copy`` after a damage that the key of a row decides.

    ``crc32("conv:turn") % 20``: 0 drops the row, 1 empties its text, 2 removes its characters
    ``.!?``, 3 repeats it (``copy`` 0 and 1), 4 makes it a user's. A null is one space.
    """
    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(filled(conv), F.lit(":"), filled(turn))) % 20
    named = table.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
                         filled(role).alias("role"), filled(text).alias("text"),
                         fate.alias("fate"))
    copies = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return named.filter("fate <> 0").select(
        "conv_id", "turn",
        F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fate") == 1, "")
        .when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
        .alias("text"), F.explode(copies).alias("copy"))


def _in_order(rows: DataFrame) -> DataFrame:
    """The rows with ``conv, id``: ids grow along conversation, turn, role and text.

    Settled, so that every reader sees the same ids. Ranges are cut on the whole order down to a
    row's own number, so neither a conversation nor a repeated row fills one of them.
    """
    wide = rows.select(
        conversation_key(F.col("conv_id")).alias("conv"), "turn", "role", "text",
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
        .alias("mark"), F.monotonically_increasing_id().alias("tie"))
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "mark", "tie"]
    return settle(wide.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("id", F.monotonically_increasing_id()).drop("tie"), "rows")


def repair(rows: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """``conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` per
    conversation of ``conv_id, turn, role, text`` (the last two without nulls).

    Rows are taken by turn, nulls first; rows of one turn by role, then by a digest of role and
    text. A row's first fault counts: blank (nothing but ASCII white space), duplicate (role and
    text occur earlier), truncated (the last other character is none of ``.!?``). ``illegal``
    counts neighbours whose role initials are not su, ua or au, ``gaps`` the turns missing between
    the first and the last. Keeping a row costs 0, a new role (user or assistant) 1, a deletion 2
    (blank and duplicate rows must go), an inserted empty row 5, an undeleted truncated row 5 more;
    what remains has the role initials ``(s?(ua)+)?``. Of the cheapest edit lists the ASCII-least
    is the ``audit``. ``2 ** block_bits`` rows form a block.
    """
    ordered = _in_order(rows)
    firsts = ordered.groupBy("conv", "mark").agg(F.min("id").alias("id")).select(
        "id", F.lit(True).alias("first"))
    trimmed = F.rtrim(F.col("text"), F.lit(WHITE))
    marked = (
        ordered.select("conv", "id", "turn", F.left("role", F.lit(1)).alias("initial"),
                       (trimmed == "").alias("empty"),
                       F.substring(trimmed, -1, 1).isin(".", "!", "?").alias("ended"))
        .join(firsts, "id", "left").select(
            "conv", "id", "turn", "initial",
            F.when(F.col("empty"), "blank").when(F.col("first").isNull(), "duplicate")
            .when(~F.col("ended"), "truncated").alias("fault")))
    initial = (F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1)
               .when(F.col("initial") == "a", 2).otherwise(3))
    kind = F.when(F.col("fault").isNull(), 0).when(F.col("fault") == "truncated", 1).otherwise(2)
    coded = settle(marked.withColumns({
        "code": F.col("id") * 16 + initial + 4 * kind,
        "block": F.shiftright("id", block_bits)}), "codes")
    counts = coded.groupBy("conv").agg(*[
        F.count_if(F.col("fault") == fault).alias(fault)
        for fault in ("blank", "duplicate", "truncated")])
    turns = (coded.filter("turn is not null").groupBy("conv", "turn").agg(F.lit(1).alias("one"))
             .groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps")))

    blocks = settle(coded.groupBy("conv", "block").agg(
        F.array_sort(F.collect_list("code")).alias("codes")), "blocks")
    per_block = map_batches(blocks, _summaries, "conv string, block long, costs array<long>, "
                            "ends array<long>, illegal long")
    chain = settle(map_batches(
        per_block.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct(
            "block", "costs", "ends", "illegal"))).alias("parts")), _chain_costs,
        "conv string, block long, come array<long>, last boolean, cost long, illegal long"),
        "chain")
    solved = map_batches(
        blocks.join(chain.select("conv", "block", "come", "last"), ["conv", "block"]),
        _solve, "conv string, block long, audits array<string>, exits array<long>")
    audits = settle(map_batches(
        solved.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct(
            "block", "audits", "exits"))).alias("parts")), _chain_audits,
        "conv string, block long, audit string"), "audits")
    whole = audits.groupBy("conv").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda p: p["audit"]), "")
        .alias("audit"))
    scripts = audits.select(
        "conv", F.shiftleft("block", block_bits).alias("id"), F.lit(0).alias("kind"), "audit",
        F.lit("").alias("role"), F.lit("").alias("text"))
    lines = ordered.select("conv", "id", F.lit(1).alias("kind"),
                           F.lit(None).cast("string").alias("audit"), "role", "text")
    digests = _digests(scripts.unionByName(lines).repartition("conv")
                       .sortWithinPartitions("conv", "id", "kind"))
    costs = chain.filter("cost is not null").select("conv", "cost", "illegal")
    return (counts.join(turns, "conv", "left").join(costs, "conv").join(whole, "conv")
            .join(digests, "conv").select(
                "conv", F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank",
                "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))


def damaged_repairs(table: DataFrame, conv: str = "conv_id", turn: str = "turn",
                    role: str = "role", text: str = "text",
                    block_bits: int = BLOCK_BITS) -> DataFrame:
    """:func:`repair` after :func:`damage`, one row for every conversation of ``table``.

    A conversation without rows after the damage has zeros, an empty audit and the digest of
    nothing. Rows with a null conversation form one, rows may repeat, further columns are left out
    and an empty table gives an empty result.
    """
    ids = table.select(F.col(conv).alias("conv_id")).distinct()
    found = repair(damage(table, conv, turn, role, text), block_bits)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (ids.withColumn("conv", conversation_key(F.col("conv_id"))).join(found, "conv", "left")
            .select(F.col("conv_id").alias(conv),
                    *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in numbers],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))
                    .alias("repaired_sha256")))
