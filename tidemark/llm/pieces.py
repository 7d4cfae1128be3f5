"""Exact byte-pair encoding of a sentence-piece model by a merge-type prefix table.

The greedy merge order (best score first, leftmost on ties) has two properties that make a prefix
table work. A token sequence is the encoding exactly when every two neighbours are compatible, that
is, when merging their joint text gives just the two. And the encoding of a text's prefix ends in
one token only. So the table stores, for every prefix, its unique last token: an automaton over all
pieces names the pieces that end at a position, and the first one (longest first) that is
compatible with the last token of the prefix before it is the one. The ids are read backwards.

Many segments are filled in at once, position by position, with numpy. A segment is a run of space
marks with the letters after it: no piece holds a space mark behind another character, so segments
are independent. Distinct segments of a batch are encoded once; a bounded memo keeps them.
"""

from __future__ import annotations

import gc
import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Characters with a column of their own in the dense automaton; segments with others take the
#: scalar path, with the same results.
DENSE_CHARACTERS = 192
MEMO_SEGMENTS = 150_000
PAIR_SLOTS = 1 << 21
PAIR_MEMO = 1 << 17
CHARACTERS_AT_ONCE = 1 << 22


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0
    while at < len(data):
        tag, at = _varint(data, at)
        kind = tag & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            if kind == 2:
                size, at = _varint(data, at)
            else:
                size = {5: 4, 1: 8}[kind]
            value = data[at:at + size]
            at += size
        yield tag >> 3, value


class PieceModel:
    """Vocabulary of a model file: pieces, scores and kinds."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        flags = {3: True, 4: True, 5: True}
        charsmap, kind, fallback = b"", 1, False
        for number, value in _fields(data):
            if number == 1:
                entry = dict(_fields(value))
                self.pieces.append(entry.get(1, b"").decode())
                self.scores.append(struct.unpack("<f", entry.get(2, b"\0\0\0\0"))[0])
                self.kinds.append(entry.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
                kind, fallback = trainer.get(3, 1), bool(trainer.get(35, 0))
            elif number == 3:
                entry = dict(_fields(value))
                charsmap = entry.get(2, b"")
                flags |= {k: bool(v) for k, v in entry.items() if k in flags}
        extra = {k for k in self.kinds if k not in (NORMAL, UNKNOWN, CONTROL, BYTE)}
        if kind != 2 or charsmap or not flags[3] or flags[4] or not flags[5] or extra \
                or not fallback:
            raise ValueError("only byte-fallback pair models without text normalisation are read")
        #: Pieces with a plain space for the space mark, which keeps most texts one byte wide.
        self.ids = {p.replace(SPACE, " "): i for i, p in enumerate(self.pieces)
                    if self.kinds[i] == NORMAL}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces)
                      if self.kinds[i] == BYTE}
        if any(" " in p.lstrip(" ") for p in self.ids) or any(" " in p for p in self.pieces):
            raise ValueError("a piece holds a space mark behind another character")
        self.end = self.pieces.index("</s>")

    def merge(self, text: str) -> list[str]:
        """The merge order itself, for short strings: best score, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, where = None, -1
            for i in range(len(parts) - 1):
                found = self.ids.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or self.scores[found] > best):
                    best, where = self.scores[found], i
            if best is None:
                break
            parts[where:where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def surface(self, i: int) -> bytes:
        """What a token adds to decoded text."""
        if self.kinds[i] == BYTE:
            return bytes([int(self.pieces[i][3:5], 16)])
        if self.kinds[i] == CONTROL:
            return b""
        if self.kinds[i] == UNKNOWN:
            return " ⁇ ".encode()
        return self.pieces[i].replace(SPACE, " ").encode()

    def decode(self, ids: list[int]) -> str:
        """Text of ids: bytes become characters, the mark put before the text is taken off."""
        return self.strip_mark(b"".join(map(self.surface, ids)))

    @staticmethod
    def strip_mark(data: bytes) -> str:
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", errors="replace")


class _Memo(dict):
    """Entries by segment; asking for an unknown one makes an empty entry and notes it."""

    fresh: list[tuple[str, list]]

    def __missing__(self, segment: str) -> list:
        entry = self[segment] = [b"", b""]
        self.fresh.append((segment, entry))
        return entry


class PrefixTableEncoder:
    """Encodes segments; ``ids`` gives the tokens of a whole text, ``digest`` what a query needs."""

    def __init__(self, model: PieceModel):
        self.model = model
        whole = {p: i for p, i in model.ids.items() if model.merge(p) == [p]}  # reachable pieces
        self.whole = whole
        self.longest = max(map(len, whole))
        self.length = np.zeros(len(model.pieces), np.int64)
        for piece, i in whole.items():
            self.length[i] = len(piece)
        self._pairs: dict[int, bool] = {}
        self._slot_key = np.full(PAIR_SLOTS, -1, np.int64)
        self._slot_fits = np.zeros(PAIR_SLOTS, bool)
        self._surface = [model.surface(i) for i in range(len(model.pieces))]
        self._decimal = [str(i).encode() for i in range(len(model.pieces))]
        self._text = {i: p for p, i in whole.items()}
        self._memo = _Memo()
        self._cut = "\n" if not any("\n" in p for p in model.ids) else ""
        self._segments = re.compile(f" *[^ {self._cut}]+| +|{self._cut or ' '}")
        self._build_automaton()

    def _build_automaton(self) -> None:
        """Dense Aho-Corasick automaton over the commonest characters of the pieces."""
        counts: dict[str, int] = {}
        for piece in self.whole:
            for c in piece:
                counts[c] = counts.get(c, 0) + 1
        common = sorted(counts, key=lambda c: (-counts[c], c))[:DENSE_CHARACTERS]
        self._column = np.full(0x110000, -1, np.int16)
        for n, c in enumerate(common):
            self._column[ord(c)] = n
        column = {c: n for n, c in enumerate(common)}
        children: list[dict[int, int]] = [{}]
        ends = [-1]
        for piece, i in self.whole.items():
            if all(c in column for c in piece):
                state = 0
                for c in piece:
                    state = children[state].setdefault(column[c], len(children))
                    if state == len(children):
                        children.append({})
                        ends.append(-1)
                ends[state] = i
        step = np.zeros((len(children), len(common)), np.int32)
        match = np.full(len(children), -1, np.int32)  # the longest piece that ends in a state
        shorter = np.full(len(self.model.pieces), -1, np.int32)  # the next one of a piece
        queue = []
        for c, child in children[0].items():
            step[0, c] = child
            match[child] = ends[child]
            queue.append((child, 0))
        for state, back in queue:
            step[state] = step[back]
            for c, child in children[state].items():
                below = int(step[back, c])
                step[state, c] = child
                match[child] = ends[child] if ends[child] >= 0 else match[below]
                if ends[child] >= 0:
                    shorter[ends[child]] = match[below]
                queue.append((child, below))
        self._step, self._match, self._shorter = step, match, shorter

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the two pieces' joint text gives just the two."""
        key = left * len(self.model.pieces) + right
        known = self._pairs.get(key)
        if known is None:
            a, b = self._text[left], self._text[right]
            known = self.model.merge(a + b) == [a, b]
            if len(self._pairs) >= PAIR_MEMO:  # the slots keep most of the answers
                self._pairs.clear()
            self._pairs[key] = known
        return known

    def _compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * len(self.model.pieces) + right
        slot = ((key * 0x9E3779B1) >> 13) & (PAIR_SLOTS - 1)
        missing = self._slot_key[slot] != key
        if not missing.any():
            return self._slot_fits[slot]
        for k in np.unique(key[missing]).tolist():
            at = ((k * 0x9E3779B1) >> 13) & (PAIR_SLOTS - 1)
            self._slot_key[at] = k
            self._slot_fits[at] = self.compatible(*divmod(k, len(self.model.pieces)))
        fits = self._slot_fits[slot]
        pushed_out = self._slot_key[slot] != key  # pairs that share a slot: asked one by one
        if pushed_out.any():
            fits[pushed_out] = [self.compatible(*divmod(k, len(self.model.pieces)))
                                for k in key[pushed_out].tolist()]
        return fits

    def _fill(self, columns: np.ndarray) -> np.ndarray:
        """Last token of every prefix (column j: prefix of j + 1 characters) of equally long
        segments, given as automaton columns."""
        rows, n = columns.shape
        last = np.full((rows, n + 1), -1, np.int32)
        state = np.zeros(rows, np.int32)
        for j in range(n):
            state = self._step[state, columns[:, j]]
            open_rows = np.arange(rows)
            token = self._match[state]
            while len(open_rows):
                before = j + 1 - self.length[token]
                fits = before == 0
                inner = np.flatnonzero(~fits)
                if len(inner):
                    fits[inner] = self._compatible(last[open_rows[inner], before[inner]],
                                                   token[inner])
                last[open_rows[fits], j + 1] = token[fits]
                open_rows, token = open_rows[~fits], self._shorter[token[~fits]]
        return last

    def _scalar(self, segment: str) -> list[int]:
        """The same table for one segment with any characters; those without a piece become bytes
        and part the segment."""
        out: list[int] = []
        known = self.model.ids
        run = ""
        for c in [*segment, ""]:
            if c and c in known:
                run += c
                continue
            last: list[int] = [-1]
            for j in range(1, len(run) + 1):
                for n in range(min(j, self.longest), 0, -1):
                    token = self.whole.get(run[j - n:j])
                    if token is not None and (j == n or self.compatible(last[j - n], token)):
                        last.append(token)
                        break
            tokens, j = [], len(run)
            while j:
                tokens.append(last[j])
                j -= int(self.length[last[j]])
            out += tokens[::-1]
            out += [self.model.bytes[b] for b in c.encode()]
            run = ""
        return out

    def _learn(self, fresh: list[tuple[str, list]]) -> None:
        """Encode new segments, those of equal length together, and fill in their entries."""
        decimal, surface = self._decimal.__getitem__, self._surface.__getitem__

        def store(entry: list, tokens: list[int]) -> None:
            entry[0] = b" ".join(map(decimal, tokens))
            entry[1] = b"".join(map(surface, tokens))

        by_length: dict[int, list[tuple[str, list]]] = {}
        for pair in fresh:
            by_length.setdefault(len(pair[0]), []).append(pair)
        for n, group in by_length.items():
            if n > 64:
                for s, entry in group:
                    store(entry, self._scalar(s))
                continue
            points = np.frombuffer("".join([s for s, _ in group]).encode("utf-32-le"),
                                   np.uint32).reshape(-1, n)
            columns = self._column[points]
            dense = (columns >= 0).all(axis=1)
            for i in np.flatnonzero(~dense).tolist():
                store(group[i][1], self._scalar(group[i][0]))
            rows = np.flatnonzero(dense)
            if not len(rows):
                continue
            last = self._fill(columns[rows])
            found = np.full((len(rows), n), -1, np.int32)
            at, index = np.full(len(rows), n), np.arange(len(rows))
            for k in range(n - 1, -1, -1):  # backwards; early ends leave -1 in front
                token = last[index, at]
                found[index, k] = np.where(at > 0, token, -1)
                at = at - np.where(at > 0, self.length[token], 0)
                if not at.any():
                    break
            skip = (found < 0).sum(axis=1).tolist()
            for i, tokens, m in zip(rows.tolist(), found.tolist(), skip, strict=True):
                store(group[i][1], tokens[m:])

    def _entries(self, texts: list[str]) -> list[list[list]]:
        """Per text the memo's entries ``[decimal ids, surface bytes]`` of its segments."""
        memo = self._memo
        if len(memo) > MEMO_SEGMENTS:
            memo.clear()
        memo.fresh = []
        cut, look = self._segments.findall, memo.__getitem__
        found = [list(map(look, cut(" " + t.replace(SPACE, " ")))) if t else [] for t in texts]
        self._learn(memo.fresh)
        return found

    def forget(self) -> None:
        """Let go of the segments seen; the process may go on to other work."""
        self._memo.clear()

    def _blocks(self, texts: list[str]) -> Iterator[list[str]]:
        block, held = [], 0
        for t in texts:
            if block and held + len(t) > CHARACTERS_AT_ONCE:
                yield block
                block, held = [], 0
            block.append(t)
            held += len(t)
        if block:
            yield block

    def ids(self, text: str) -> list[int]:
        """Token ids of a whole text with the end id."""
        entries = self._entries([text])[0]
        return [int(x) for e in entries for x in e[0].split()] + [self.model.end]

    def digests(self, texts: list[str]) -> Iterator[tuple[int, str, str]]:
        """``n_tokens, ids_sha256, decoded_sha256`` of whole texts."""
        end = self._decimal[self.model.end]
        collecting = gc.isenabled()
        gc.disable()  # hundreds of thousands of small entries and no cycles
        try:
            for block in self._blocks(texts):
                for entries in self._entries(block):
                    decimals, surfaces = zip(*entries, strict=True) if entries else ((), ())
                    ids = b" ".join([*decimals, end])
                    decoded = self.model.strip_mark(b"".join(surfaces))
                    yield (ids.count(b" ") + 1, hashlib.sha256(ids).hexdigest(),
                           hashlib.sha256(decoded.encode()).hexdigest())
        finally:
            if collecting:
                gc.enable()


_ready: dict[str, PrefixTableEncoder] = {}


def encoder(data: bytes) -> PrefixTableEncoder:
    """One encoder per model and Python process."""
    mark = hashlib.sha256(data).hexdigest()
    if mark not in _ready:
        _ready[mark] = PrefixTableEncoder(PieceModel(data))
    return _ready[mark]


def read_model(path: str) -> bytes:
    """The model file's bytes, read on the driver (a few hundred KB)."""
    with open(path, "rb") as file:
        return file.read()


def token_ids(docs: DataFrame, model: bytes, text: str = "text", out: str = "ids") -> DataFrame:
    """Add the array of ids, with the end id, of every whole text; null as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<int>")
    def encode(values: pd.Series) -> pd.Series:
        ready = encoder(shared.value)
        return pd.Series([ready.ids(v or "") for v in values], dtype=object)
    return docs.withColumn(out, encode(F.col(text)))


def decoded_text(docs: DataFrame, model: bytes, ids: str = "ids",
                 out: str = "decoded") -> DataFrame:
    """Add the text of an array of ids; null stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def decode(values: pd.Series) -> pd.Series:
        ready = encoder(shared.value)
        return pd.Series([None if v is None else ready.model.decode(list(v)) for v in values],
                         dtype=object)
    return docs.withColumn(out, decode(F.col(ids)))


def encode_decode(docs: DataFrame, model: bytes, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` per row, of whole texts.

    Null counts as empty: the end id alone and the digest of nothing. Repeated rows repeat.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ready = encoder(shared.value)
        for values in batches:
            found = list(ready.digests([v or "" for v in values]))
            yield pd.DataFrame(found, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
        ready.forget()
    return docs.select(key, run(F.col(text)).alias("_d")).select(key, "_d.*")
