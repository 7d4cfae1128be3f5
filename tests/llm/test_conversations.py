"""Conversation repair against a search over all edit lists."""

import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversations as repair

SCHEMA = "conv_id long, turn long, role string, text string"
GOAL = re.compile(r"(s?(ua)+)?\Z")
PREFIX = re.compile(r"(s?((ua)*u?))?\Z")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit("clash") for c in ("conv", "id", "block", "code", "fate", "copy", "audit")})


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fate = zlib.crc32(key.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else
                   "truncated" if bare[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Cheapest edits, least audit first, by a search ordered by (cost, audit)."""
    todo, done = [(0, "", 0, "", ())], set()
    while todo:
        cost, audit, i, roles, lines = heapq.heappop(todo)
        if i == len(rows) and GOAL.match(roles):
            return cost, audit, "\n".join(lines)
        state = (i, roles[-1:])
        if state in done:
            continue
        done.add(state)
        ways = [(5, "I", i, name, ":") for name in ("user", "assistant")]
        if i < len(rows):
            role, text = rows[i][2:]
            ways.append((2, "D", i + 1, None, None))
            if found[i] in (None, "truncated"):
                more = 5 if found[i] else 0
                ways.append((more, "K", i + 1, role, ":" + text))
                ways += [(1 + more, "R", i + 1, name, ":" + text)
                         for name in ("user", "assistant")]
        for price, letter, at, role, rest in ways:
            if role is None:
                heapq.heappush(todo, (cost + price, audit + letter, at, roles, lines))
            elif role[:1] and PREFIX.match(roles + role[0]):
                heapq.heappush(todo, (cost + price, audit + letter, at, roles + role[0],
                                      (*lines, role + rest)))


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        mine = [r for r in damaged(rows) if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(
            f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()))
        found = faults(mine)
        turns = {r[1] for r in mine} - {None}
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au")
                      for a, b in zip(mine, mine[1:], strict=False))
        cost, audit, text = cheapest(mine, found)
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                    *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost,
                    audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def made(seed=4):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", "uncle", None]
    texts = ["Yes.", "No!", "cut", "  ", "", "Yes.", "Ah? \n\t", "Größe.", "x" * 3000 + ".", None]
    rows = []
    for conv in [*range(60), None]:
        tidy = rng.random() < 0.5
        for turn in range(rng.choice([0, 1, 2, 3, 5, 8, 40])):
            role = ["user", "assistant"][turn % 2] if tidy and rng.random() < 0.8 \
                else rng.choice(roles)
            text = f"Line {turn}." if tidy and rng.random() < 0.8 else rng.choice(texts)
            rows.append((conv, rng.choice([turn] * 20 + [None, turn + 3, -turn]), role, text))
    rows += [rows[3]] * 5 + [(77, 1, "user", "Same.")] * 30
    dropped = next(c for c in range(100, 10 ** 4) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    return [*rows, (dropped, 1, "user", "Gone.")]


@pytest.mark.parametrize("bits", [repair.BLOCK_BITS, 2])
def test_repairs_equal_a_search(spark, bits):
    rows = made()
    got = repair.damaged_repairs(frame(spark, rows), block_bits=bits)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_no_rows(spark):
    assert repair.damaged_repairs(frame(spark, [])).collect() == []


def test_long_conversation_spans_ranges_and_blocks(spark):
    rows = [(1, t, ["user", "assistant"][t % 2] if t % 7 else "system", f"Turn {t}.")
            for t in range(3000)]
    got = repair.damaged_repairs(frame(spark, rows).repartition(8), block_bits=6)
    assert [tuple(r) for r in got.collect()] == brute(rows)


def test_audits_of_one_block_equal_the_search():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 9, 300)
    codes = rng.integers(0, 12, int(sizes.sum()))
    ends = np.tile(repair.AT_END, (len(sizes), 1))
    audits, _ = repair.least_audits(codes, sizes, ends, np.ones(len(sizes), bool),
                                    [(b, repair.START) for b in range(len(sizes))])
    names = ["system", "user", "assistant", "tool"]
    for block, audit in zip(np.split(codes, np.cumsum(sizes)[:-1]), audits, strict=True):
        rows = [(0, i, names[c % 4], "t") for i, c in enumerate(block)]
        found = [[None, "truncated", "blank"][c // 4] for c in block]
        assert cheapest(rows, found)[1] == audit.decode()
