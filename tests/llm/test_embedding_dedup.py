"""Near-duplicate vectors against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import embedding_dedup as dedup

SCHEMA = "vec_id long, embedding array<double>, label string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit("clash") for c in ("node", "cell", "t", "side", "links", "n_links", "v", "id")})


def brute(rows, threshold=0.98):
    def usable(v, label):
        return label is not None and v is not None and any(v) and all(
            x is not None and math.isfinite(x) for x in v)

    def cosine(a, b):
        a, b = [x / max(map(abs, a)) for x in a], [x / max(map(abs, b)) for x in b]
        return math.sumprod(a, b) / math.sqrt(math.sumprod(a, a) * math.sumprod(b, b))
    n = len(rows)
    near = [[False] * n for _ in rows]
    for i, (_, v, label) in enumerate(rows):
        for j, (_, w, other) in enumerate(rows):
            if i != j and usable(v, label) and usable(w, other) and label == other \
                    and len(v) == len(w):
                near[i][j] = cosine(v, w) >= threshold
    out = []
    for i, (key, *_) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = {j for j in range(n) if near[todo[-1]][j]} - seen
            todo.pop()
            seen |= new
            todo += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((key, sum(near[i]), least, key is not None and key == least))
    return sorted(out, key=repr)


def planted(seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for g, size in enumerate([1, 2, 3, 30, 90]):
        centre = rng.normal(size=16)
        for _ in range(size):
            v = centre + rng.normal(size=16) * 0.12 * np.linalg.norm(centre) / 4
            rows.append((len(rows), [float(x) for x in v * 10.0 ** rng.integers(-3, 4)],
                         "ab"[g % 2]))
    rows += [(len(rows) + i, [float(x) for x in rng.normal(size=16)], "a") for i in range(60)]
    first = rows[10]
    rows += [(1000 + i, first[1], first[2]) for i in range(25)]     # exact copies
    rows += [(2000, first[1], "b"), (2001, first[1], None), (None, first[1], first[2])]
    rows += [rows[0], rows[0], (5, rows[40][1], rows[40][2])]      # repeated rows, a shared key
    rows += [(3000, None, "a"), (3001, [], "a"), (3002, [0.0] * 16, "a"),
             (3003, [None] * 16, "a"), (3004, [float("nan")] * 16, "a"),
             (3005, [float("inf")] + [1.0] * 15, "a"), (None, None, None),
             (3006, [1.0, 1.0], "a"), (3007, [3.0, 3.0], "a"), (3008, [1e200, 1e200], "a"),
             (3009, [1e-200, 1e-200], "a"), (3010, [-1.0, -1.0], "a")]
    return rows


@pytest.mark.parametrize("block", [dedup.BLOCK, 12])
def test_links_and_components_equal_all_pairs(spark, block):
    rows = planted()
    got = dedup.near_vectors(frame(spark, rows), block=block)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_lower_threshold_and_no_rows(spark):
    rows = planted(5)[:90]
    got = dedup.near_vectors(frame(spark, rows), threshold=0.9)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 0.9)
    assert dedup.near_vectors(frame(spark, [])).collect() == []


def test_pairs_at_the_threshold_are_decided_exactly(spark):
    rows = [(1, [3.0, 4.0], "a"), (2, [4.0, 3.0], "a"), (3, [4.0, 3.0000001], "a")]
    got = dedup.near_vectors(frame(spark, rows), threshold=24 / 25)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 24 / 25)


def test_tables_hold_the_stated_recall():
    for n in (10, 10 ** 4, 10 ** 7, 10 ** 9):
        for threshold in (0.5, 0.9, 0.98):
            bits, tables = dedup.table_plan(n, threshold)
            agree = 1 - math.acos(threshold) / math.pi
            assert (1 - agree ** bits) ** tables <= dedup.MISS * 1.001
            assert tables <= dedup.MOST_TABLES and 1 <= bits <= 30
