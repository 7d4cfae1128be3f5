"""Exact and approximate vector search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import cover_tree, hnsw
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"
SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = [(10 ** 6, None), (10 ** 6 + 20, [1.0, None]), (10 ** 6 + 40, [float("nan"), 1.0]),
       (10 ** 6 + 60, [float("inf")] * 3), (None, [1.0, 2.0]), (10 ** 6 + 80, []),
       (10 ** 6 + 100, [0.0, 0.0])]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA).withColumns(
        {"cell": F.lit("clash"), "shard": F.lit(0), "vector": F.lit("v"), "score": F.lit(1)})


def usable(rows, zero):
    kept = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) \
                and (zero or any(v)):
            v = [float(np.float32(x)) for x in v]
            kept[i] = min(v, kept.get(i, v))
    return kept


def padded(a, b):
    n = max(len(a), len(b))
    return np.array(a + [0.0] * (n - len(a))), np.array(b + [0.0] * (n - len(b)))


def data(seed=1, n=700):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(x) for x in rng.normal(size=8)]) for i in rng.permutation(n)]
    rows += [(n + i, rows[0][1]) for i in range(60)]  # one very common vector
    rows += [(n + 100 + i, [1.0, -1.0, 0.5]) for i in range(3)] + [rows[5], rows[5]]
    return rows + ODD


@pytest.mark.parametrize("block, cells", [(8192, 256), (90, 4)])
def test_top_products_equal_brute_force(spark, block, cells):
    rows = data()
    got = cover_tree.top_products(vectors(spark, rows), F.col("vec_id") % 20 == 0, 20,
                                  block_rows=block, most_cells=cells)
    kept = {i: [float(np.floor(64 * x)) for x in v] for i, v in usable(rows, True).items()}
    want = []
    for q in [i for i in kept if i % 20 == 0]:
        hits = sorted((-int(np.dot(*padded(kept[q], kept[i]))), i) for i in kept if i != q)
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(hits[:20])]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_top_products_of_few_or_no_rows(spark):
    few = vectors(spark, [(0, [1.0]), (3, [2.0]), (20, [0.5, 3.0])])
    got = cover_tree.top_products(few, F.col("vec_id") % 20 == 0, 20).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 3, 64 * 128), (0, 2, 20, 64 * 32),
                                       (20, 1, 3, 32 * 128), (20, 2, 0, 32 * 64)]
    assert cover_tree.top_products(few.limit(0), F.col("vec_id") % 20 == 0, 5).collect() == []


def test_large_components_stay_exact():
    q = np.array([[2.0 ** 30, 1.0]])
    x = np.array([[2.0 ** 30, 3.0], [-(2.0 ** 30), 5.0]])
    assert cover_tree.exact_products(q, x).tolist() == [[2 ** 60 + 3, -(2 ** 60) + 5]]
    with pytest.raises(ValueError):
        cover_tree.exact_products(q * 2 ** 10, x)


def test_pruning_skips_pairs_of_nodes():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 6)) * 500
    x = np.floor(np.repeat(centres, 300, axis=0) + rng.normal(size=(6000, 6)) * 5)
    search = cover_tree.DualSearch(x[::20], np.arange(0, 6000, 20), x, np.arange(6000), 5,
                                   np.full(300, np.iinfo(np.int64).min)).run()
    best = np.sort(x[::20] @ x.T, axis=1)
    def leaves(node):
        return sum(map(leaves, node.children)) or 1
    pairs = leaves(cover_tree.cover_tree(x[::20])) * leaves(cover_tree.cover_tree(x))
    assert search.visited < 0.7 * pairs
    own = (x[::20] ** 2).sum(axis=1)
    for row, scores, mine in zip(search.scores, best, own, strict=True):
        rest = list(scores[-6:])
        rest.remove(mine) if mine in rest else rest.pop(0)
        assert sorted(row) == sorted(int(s) for s in rest)


def test_neighbours_recall_and_scores(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = {r["vec_id"]: np.array(r["embedding"], np.float64) for r in table.collect()}
    got = {}
    for r in hnsw.nearest(table, F.col("vec_id") % 100 == 0, 10, shard_rows=600).collect():
        assert r["score"] == pytest.approx(
            np.sqrt(((rows[r["query_id"]] - rows[r["vec_id"]]) ** 2).sum()), rel=1e-12)
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    found = 0
    for q in [i for i in rows if i % 100 == 0]:
        near = sorted((float(np.sqrt(((rows[q] - v) ** 2).sum())), i)
                      for i, v in rows.items() if i != q)[:10]
        mine = sorted(got[q])
        assert [m[0] for m in mine] == list(range(1, 11))
        assert [m[1:] for m in mine] == sorted(m[1:] for m in mine)
        found += len({i for _, i in near} & {m[2] for m in mine})
    assert found / (10 * len(got)) >= 0.9


def test_neighbours_with_copies_and_odd_rows(spark):
    rows = data(2)
    kept = usable(rows, False)
    got = hnsw.nearest(vectors(spark, rows), F.col("vec_id") % 100 == 0, 10,
                       shard_rows=200).collect()
    hits = 0
    for q in [i for i in kept if i % 100 == 0]:
        near = sorted((float(np.sqrt(((np.subtract(*padded(kept[q], v))) ** 2).sum())), i)
                      for i, v in kept.items() if i != q)[:10]
        mine = {r["vec_id"] for r in got if r["query_id"] == q}
        assert len(mine) == 10
        hits += len(mine & {i for _, i in near})
    assert hits >= 0.9 * len(got)


def test_neighbours_of_few_or_no_rows(spark):
    few = vectors(spark, [(0, [3.0, 0.0]), (1, [0.0, 4.0]), (2, [3.0])])
    got = hnsw.nearest(few, F.col("vec_id") % 100 == 0, 10).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 2, 0.0), (0, 2, 1, 5.0)]
    assert hnsw.nearest(few.limit(0), F.col("vec_id") % 100 == 0, 10).collect() == []


def test_registered_searches_rank_from_one(spark):
    for name in ("op2_cover_tree", "op4_hnsw"):
        got = QUERIES[name](spark, "/root/testdata/sf0.001")
        assert got.columns[:4] == ["query_id", "rank", "vec_id", "score"]
        assert got.filter("query_id = vec_id").count() == 0
