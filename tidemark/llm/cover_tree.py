"""Exact top-k by inner product with a dual-tree search over cover trees.

Queries and rows are indexed together: both are dealt to the cells of one set of pivots, the top of
the tree, and below it every block of a cell has a cover tree of its own. A node has a centre, a
covering radius and either children or points. For a query node (centre a, radius s) and a row node
(centre c, radius r) no pair scores more than ``a.c + |a| r + |c| s + r s``; a pair of nodes is
pruned when that is below the worst kth score of the query node's group.

In two passes: every query first searches the blocks of its own cell, which gives its group a kth
score to beat. Then the pairs of cells that may still beat it are searched, starting from that
score; other pairs of cells are never sent anywhere. Blocks are bounded on both sides, and no more
than ``MOST_CELLS`` pivots and pairs of pivots reach the driver.

Scores are integers. They are computed with doubles while all partial sums are below 2 ** 53, and
with 64-bit integers beyond; a bound is lowered by a relative 1e-9 before anything is pruned.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.vectors import finite, matrix, ranked_hits
from tidemark.session import settle

BLOCK_ROWS = 8192
MOST_CELLS = 256
LEAF = 256
FAN_OUT = 16
#: Points of leaves that are compared in one go.
TOGETHER = 2048
SLACK = 1e-9

HITS = "query_id long, vec_id long, score long"


@dataclass
class Node:
    """``rows`` are the points of a leaf; inner nodes have children."""

    centre: np.ndarray
    norm: float
    radius: float
    rows: np.ndarray
    children: list[Node] = field(default_factory=list)


def cover_tree(points: np.ndarray, rows: np.ndarray | None = None, leaf: int = LEAF) -> Node:
    """Children are the farthest points taken in turn until their radius is half the parent's, or
    there are ``FAN_OUT`` of them; each point goes to its nearest child. Children of few points
    become one: in many dimensions a node would otherwise end in as many leaves as points."""
    rows = np.arange(len(points)) if rows is None else rows
    mine = points[rows]
    centre = mine[np.argmin(((mine - mine.mean(axis=0)) ** 2).sum(axis=1))]
    gap = np.sqrt(((mine - centre) ** 2).sum(axis=1))
    node = Node(centre, float(np.sqrt(centre @ centre)), float(gap.max()), rows)
    if len(rows) <= leaf or node.radius == 0:
        return node
    nearest, owner, chosen = gap.copy(), np.zeros(len(rows), int), 1
    while nearest.max() > node.radius / 2 and chosen < min(FAN_OUT, len(rows) // leaf + 1):
        other = np.sqrt(((mine - mine[np.argmax(nearest)]) ** 2).sum(axis=1))
        closer = other < nearest
        nearest[closer], owner[closer] = other[closer], chosen
        chosen += 1
    parts = [rows[owner == c] for c in range(chosen)]
    few = [p for p in parts if len(p) < leaf // 2]
    parts = [p for p in parts if len(p) >= leaf // 2] + ([np.concatenate(few)] if few else [])
    parts = [p for p in parts if len(p)]
    if len(parts) > 1:
        node.children = [cover_tree(points, p, leaf) for p in parts]
    return node


def bound(a: Node, c: Node) -> float:
    top = (float(a.centre @ c.centre) + a.norm * c.radius + c.norm * a.radius
           + a.radius * c.radius)
    return top + SLACK * (abs(top) + 1)


def exact_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products as longs; vectors whose product may leave 64 bits are an error."""
    most = max(np.abs(q).max(initial=0), 1) * max(np.abs(x).max(initial=0), 1) * q.shape[1]
    if most < 2 ** 53:
        return (q @ x.T).astype(np.int64)
    if most < 2 ** 63:
        return q.astype(np.int64) @ x.astype(np.int64).T
    raise ValueError("an inner product may not fit a long")


class DualSearch:
    """Best ``k`` rows of each query; ``floor`` is a kth score known before (or the smallest long).

    ``scores, ids`` hold the hits found so far, best first; empty places have id -1.
    """

    def __init__(self, q, q_ids, x, x_ids, k: int, floor: np.ndarray):
        self.q, self.q_ids, self.x, self.x_ids, self.k = q, q_ids, x, x_ids, k
        self.empty = np.iinfo(np.int64).min
        self.scores = np.full((len(q), k), self.empty, np.int64)
        self.ids = np.full((len(q), k), -1, np.int64)
        self.floor = floor
        self.visited = 0

    def worst(self, rows: np.ndarray) -> float:
        """The group's worst kth score; a score equal to it may still win by its id."""
        return float(np.maximum(self.scores[rows, -1], self.floor[rows]).min())

    def run(self) -> DualSearch:
        if len(self.q) and len(self.x):
            self._visit(cover_tree(self.q), [cover_tree(self.x)])
        return self

    def _visit(self, query: Node, nodes: list[Node]) -> None:
        """Narrow the row nodes for a query node, then for its children, best bound first."""
        worst = self.worst(query.rows)
        kept = []
        for node in nodes:
            if bound(query, node) < worst:
                continue
            if node.children and query.children and node.radius > query.radius:
                kept += [c for c in node.children if bound(query, c) >= worst]
            else:
                kept.append(node)
        if query.children:
            for child in query.children:
                self._visit(child, kept)
            return
        heap = [(-bound(query, n), i, n) for i, n in enumerate(kept)]
        heapq.heapify(heap)
        number = len(heap)
        waiting: list[np.ndarray] = []

        def compare_waiting() -> None:
            if waiting:
                self._compare(query.rows, np.concatenate(waiting))
                waiting.clear()
        while heap:
            top, _, node = heapq.heappop(heap)
            worst = self.worst(query.rows)
            if -top < worst:
                break  # so do all others
            if not node.children:
                self.visited += 1
                waiting.append(node.rows)
                if sum(map(len, waiting)) >= TOGETHER:
                    compare_waiting()
                continue
            for child in node.children:
                value = bound(query, child)
                if value >= worst:
                    number += 1
                    heapq.heappush(heap, (-value, number, child))
        compare_waiting()

    def _compare(self, queries: np.ndarray, rows: np.ndarray) -> None:
        for at in range(0, len(queries), TOGETHER):  # groups of equal points can be larger
            for start in range(0, len(rows), TOGETHER):
                self._compare_block(queries[at:at + TOGETHER], rows[start:start + TOGETHER])

    def _compare_block(self, queries: np.ndarray, rows: np.ndarray) -> None:
        new = exact_products(self.q[queries], self.x[rows])
        names = self.x_ids[rows]
        least = np.maximum(self.scores[queries, -1], self.floor[queries])
        if len(rows) > self.k + 1:  # below this block's own kth score (one may be the query itself)
            least = np.maximum(least, np.partition(new, -self.k - 1, axis=1)[:, -self.k - 1])
        out = (names[None, :] == self.q_ids[queries][:, None]) | (new < least[:, None])
        kept = (~out).sum(axis=1)
        some = np.flatnonzero(kept)
        if not len(some):
            return
        at = queries[some]
        place = np.argsort(out[some], axis=1, kind="stable")[:, :kept.max()]
        new, out = (np.take_along_axis(part[some], place, 1) for part in (new, out))
        scores = np.concatenate([self.scores[at], np.where(out, self.empty, new)], axis=1)
        names = np.concatenate([self.ids[at], np.where(out, -1, names[place])], axis=1)
        # empty places last; -score of the smallest long wraps, so it is ordered by a flag
        order = np.lexsort((names, -np.maximum(scores, self.empty + 1), scores == self.empty),
                           axis=-1)[:, :self.k]
        self.scores[at] = np.take_along_axis(scores, order, 1)
        self.ids[at] = np.take_along_axis(names, order, 1)

    def hits(self) -> pd.DataFrame:
        row, place = np.nonzero(self.scores > self.empty)
        return pd.DataFrame({"query_id": self.q_ids[row], "vec_id": self.ids[row, place],
                             "score": self.scores[row, place]})


def quantised(table: DataFrame, factor: int, key: str, vector: str) -> DataFrame:
    """``vec_id, vector``: floor(factor * x) of every usable row; a repeated key counts once, with
    its smallest vector."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("double"))
    return (finite(table, vector, key)
            .select(F.col(key).cast("long").alias("vec_id"), whole.alias("vector")))


def _search_pairs(queries: DataFrame, rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Dual search in every group of ``keys`` that both sides have."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        nothing = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        if left.empty or right.empty:
            return nothing
        q, x = matrix(left["vector"]), matrix(right["x_vector"])
        width = max(q.shape[1], x.shape[1])
        if width == 0:
            q, x = np.zeros((len(q), 1)), np.zeros((len(x), 1))
        q = np.pad(q, ((0, 0), (0, max(width, 1) - q.shape[1])))
        x = np.pad(x, ((0, 0), (0, max(width, 1) - x.shape[1])))
        return DualSearch(q, left["vec_id"].to_numpy(), x, right["x_vec_id"].to_numpy(), k,
                          left["floor"].to_numpy(np.int64)).run().hits()
    # both sides come from one table, so the second gets columns of its own
    rows = rows.select(*[F.col(c).alias(f"x_{c}") for c in rows.columns])
    return queries.groupBy(*keys).cogroup(
        rows.groupBy(*[f"x_{c}" for c in keys])).applyInPandas(run, HITS)


def top_products(table: DataFrame, is_query: Column, k: int, factor: int = 64,
                 key: str = "vec_id", vector: str = "embedding",
                 block_rows: int = BLOCK_ROWS, most_cells: int = MOST_CELLS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products of each query with the
    other rows of ``table``, ties to the smaller id; all if there are fewer.

    Rows without a key, and vectors that are null or hold null or non-finite components take no
    part; an empty vector is zero. Missing components of shorter vectors count as zero. A key that
    repeats is one row, with the smallest of its vectors. An empty table gives an empty result;
    extra columns are ignored; a product beyond 64 bits is an error.
    """
    spark = table.sparkSession
    least = -(1 << 63)
    # the smallest vector of a key: one row per key and task before the shuffle
    rows = settle(quantised(table, factor, key, vector)
                  .groupBy("vec_id").agg(F.min("vector").alias("vector")), "vectors")
    n = rows.count()
    cells = min(most_cells, max(1, -(-n // block_rows)))
    pivots = matrix([r["vector"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id")
                     .limit(cells).collect()])

    @F.pandas_udf("cell int, gap double, norm double")
    def place(vectors: pd.Series) -> pd.DataFrame:
        x = matrix(vectors, pivots.shape[1])
        p = np.pad(pivots, ((0, 0), (0, x.shape[1] - pivots.shape[1])))
        cell, gap = np.zeros(len(x), np.int32), np.full(len(x), np.inf)
        for i, pivot in enumerate(p):
            d = np.sqrt(((x - pivot) ** 2).sum(axis=1))
            closer = d < gap
            cell[closer], gap[closer] = i, d[closer]
        return pd.DataFrame({"cell": cell, "gap": gap, "norm": np.sqrt((x * x).sum(axis=1))})

    asked = (rows.select(F.col("vec_id").alias(key)).filter(is_query)
             .select(F.col(key).alias("vec_id"), F.lit(True).alias("is_query")))
    placed = settle(rows.withColumn("_p", place("vector")).select("vec_id", "vector", "_p.*")
                    .join(asked, "vec_id", "left")
                    .withColumn("is_query", F.coalesce("is_query", F.lit(False))), "cells")
    stats = {r["cell"]: r for r in placed.groupBy("cell").agg(
        F.count("*").alias("rows"), F.max("gap").alias("radius"),
        F.count_if("is_query").alias("queries"),
        F.max(F.when(F.col("is_query"), F.col("gap"))).alias("query_radius")).collect()}

    def parts(count: int) -> int:
        return max(1, -(-count // block_rows))

    def dealt(side: DataFrame, plan: list[tuple], mine: str, others: str,
              schema: str) -> DataFrame:
        """Rows of a side with a block number, once for every block on the other side."""
        salt = F.pmod(F.xxhash64("vec_id", F.lit(9)), F.col(f"{mine}_blocks")).cast("int")
        return (side.join(F.broadcast(spark.createDataFrame(plan, schema)),
                          F.col("cell") == F.col(f"{mine}_cell"))
                .withColumn(f"{mine}_block", salt)
                .withColumn(f"{others}_block", F.explode(F.sequence(
                    F.lit(0), F.col(f"{others}_blocks") - 1))))

    keys = ["row_cell", "query_block", "row_block"]

    def search(queries: DataFrame, pairs: list[tuple[int, int]]) -> DataFrame:
        """Search pairs of cells (query, row), at most ``most_cells ** 2``. The queries of all cells
        that go to a row cell are dealt to its blocks together: a row block is indexed once for
        each block of queries, not for each query cell."""
        sent: dict[int, int] = {}
        for q, c in pairs:
            sent[c] = sent.get(c, 0) + stats[q]["queries"]
        sizes = {c: (parts(n), parts(stats[c]["rows"])) for c, n in sent.items()}
        left = dealt(queries, [(q, c, *sizes[c]) for q, c in pairs] or [(-1, -1, 1, 1)],
                     "query", "row", "query_cell int, row_cell int, query_blocks int, "
                     "row_blocks int").select(*keys, "vec_id", "vector", "floor")
        right = dealt(placed, [(c, *size) for c, size in sizes.items()] or [(-1, 1, 1)],
                      "row", "query", "row_cell int, query_blocks int, row_blocks int"
                      ).select(*keys, "vec_id", "vector")
        return _search_pairs(left, right, keys, k)

    queries = placed.filter("is_query")
    asking = [c for c in stats if stats[c]["queries"]]
    own = settle(search(queries.withColumn("floor", F.lit(least)),
                        [(c, c) for c in asking]), "own-cells")
    best = ranked_hits(own, k, F.col("score").desc(), F.col("vec_id"))
    floors = settle(queries.join(
        best.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"),
                                               F.col("score").alias("floor")), "vec_id", "left")
        .withColumn("floor", F.coalesce("floor", F.lit(least))), "floors")
    worst = {r["cell"]: r["worst"] for r in
             floors.groupBy("cell").agg(F.min("floor").alias("worst")).collect()}

    def node(c: int, radius: float) -> Node:
        return Node(pivots[c], float(np.sqrt(pivots[c] @ pivots[c])), radius, np.zeros(0, int))
    width = max((len(p) for p in pivots), default=0)
    plan = [(q, c) for q in asking for c in stats if c != q and (
        width == 0 or bound(node(q, stats[q]["query_radius"]), node(c, stats[c]["radius"]))
        >= worst[q])]
    rest = search(floors, plan)
    return ranked_hits(own.unionByName(rest), k, F.col("score").desc(), F.col("vec_id"))
