"""Approximate nearest neighbours by one navigable small-world graph per shard.

Shards hold about ``SHARD_ROWS`` rows, dealt by hash of the id. Equal vectors of a shard are one
node with all their ids, so a vector with a third of all rows does not crowd the graph. Nodes are
numbered from the highest level down: level l is simply the first ``counts[l]`` nodes, and its links
are one flat array with a fixed number of places per node. Points are inserted in batches; every
step of a batch (beam search, choice of diverse neighbours, back links) is one numpy operation over
the whole batch.

Every query is sent to every shard, in blocks of ``QUERY_BLOCK``; a shard answers with its ``k``
nearest, and the answers are merged by exact distance.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.vectors import finite, matrix, ranked_hits
from tidemark.session import settle

SHARD_ROWS = 8192
QUERY_BLOCK = 4096
LINKS = 16
BUILD_BEAM = 64
SEARCH_BEAM = 128
BATCH = 256


def _distances(x: np.ndarray, norms: np.ndarray, ids: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distances of each row's ``ids`` (rows x m) to that row's point."""
    dots = np.matmul(x[ids], q[:, :, None])[:, :, 0]
    return np.maximum(norms[ids] - 2 * dots + (q * q).sum(axis=1)[:, None], 0)


def beam_search(x: np.ndarray, norms: np.ndarray, links: np.ndarray, q: np.ndarray,
                entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """``beam`` nodes near each query, nearest first (-1 and inf where there are fewer)."""
    rows, n = len(q), len(links)
    ids = np.full((rows, beam), -1, np.int32)
    dist = np.full((rows, beam), np.inf, np.float32)
    width = min(beam, entry.shape[1])
    first = _distances(x, norms, np.maximum(entry, 0), q)
    first[entry < 0] = np.inf
    order = np.argsort(first, axis=1)[:, :width]
    ids[:, :width] = np.take_along_axis(entry, order, 1)
    dist[:, :width] = np.take_along_axis(first, order, 1)
    ids[np.isinf(dist)] = -1
    spent = ids < 0
    seen = np.zeros((rows, n + 1), bool)
    seen[:, n] = True
    seen[np.arange(rows)[:, None], np.where(ids < 0, n, ids)] = True
    live = np.arange(rows)
    while True:
        open_at = (~spent[live]).argmax(axis=1)  # the nearest one not expanded yet
        more = ~spent[live, open_at]
        live, open_at = live[more], open_at[more]
        if not len(live):
            return ids, dist
        node = ids[live, open_at]
        spent[live, open_at] = True
        near = links[node]
        near = np.where(near < 0, n, near)
        fresh = ~seen[live[:, None], near]
        seen[live[:, None], near] = True
        some = fresh.any(axis=1)
        if not some.any():
            continue
        at, near, fresh = live[some], near[some], fresh[some]
        d = _distances(x, norms, np.where(fresh, near, 0), q[at]).astype(np.float32)
        d[~fresh] = np.inf
        all_d = np.concatenate([dist[at], d], axis=1)
        order = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
        dist[at] = np.take_along_axis(all_d, order, 1)
        ids[at] = np.take_along_axis(np.concatenate([ids[at], near], axis=1), order, 1)
        spent[at] = np.take_along_axis(
            np.concatenate([spent[at], ~fresh], axis=1), order, 1)
        gone = np.isinf(dist[at])
        ids[at] = np.where(gone, -1, ids[at])
        spent[at] |= gone


def diverse(x: np.ndarray, norms: np.ndarray, ids: np.ndarray, dist: np.ndarray,
            m: int) -> np.ndarray:
    """Up to ``m`` of each row's candidates (nearest first, -1 pads): one is chosen when no chosen
    one is nearer to it than the row's point is; places left go to the nearest others."""
    rows, n = ids.shape
    safe = np.maximum(ids, 0)
    v = x[safe]
    between = norms[safe][:, :, None] + norms[safe][:, None, :] - 2 * np.matmul(
        v, v.transpose(0, 2, 1))
    blocked = ids < 0
    chosen = np.zeros((rows, n), bool)
    count = np.zeros(rows, int)
    for j in range(n):
        take = ~blocked[:, j] & (count < m)
        chosen[:, j] = take
        count += take
        blocked |= take[:, None] & (between[:, j, :] < dist)
    rank = np.where(chosen, 0, np.where(ids < 0, 2, 1)) * n + np.arange(n)
    order = np.argsort(rank, axis=1)[:, :m]
    out = np.full((rows, m), -1, np.int32)
    out[:, :order.shape[1]] = np.take_along_axis(ids, order, 1)
    return out


def _link_back(x, norms, links: np.ndarray, sources: np.ndarray, targets: np.ndarray) -> None:
    """Add ``source`` to the links of ``target``; full lists keep a diverse choice."""
    m = links.shape[1]
    order = np.lexsort((sources, targets))
    sources, targets = sources[order], targets[order]
    starts = np.concatenate([[True], targets[1:] != targets[:-1]])
    rank = np.arange(len(targets)) - np.maximum.accumulate(
        np.where(starts, np.arange(len(targets)), 0))
    for step in range(0, int(rank.max()) + 1 if len(rank) else 0, m):
        part = (rank >= step) & (rank < step + m)
        nodes, row = np.unique(targets[part], return_inverse=True)
        new = np.full((len(nodes), m), -1, np.int32)
        new[row, rank[part] - step] = sources[part]
        both = np.concatenate([links[nodes], new], axis=1)
        twice = (new[:, :, None] == links[nodes][:, None, :]).any(axis=2) & (new >= 0)
        both[:, m:][twice] = -1
        d = _distances(x, norms, np.maximum(both, 0), x[nodes])
        d[both < 0] = np.inf
        near = np.argsort(d, axis=1, kind="stable")
        links[nodes] = diverse(x, norms, np.take_along_axis(both, near, 1),
                               np.take_along_axis(d, near, 1), m)


class Graph:
    """``x`` (nodes in level order), ``counts`` of nodes per level, ``links`` per level."""

    def __init__(self, x: np.ndarray, counts: list[int], links: list[np.ndarray]):
        self.x, self.counts, self.links = x, counts, links
        self.norms = (x * x).sum(axis=1)

    @classmethod
    def build(cls, x: np.ndarray, m: int = LINKS, beam: int = BUILD_BEAM,
              batch: int = BATCH) -> Graph:
        """``x``: distinct points, float32, in random order (the first ones get the high levels)."""
        counts = [len(x)]
        while counts[-1] > m:
            counts.append(counts[-1] // m)
        links = [np.full((n, m if level else 2 * m), -1, np.int32)
                 for level, n in enumerate(counts)]
        graph = cls(x, counts, links)
        done = 0
        while done < len(x):
            level = max(i for i, n in enumerate(counts) if n > done)
            # a batch stays within its level and is no larger than what is there to search
            end = min(done + min(batch, max(done, 16)), counts[level])
            graph._insert(done, end, level, beam)
            done = end
        return graph

    def _insert(self, start: int, end: int, level: int, beam: int) -> None:
        x, norms, q = self.x, self.norms, self.x[start:end]
        rows = end - start
        entry = np.zeros((rows, 1), np.int32) if start else np.full((rows, 1), -1, np.int32)
        if start:
            entry = self._descend(q, entry, level)
        mates = np.tile(np.arange(start, end, dtype=np.int32), (rows, 1))
        among = _distances(x, norms, mates, q)
        among[np.arange(rows), np.arange(rows)] = np.inf
        for lower in range(level, -1, -1):
            links = self.links[lower]
            found, dist = np.empty((rows, 0), np.int32), np.empty((rows, 0), np.float32)
            if start:
                found, dist = beam_search(x, norms, links, q, entry, beam)
                entry = found
            ids = np.concatenate([found, mates], axis=1)
            d = np.concatenate([dist, among], axis=1)
            order = np.argsort(d, axis=1, kind="stable")[:, :beam]
            ids, d = np.take_along_axis(ids, order, 1), np.take_along_axis(d, order, 1)
            ids = np.where(np.isinf(d), -1, ids)
            links[start:end] = chosen = diverse(x, norms, ids, d, links.shape[1])
            row, place = np.nonzero(chosen >= 0)
            _link_back(x, norms, links, (row + start).astype(np.int32), chosen[row, place])

    def _descend(self, q: np.ndarray, entry: np.ndarray, level: int) -> np.ndarray:
        for upper in range(len(self.counts) - 1, level, -1):
            entry = beam_search(self.x, self.norms, self.links[upper], q, entry, 1)[0]
        return entry

    def search(self, q: np.ndarray, beam: int = SEARCH_BEAM) -> np.ndarray:
        """Nodes near each query, nearest first, -1 where there are fewer than ``beam``."""
        entry = self._descend(q, np.zeros((len(q), 1), np.int32), 0)
        return beam_search(self.x, self.norms, self.links[0], q, entry, beam)[0]


INDEX = ("shard int, width int, scale double, counts array<int>, vectors binary, "
         "links array<binary>, ids binary, bounds binary")


def build_shard(rows: pd.DataFrame, m: int, beam: int) -> pd.DataFrame:
    """One index row of a shard's ``vec_id, vector``; a repeated id counts with its smallest
    vector."""
    x = matrix(rows["vector"])
    ids = rows["vec_id"].to_numpy(np.int64)
    order = np.lexsort((*x.T[::-1], ids))
    x, ids = x[order], ids[order]
    first = np.concatenate([[True], ids[1:] != ids[:-1]])
    x, ids = x[first], ids[first]
    nodes, of = np.unique(x, axis=0, return_inverse=True)
    of = of.reshape(-1)
    shuffle = np.random.default_rng(17).permutation(len(nodes))
    nodes = nodes[shuffle]
    place = np.empty(len(nodes), np.int64)
    place[shuffle] = np.arange(len(nodes))
    by_node = np.lexsort((ids, place[of]))
    bounds = np.searchsorted(place[of][by_node], np.arange(len(nodes) + 1))
    scale = float(np.abs(nodes).max()) or 1.0
    graph = Graph.build((nodes / scale).astype(np.float32), m, beam)
    return pd.DataFrame([{
        "shard": int(rows["shard"].iloc[0]), "width": nodes.shape[1], "scale": scale,
        "counts": graph.counts, "vectors": nodes.tobytes(),
        "links": [part.tobytes() for part in graph.links],
        "ids": ids[by_node].tobytes(), "bounds": bounds.astype(np.int64).tobytes()}])


def search_shard(index: pd.Series, queries: pd.DataFrame, k: int, beam: int) -> pd.DataFrame:
    """``query_id, vec_id, score``: the shard's ``k`` nearest rows of each query but its own."""
    width = int(index["width"])
    nodes = np.frombuffer(index["vectors"], np.float64).reshape(-1, width)
    counts = [int(n) for n in index["counts"]]
    links = [np.frombuffer(part, np.int32).reshape(n, -1)
             for part, n in zip(index["links"], counts, strict=True)]
    ids, bounds = np.frombuffer(index["ids"], np.int64), np.frombuffer(index["bounds"], np.int64)
    q = matrix(queries["vector"], width)
    if q.shape[1] > width:  # missing components count as zero
        nodes = np.pad(nodes, ((0, 0), (0, q.shape[1] - width)))
    graph = Graph((nodes / index["scale"]).astype(np.float32), counts, links)
    out = []
    for at in range(0, len(q), BATCH):
        part = q[at:at + BATCH]
        found = graph.search((part / index["scale"]).astype(np.float32), max(beam, k + 1))
        for own, point, near in zip(queries["vec_id"].iloc[at:at + BATCH], part, found,
                                    strict=True):
            near = near[near >= 0]
            score = np.sqrt(((nodes[near] - point) ** 2).sum(axis=1))
            # of equal vectors only the k + 1 smallest ids can be among the k nearest others
            hits = [(s, i) for s, node in zip(score, near, strict=True)
                    for i in ids[bounds[node]:min(bounds[node] + k + 1, bounds[node + 1])]
                    if i != own]
            hits.sort()
            out += [(own, int(i), float(s)) for s, i in hits[:k]]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(
        {"query_id": "int64", "vec_id": "int64", "score": "float64"})


def build_index(table: DataFrame, key: str = "vec_id", vector: str = "embedding",
                shard_rows: int = SHARD_ROWS, m: int = LINKS,
                beam: int = BUILD_BEAM) -> DataFrame:
    """A settled row of flat arrays (:data:`INDEX`) per shard; every usable row is in it."""
    rows = finite(table, vector, key, zero_too=False).select(
        F.col(key).cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"))
    shards = max(1, -(-rows.count() // shard_rows))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    return settle(dealt.groupBy("shard").applyInPandas(
        lambda part: build_shard(part, m, beam), INDEX), "graphs")


def search(index: DataFrame, queries: DataFrame, k: int, key: str = "vec_id",
           vector: str = "embedding", beam: int = SEARCH_BEAM,
           query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest found, ties to the smaller id."""
    asked = settle(finite(queries, vector, key, zero_too=False)
                   .groupBy(F.col(key).cast("long").alias("vec_id"))
                   .agg(F.min(F.col(vector).cast("array<double>")).alias("vector")), "queries")
    blocks = max(1, -(-asked.count() // query_block))
    shards = index.select("shard")
    block = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(blocks)).cast("int")
    top = shards.agg(F.coalesce(F.max("shard"), F.lit(0))).first()[0]
    sent = asked.withColumn("block", block).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(top))))
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"})
        return search_shard(right.iloc[0], left, k, beam)
    hits = sent.groupBy("shard", "block").cogroup(held.groupBy("shard", "block")).applyInPandas(
        run, "query_id long, vec_id long, score double")
    return ranked_hits(hits, k, F.col("score"), F.col("vec_id"))


def nearest(table: DataFrame, is_query: Column, k: int, key: str = "vec_id",
            vector: str = "embedding", **settings) -> DataFrame:
    """Index all of ``table`` and search it for its rows that satisfy ``is_query``.

    Rows without a key, and vectors that are null, zero, empty or hold null or non-finite
    components take no part. Vectors of different lengths are compared as if the shorter one ended
    in zeros. A key that repeats is one row with its smallest vector. An empty table gives an empty
    result; extra columns are ignored.
    """
    index = build_index(table, key, vector, **settings)
    return search(index, table.filter(is_query), k, key, vector)
