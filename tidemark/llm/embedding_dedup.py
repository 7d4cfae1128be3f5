"""Near-duplicate vectors: sign hashing in several tables, exact cosines, connected components.

Hashing. The signs of a vector's products with ``bits`` random hyperplanes name its bucket in a
table. Two vectors at angle x agree on one sign with probability ``1 - x / pi``, so ``tables`` is
the number after which a pair right at the threshold has met nowhere with probability ``MISS`` at
most; closer pairs meet sooner. ``bits`` grows with the logarithm of the largest label, which keeps
buckets of unrelated vectors at about one member for any size.

Verification. Members of a bucket are compared by exact cosines in double precision; a pair within
1e-9 of the threshold is decided by an exactly rounded sum. Nothing is emitted per pair: a task
returns each member's number of links, counting a pair only in the first table where it meets, and
links that span what the pairs connect. Exact copies are one node with a count, so they are never
compared. A bucket above ``BLOCK`` members is cut into blocks and each pair of blocks becomes a cell
of its own, so no bucket is cut short and no task gets more than two blocks at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.vectors import finite_vector, matrix
from tidemark.session import settle

#: Probability at most that a pair at the threshold meets in no table.
MISS = 1e-6
MOST_TABLES = 128
#: Members of a bucket that are compared in one go, and rows of one product.
BLOCK = 4096
STRIP = 256
#: Cells up to this size are compared together with their neighbours, row by shifted row.
SMALL = 24


def table_plan(n: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """``bits, tables`` for ``n`` vectors of one label: few strangers in a bucket, no pair missed."""
    agree = 1 - math.acos(min(1.0, threshold)) / math.pi
    bits = min(30, max(8, math.ceil(math.log2(max(n, 2))) + 1))
    while True:
        meet = agree ** bits
        tables = 1 if meet >= 1 else math.ceil(math.log(miss) / math.log1p(-meet))
        if tables <= MOST_TABLES or bits == 1:
            return bits, tables
        bits -= 1


def unit_rows(vectors) -> np.ndarray:
    """Rows of doubles scaled by a power of two each, so that no square overflows or vanishes."""
    x = matrix(vectors)
    if not x.size:
        return x
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def _signatures(vectors, bits: int, tables: int, seed: int) -> np.ndarray:
    """One bucket number per row and table; the planes depend on the dimension and the seed only."""
    x = unit_rows(vectors)
    planes = np.random.default_rng([seed, x.shape[1]]).standard_normal((x.shape[1], tables * bits))
    signs = (x @ planes >= 0).reshape(len(x), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def _with_signatures(nodes: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """``nodes`` with the array column ``sigs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs = np.zeros((batch.num_rows, tables), np.int64)
            dims = batch.column("dim").to_numpy(zero_copy_only=False)
            vectors = batch.column("v")
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                sigs[at] = _signatures(_dense(vectors.take(pa.array(at)), dim), bits, tables, seed)
            flat = pa.array(sigs.astype(np.int32).ravel())
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * tables)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(offsets, flat)],
                names=[*batch.schema.names, "sigs"])
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    return nodes.mapInArrow(run, f"{kinds}, sigs array<int>")


def _dense(vectors: pa.Array, dim: int) -> np.ndarray:
    """A list column whose rows all have ``dim`` components."""
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _exact(a: np.ndarray, b: np.ndarray) -> float:
    a, b = a.tolist(), b.tolist()
    return math.sumprod(a, b) / (math.sqrt(math.sumprod(a, a)) * math.sqrt(math.sumprod(b, b)))


class _Cells:
    """The cells of one stretch of rows, compared; collects link counts and spanning links."""

    def __init__(self, rows: pa.Table, threshold: float):
        self.threshold = threshold
        self.node = rows["node"].to_numpy()
        self.copies = rows["copies"].to_numpy().astype(np.float64)
        self.table = rows["t"].to_numpy()
        self.side = rows["side"].to_numpy()
        self.cross = rows["lo"].to_numpy() != rows["hi"].to_numpy()
        self.sigs = rows["sigs"].combine_chunks().flatten().to_numpy().reshape(len(rows), -1)
        dims = rows["dim"].to_numpy()
        vectors = rows["v"].combine_chunks()
        if len(np.unique(dims)) == 1:
            self.x = unit_rows(_dense(vectors, int(dims[0])))
        else:
            self.x = unit_rows(vectors.to_pylist())  # other dimensions are in other cells
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.x, self.x))
        keys = rows["cell"].combine_chunks()
        new = np.ones(len(rows), bool)
        new[1:] = np.asarray(pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)))
        self.start = np.flatnonzero(new)
        self.size = np.diff(np.append(self.start, len(rows)))
        self.cell = np.cumsum(new) - 1
        self.degree = np.zeros(len(rows))
        self.links: list[np.ndarray] = []

    def _decide(self, i: np.ndarray, j: np.ndarray, cosine: np.ndarray) -> tuple:
        """The pairs that link and whose first common table is this one."""
        near = cosine >= self.threshold
        for k in np.flatnonzero(np.abs(cosine - self.threshold) < 1e-9):
            near[k] = _exact(self.x[i[k]], self.x[j[k]]) >= self.threshold
        i, j = i[near], j[near]
        for table in range(int(self.table[i].max(initial=0))):
            met = (self.sigs[i, table] == self.sigs[j, table]) & (table < self.table[i])
            i, j = i[~met], j[~met]
        self.degree += np.bincount(i, self.copies[j], len(self.node))
        self.degree += np.bincount(j, self.copies[i], len(self.node))
        return i, j

    def small(self) -> None:
        """All cells of at most SMALL rows at once: every row against the next, the one after..."""
        inside = np.repeat(self.size <= SMALL, self.size)
        for shift in range(1, min(SMALL, len(inside))):
            i = np.flatnonzero(inside[:-shift] & (self.cell[:-shift] == self.cell[shift:]))
            i = i[~self.cross[i] | (self.side[i] != self.side[i + shift])]
            j = i + shift
            cosine = np.einsum("ij,ij->i", self.x[i], self.x[j]) / (self.norm[i] * self.norm[j])
            i, j = self._decide(i, j, cosine)
            self.links.append(np.stack([i, j], axis=1))

    def large(self, start: int, size: int) -> None:
        """One cell by block products; rows hang under the first row of what they connect."""
        label = np.arange(size)
        members = slice(start, start + size)
        x, norm, side = self.x[members], self.norm[members], self.side[members]
        for low in range(0, size, STRIP):
            high = min(size, low + STRIP)
            cosine = (x[low:high] @ x[low:].T) / (norm[low:high, None] * norm[None, low:])
            wanted = cosine >= self.threshold - 1e-9
            wanted &= np.arange(low, high)[:, None] < np.arange(low, size)[None, :]
            if self.cross[start]:
                wanted &= side[low:high, None] != side[None, low:]
            i, j = np.nonzero(wanted)
            i, j = self._decide(start + low + i, start + low + j, cosine[i, j])
            if not len(i):
                continue
            i, j = i - start, j - start
            first = np.flatnonzero(np.diff(i, prepend=-1))
            for row, found in zip(i[first], np.split(j, first[1:]), strict=True):
                seen = np.append(label[found], label[row])
                root = seen.min()
                if (seen != root).any():
                    label[np.isin(label, seen)] = root
        hung = np.flatnonzero(label != np.arange(size))
        self.links.append(np.stack([start + label[hung], start + hung], axis=1))

    def run(self) -> pa.RecordBatch:
        self.small()
        for start, size in zip(self.start, self.size, strict=True):
            if size > SMALL:
                self.large(int(start), int(size))
        pairs = np.concatenate([np.empty((0, 2), np.int64), *self.links]).astype(np.int64)
        linked = np.flatnonzero(self.degree)
        none = pa.nulls(len(linked), pa.int64())
        return pa.RecordBatch.from_arrays([
            pa.concat_arrays([pa.array(self.node[pairs[:, 0]]), pa.array(self.node[linked])]),
            pa.concat_arrays([pa.array(self.node[pairs[:, 1]]), none]),
            pa.concat_arrays([pa.nulls(len(pairs), pa.int64()),
                              pa.array(self.degree[linked].astype(np.int64))])],
            names=["a", "b", "links"])


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Stretches of the sorted rows that end where a cell ends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("cell")
        last = keys[-1]
        cut = pc.index(keys, last).as_py()  # the batch's last cell may go on
        if held and (cut > 0 or held[-1].column("cell")[-1] != last):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif cut > 0:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _compare(cells: DataFrame, threshold: float) -> DataFrame:
    """``a, b`` for spanning links and ``a, links`` for counts out of rows sorted by cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_cells(batches):
            yield _Cells(rows, threshold).run()
    return cells.mapInArrow(run, "a long, b long, links long")


def _cells(nodes: DataFrame, block: int) -> DataFrame:
    """The rows of every bucket with company, with their vectors, ordered by cell."""
    bucket = ["label", "dim", "t", "sig"]
    met = nodes.select("node", "label", "dim", F.posexplode("sigs").alias("t", "sig"))
    sizes = met.groupBy(*bucket).agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = (met.join(sizes, bucket).withColumn("blocks", blocks).withColumn("own", own)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("node", "t", "sig", F.least("own", "other").alias("lo"),
                      F.greatest("own", "other").alias("hi"),
                      (F.col("own") > F.col("other")).cast("int").alias("side")))
    cell = F.concat_ws("|", "t", "sig", "lo", "hi", "dim", "label")
    return (placed.join(nodes, "node")
            .select(cell.alias("cell"), "node", "copies", "t", "lo", "hi", "side", "dim", "sigs",
                    "v")
            .repartition("cell").sortWithinPartitions("cell", "side", "node"))


def near_vectors(table: DataFrame, threshold: float = 0.98, key: str = "vec_id",
                 vector: str = "embedding", label: str = "label", miss: float = MISS,
                 seed: int = 17, block: int = BLOCK) -> DataFrame:
    """``key, n_links, component_id, kept`` for every row of ``table``.

    Rows link when their labels are equal, their vectors have the same dimension and the cosine is
    at least ``threshold`` (above 0). ``n_links`` counts the other rows linked directly, copies of
    the vector included; ``component_id`` is the smallest key reachable; ``kept`` says whether it
    is the row's own. Rows with a null label or a vector that is null, zero, empty or holds a null
    or non-finite component link with nothing. Rows that share a key stay rows of their own; a null
    key names a component only where there is no other and is never kept. Further columns are left
    out. An empty table gives an empty result.
    """
    v = F.col(vector)
    marks = [F.xxhash64(F.lit(i), v).alias(f"h{i}") for i in (1, 2)]  # 128 bits name a vector
    named = table.select(F.col(key).alias("id"), F.col(label).cast("string").alias("label"),
                         F.size(v).alias("dim"), v.alias("v"), *marks)
    able = F.coalesce(F.col("label").isNotNull() & finite_vector(F.col("v"), zero_too=False),
                      F.lit(False))
    named = named.withColumn("able", able)
    same = ["label", "dim", "h1", "h2"]
    folded = settle(
        named.filter("able").groupBy(*same)
        .agg(F.first("v").alias("v"), F.min("id").alias("first"), F.count("*").alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()), "vectors")
    most = folded.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    bits, tables = table_plan(most, threshold, miss)
    nodes = settle(_with_signatures(folded, bits, tables, seed), "signed")
    found = settle(_compare(_cells(nodes, block), threshold), "links")
    degrees = (found.filter("links is not null").groupBy(F.col("a").alias("node"))
               .agg(F.sum("links").alias("links")))
    roots = settle(connected_components(found.filter("b is not null").select("a", "b")), "roots")
    smallest = (roots.join(folded.select("node", "first"), "node").groupBy("root")
                .agg(F.min("first").alias("component_id")))
    reached = roots.join(smallest, "root").select("node", "component_id")
    known = settle(
        folded.join(degrees, "node", "left").join(reached, "node", "left").select(
            *same, (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "first").alias("component_id")), "known")
    paired = named.filter("able").select("id", *same).join(known, same)
    alone = named.filter("not able").select("id", F.lit(0).cast("long").alias("n_links"),
                                            F.col("id").alias("component_id"))
    both = paired.select("id", "n_links", "component_id").unionByName(alone)
    return both.select(F.col("id").alias(key), "n_links", "component_id",
                       F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
