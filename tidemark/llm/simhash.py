"""SimHash fingerprints and their near-duplicates by covering locality-sensitive hashing.

Covering. Every bit position gets a non-zero vector of ``radius + 1`` bits. For each of the
``2 ** (radius + 1) - 1`` non-zero vectors v there is a table whose mask holds the positions with an
odd overlap with v. Positions in which two fingerprints differ, at most ``radius`` of them, span
less than the whole space, so some v is orthogonal to all of them: that table's mask leaves them
out, and the pair collides there. No pair within the radius is lost, for any data.

Hot buckets. Tables hold distinct fingerprints, so exact copies count once. The members of a bucket
agree on its mask; a bucket above ``bucket_limit`` is therefore masked again by the same rule on the
positions that are still free, which about halves them each time: 64, 32, 16, at most 8. The last
level has at most 2 ** 8 distinct members, so no bucket needs all of its pairs elsewhere and
none is cut.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, utf8_values
from tidemark.llm.components import connected_components
from tidemark.session import settle

BITS = 64
#: Distinct fingerprints that one task compares with each other (a block of limit x limit bits).
BUCKET_LIMIT = 1024
HASHES_AT_ONCE = 1 << 16


def _majority(hashes: Sequence[int] | np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set."""
    votes = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), HASHES_AT_ONCE):
        part = np.ascontiguousarray(hashes[start:start + HASHES_AT_ONCE]).astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return votes


def simhash(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Fingerprint of UTF-8 text as an unsigned integer; 0 when it has no word."""
    words = text.lower().split()  # on bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64)
    over = _majority(hashes) * 2 > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                 seed: int = 42) -> DataFrame:
    """``key, fp`` (the fingerprint's bits as a long) for every row; whole texts, null as empty."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.fromiter((simhash(t, shingle, seed) for t in utf8_values(batch.column(1))),
                             np.uint64, batch.num_rows)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))],
                                          names=[key, "fp"])
    return map_batches(docs.select(key, text), run, f"`{key}` {kind}, fp long")


def covering_masks(positions: Sequence[int], radius: int, seed: int) -> list[int]:
    """Masks over the positions: pairs that differ in at most ``radius`` of them agree on one."""
    order = sorted(positions)
    random.Random(seed).shuffle(order)
    vectors = (1 << (radius + 1)) - 1
    label = {p: 1 + i % vectors for i, p in enumerate(order)}
    return [sum(1 << p for p in order if (label[p] & v).bit_count() % 2)
            for v in range(1, vectors + 1)]


def mask_levels(radius: int, levels: int = 3, seed: int = 7) -> list[list[tuple[int, int, int]]]:
    """Per level ``(parent, number, mask)``; a mask includes its parent's."""
    found: list[list[tuple[int, int, int]]] = []
    parents = [(0, 0)]
    for level in range(levels):
        rows = []
        for parent, above in parents:
            free = [p for p in range(BITS) if not above >> p & 1]
            for mask in covering_masks(free, radius, seed + level):
                rows.append((parent, len(rows), above | mask))
        found.append(rows)
        parents = [(number, mask) for _, number, mask in rows]
    return found


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def spanning_links(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Pairs that connect what the links within ``radius`` connect; fewer than there are members."""
    near = np.bitwise_count(members[:, None] ^ members[None, :]) <= radius
    label = np.arange(len(members))
    while True:
        low = np.where(near, label[None, :], len(members)).min(axis=1)
        low = low[low]
        if (low == label).all():
            break
        label = low
    return [(int(members[i]), int(members[r])) for i, r in enumerate(label) if i != r]


def _bucket_links(buckets: DataFrame, radius: int) -> DataFrame:
    """``a, b`` out of an array column ``members`` of distinct fingerprints."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        sizes = batch.column(0).value_lengths().to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        pairs = sizes == 2  # by far the most buckets
        first, second = flat[starts[pairs]], flat[starts[pairs] + 1]
        near = np.bitwise_count((first ^ second).view(np.uint64)) <= radius
        left, right = [first[near]], [second[near]]
        for start, n in zip(starts[~pairs], sizes[~pairs], strict=True):
            links = spanning_links(flat[start:start + n].view(np.uint64), radius)
            if links:
                both = np.array(links, np.uint64).view(np.int64)
                left.append(both[:, 0])
                right.append(both[:, 1])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"])
    return map_batches(buckets.select("members"), run, "a long, b long")


def near_links(distinct: DataFrame, radius: int = 3, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """``a, b``: links that connect all distinct ``fp`` within ``radius`` bits of each other."""
    spark = distinct.sparkSession
    bucket = ["number", "masked"]

    def spread(members: DataFrame, level: int) -> DataFrame:
        masks = spark.createDataFrame([(p, n, _signed(m)) for p, n, m in levels[level]],
                                      "parent int, number int, mask long")
        # the mask table has 15 ** (level + 1) rows, a constant of the method
        return members.join(F.broadcast(masks), "parent").select(
            "number", F.col("fp").bitwiseAND(F.col("mask")).alias("masked"), "fp")

    levels = mask_levels(radius)
    members, links = distinct.select("fp", F.lit(0).alias("parent")), None
    for level in range(len(levels)):
        rows = spread(members, level)
        sizes = rows.groupBy(*bucket).agg(F.count("*").alias("n")).filter("n > 1")
        shared = settle(rows.join(sizes, bucket), "buckets")
        last = level == len(levels) - 1
        fits = shared if last else shared.filter(F.col("n") <= bucket_limit)
        found = _bucket_links(fits.groupBy(*bucket).agg(F.collect_list("fp").alias("members")),
                              radius)
        links = found if links is None else links.unionByName(found)
        if last:
            break
        hot = shared.filter(F.col("n") > bucket_limit)
        if hot.isEmpty():
            break
        members = hot.select("fp", F.col("number").alias("parent"))
    return links


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = 3,
                    shingle: int = 3, seed: int = 42,
                    bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """``key, fp, component_id, root`` per row: the smallest key reachable over links, and a
    fingerprint that names the component.

    Two rows link when their fingerprints differ in at most ``radius`` bits. Texts without a word
    (null, empty, white space) have fingerprint 0 and link like any other. Rows that repeat or
    share a key stay rows of their own; a null key is never chosen unless its component has no
    other. An empty table gives an empty result.
    """
    marks = settle(fingerprints(docs, key, text, shingle, seed), "fingerprints")
    firsts = settle(marks.groupBy("fp").agg(F.min(key).alias("first")), "distinct")
    nodes = settle(connected_components(near_links(firsts, radius, bucket_limit)), "nodes")
    ids = nodes.join(firsts, F.col("node") == F.col("fp")).groupBy("root").agg(
        F.min("first").alias("smallest"))
    # most fingerprints have no link: they must not meet under one null root
    linked = nodes.join(ids, "root").select(F.col("node").alias("fp"), "smallest", "root")
    classes = settle(
        firsts.join(linked, "fp", "left").select(
            "fp", F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("smallest"))
            .alias("component_id"), F.coalesce("root", "fp").alias("root")), "classes")
    return marks.join(classes, "fp").select(key, "fp", "component_id", "root")


def hex_digits(fp: str = "fp"):
    """A long as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
