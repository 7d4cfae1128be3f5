"""Mixing sources to target weights by systematic sampling.

A document's expected copies are its source's target over the source's size. They are summed up
along an order within the source, one random offset per source is added, and the document is taken
once for every whole number that the sum crosses: never more often than the expected copies rounded
up, and all documents of a source together come within one step of their share.

The order is (bucket, size, key). A bucket is a hash of the key and holds about ``ROWS_PER_BUCKET``
documents; a source with a third of all rows simply has a third of the buckets. Ranks are drawn
inside a bucket and the counts of the buckets before it are added, so no source meets in one task.
Within a bucket neighbours have similar sizes, which keeps the words taken close to the target.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import ranked, running_totals
from tidemark.session import settle

ROWS_PER_BUCKET = 4000
#: No source is taken more than this often.
MOST_REPEATS = 3
#: Offsets of which a source gets the one that brings it nearest its target.
OFFSETS = 16
#: The weights that sources get in turn, in code point order.
WEIGHTS = (1, 2, 3)


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]):
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def source_targets(sizes: DataFrame, source: str = "source",
                   weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Add ``weight`` and ``target`` to one row per source with ``source_size``.

    All targets together are the total size. A target stops at ``most`` times its source's size and
    the excess goes to the others by weight, again and again until none is above: the level at which
    the sources fill up. A source is full at that level exactly when filling all sources up to its
    own ratio of cap and weight does not need more than the total, which integers decide exactly.
    """
    keyed = settle(sizes.select(
        source, "source_size", F.col(source).isNull().cast("int").alias("_null"),
        F.coalesce(F.col(source), F.lit("")).alias("_name")), "sources")
    turn = (F.col("_rank") - 1) % len(weights)
    weighed = settle(
        ranked(keyed, ["_null", "_name"], "_rank").withColumns({
            "weight": F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
            .cast("long"),
            "_cap": (F.col("source_size") * most).cast("decimal(38,0)")})
        .withColumn("_ratio", F.col("_cap").cast("double") / F.col("weight")), "weighed")
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0)).cast("decimal(38,0)")).scalar()
    weight_sum = weighed.agg(F.sum("weight").cast("decimal(19,0)")).scalar()
    filled = settle(
        running_totals(weighed, ["_ratio", "_rank"],
                       {"_caps": "_cap", "_weights": "weight"})
        .withColumn("_full", F.col("_caps").cast("decimal(25,0)") * F.col("weight")
                    + F.col("_cap").cast("decimal(25,0)")
                    * (weight_sum - F.col("_weights")).cast("decimal(12,0)")
                    <= total.cast("decimal(25,0)") * F.col("weight")), "filled")
    given = filled.agg(F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))), F.lit(0))
                       .cast("decimal(38,0)")).scalar()
    open_weight = filled.agg(F.sum(F.when(~F.col("_full"), F.col("weight")))).scalar()
    target = F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(
        (total - given).cast("double") * F.col("weight") / open_weight)
    return filled.select(source, "source_size", "weight", target.alias("target"))


def offsets(source: str, seed: int) -> Column:
    """The offsets a source may get: a random one (five hex digits of a digest over 16 ** 5) and
    those at even steps from it."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(source), F.lit("\x00null"))))
    first = F.conv(F.substring(digest, 1, 5), 16, 10).cast("double") / float(16 ** 5)
    return F.array(*[first + i / OFFSETS for i in range(OFFSETS)])


def _crossed(start: Column, position: Column) -> Column:
    """Whole numbers crossed by the step that ends at ``position``."""
    return (F.floor(start + position * F.col("_rate"))
            - F.floor(start + (position - 1.0) * F.col("_rate")))


def mix(docs: DataFrame, size: str, source: str = "source", key: str = "doc_id",
        seed: int = 11, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS,
        ties: Sequence[str] = (), rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Every row of ``docs`` with ``source_size``, ``target`` and ``copies``.

    ``size`` is a long column without nulls. Null is a source of its own, the last one. Documents of
    a source without any word have one copy each (there is nothing to share). Rows with equal
    source, size and key are ordered by ``ties``; rows equal in those too are interchangeable. Reruns
    agree. Of a few seeded offsets a source gets the one whose words taken are nearest its target;
    what is left of the distance is about half its largest document at most.
    The added columns replace columns of the same name; an empty table gives an empty result.
    """
    docs = docs.drop("source_size", "target", "copies")
    kept = docs.columns
    counted = docs.groupBy(source).agg(F.sum(size).alias("source_size"), F.count("*").alias("_n"))
    counted = settle(counted, "source-sizes")
    aims = source_targets(counted, source, weights, most)
    plan = settle(
        aims.join(counted.select(F.col(source).alias("_s"), "_n"),
                  aims[source].eqNullSafe(F.col("_s")))
        .select("_s", "source_size", "target",
                F.ceil(F.col("_n") / rows_per_bucket).alias("_buckets"),
                F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                .otherwise(1.0).alias("_rate"),
                offsets("_s", seed).alias("_offsets")), "plan")

    digest = F.md5(F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("")),
                               F.col(size).cast("string")))
    placed = docs.join(plan, F.col(source).eqNullSafe(F.col("_s"))).withColumn(
        "_key", digest).withColumn(
        "_bucket", F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") % F.col("_buckets"))
    narrow = docs.select(F.col(source).alias("_source"), F.col(size).alias("_size"),
                         digest.alias("_key")).join(
        plan, F.col("_source").eqNullSafe(F.col("_s"))).withColumn(
        "_bucket", F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") % F.col("_buckets"))
    before = Window.partitionBy("_s").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = settle(
        narrow.groupBy("_s", "_bucket").agg(F.count("*").alias("_rows"))
        .select(F.col("_s").alias("_t"), F.col("_bucket").alias("_b"),
                F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")), "starts")
    position = (F.col("_start") + F.col("_rank")).cast("double")

    def numbered(rows: DataFrame, *order: str) -> DataFrame:
        inside = Window.partitionBy("_s", "_bucket").orderBy(*order)
        return rows.withColumn("_rank", F.row_number().over(inside)).join(
            starts, F.col("_s").eqNullSafe(F.col("_t")) & (F.col("_bucket") == F.col("_b")))
    # the words that each offset would take, from the narrow rows
    taken = numbered(narrow, "_size", "_key").groupBy("_s", "target").agg(F.array(*[
        F.sum(_crossed(F.col("_offsets")[i], position) * F.col("_size")) for i in range(OFFSETS)])
        .alias("_taken"))
    misses = F.transform("_taken", lambda t, i: F.struct(
        F.abs(t - F.col("target")).alias("miss"), i.alias("i")))
    chosen = settle(taken.select(F.col("_s").alias("_c"), F.array_min(misses)["i"].alias("_i")),
                    "offsets")
    best = numbered(placed, size, "_key", *ties).join(chosen, F.col("_s").eqNullSafe(F.col("_c")))
    copies = _crossed(F.get("_offsets", F.col("_i")), position)
    return best.select(*kept, "source_size", "target", copies.alias("copies"))


def emit(mixed: DataFrame) -> DataFrame:
    """Each row as often as its ``copies`` say."""
    return (mixed.filter("copies > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .drop("_copy"))
