"""Running totals, ranks and exact quantiles that do not funnel all rows through one task.

A global ordered window would sort everything in one partition. Here the rows are range
partitioned first, every range runs its own window, and the totals of the ranges before it are
added. The ranges are cut on the whole order (groups, then all order columns), so neither a group
nor a value that holds a third of the rows makes a range larger than the others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import settle

ROWS_PER_RANGE = 1_000_000


def in_ranges(table: DataFrame, sort: Sequence[Column], ranges: int) -> DataFrame:
    """Add ``_range``, numbers of sampled ranges of about equal size that follow ``sort``.

    Settled, so that every reader sees the same ranges.
    """
    return settle(table.repartitionByRange(ranges, *sort)
                  .withColumn("_range", F.spark_partition_id()), "ranges")


def running_totals(table: DataFrame, order: Sequence[str], sums: Mapping[str, str],
                   groups: Sequence[str] = (), descending: bool = False,
                   rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add inclusive running sums ``{out: column}`` along ``order`` within ``groups``.

    ``order`` must be a total order within a group, without nulls. ``table`` is read twice: pass
    a settled one. The number of ranges follows from the number of rows alone; the totals of the
    ranges are added up by this same function while they are more than one range holds.
    """
    sort = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    part = [F.col(g) for g in groups] or [F.lit(0)]
    ranges = max(1, -(-table.count() // rows_per_range))
    placed = in_ranges(table, [*map(F.col, groups), *sort], ranges)
    keys = [*groups, "_range"]
    totals = placed.groupBy(*keys).agg(*[F.sum(c).alias(f"_t_{out}") for out, c in sums.items()])
    if ranges > max(2, rows_per_range):
        added = running_totals(
            settle(totals.withColumnRenamed("_range", "_place"), "totals"), ["_place"],
            {f"_u_{out}": f"_t_{out}" for out in sums}, groups,
            rows_per_range=rows_per_range).withColumnRenamed("_place", "_range")
        earlier = {out: F.coalesce(F.col(f"_u_{out}") - F.col(f"_t_{out}"), F.lit(0))
                   for out in sums}
    else:  # a group has at most `ranges` rows here
        before = Window.partitionBy(*part).orderBy("_range").rowsBetween(
            Window.unboundedPreceding, -1)
        added = totals
        earlier = {out: F.coalesce(F.sum(f"_t_{out}").over(before), F.lit(0)) for out in sums}
    offsets = added.select(*[F.col(k).alias(f"_o_{k}") for k in keys],
                           *[value.alias(f"_before_{out}") for out, value in earlier.items()])
    inside = Window.partitionBy(*keys).orderBy(*sort).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = placed.withColumns({out: F.sum(c).over(inside) for out, c in sums.items()})
    same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys])
    return local.join(offsets, same).select(
        *table.columns, *[(F.col(out) + F.col(f"_before_{out}")).alias(out) for out in sums])


def ranked(table: DataFrame, order: Sequence[str], out: str, groups: Sequence[str] = (),
           descending: bool = False, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Row numbers from 1 along a total order, as :func:`running_totals`."""
    counted = running_totals(table.withColumn("_one", F.lit(1)), order, {out: "_one"}, groups,
                             descending, rows_per_range)
    return counted.drop("_one")


def value_counts_table(df: DataFrame, value: str, groups: Sequence[str] = ()) -> DataFrame:
    """Settled ``groups, value, n`` of the non-null values."""
    return settle(df.filter(F.col(value).isNotNull()).groupBy(*groups, value)
                  .agg(F.count("*").alias("n")), "values")


def exact_quantiles(counts: DataFrame, value: str, probs: Mapping[str, float],
                    groups: Sequence[str] = (), rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Linearly interpolated quantiles per group from a :func:`value_counts_table`.

    Exact at any size: the running count tells which value sits at a position, so no group is
    held in memory.
    """
    cumulative = running_totals(counts, [value], {"_cum": "n"}, groups,
                                rows_per_range=rows_per_range)
    sizes = counts.groupBy(*groups).agg(F.sum("n").alias("_rows"))
    sizes = sizes.withColumnsRenamed({g: f"_s_{g}" for g in groups})
    if groups:
        on = reduce(lambda a, b: a & b,
                    [F.col(g).eqNullSafe(F.col(f"_s_{g}")) for g in groups])
        placed = cumulative.join(sizes, on)
    else:
        placed = cumulative.withColumn("_rows", sizes.scalar())

    start = F.col("_cum") - F.col("n")

    def at(position):
        return F.max(F.when((start <= position) & (position < F.col("_cum")), F.col(value)))

    picks = []
    for name, p in probs.items():
        position = (F.col("_rows") - 1) * F.lit(float(p))
        picks += [at(F.floor(position)).alias(f"_lo_{name}"),
                  at(F.ceil(position)).alias(f"_hi_{name}"),
                  F.max(position - F.floor(position)).alias(f"_f_{name}")]
    wide = placed.groupBy(*groups).agg(F.max("_rows").alias("n_rows"), *picks)
    blend = [(F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_f_{n}"))
             .alias(n) for n in probs]
    return wide.select(*groups, "n_rows", *blend)
