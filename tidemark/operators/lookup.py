"""Resolving names to codes and enriching facts by code.

Lookup tables are aggregates. They are settled before a join, so Catalyst knows their true
size: below the broadcast threshold the facts are not shuffled at all, beyond it the join
sort-merges and AQE splits hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import band_by_cuts, to_double
from tidemark.functions.text import canonical_place
from tidemark.operators.ordered import running_totals, value_counts_table
from tidemark.session import settle


def code_table(df: DataFrame, place: str, region: str, code: Column) -> DataFrame:
    """One code (the largest) per canonical (place, region).

    Spellings are folded as they are first, so the canonical form is worked out once per
    distinct spelling and not once per row. The fold is a distinct, which is hashed, where the
    largest of strings per group would sort all rows; it is settled, as the optimizer leaves out a
    distinct below a maximum.
    """
    spelled = settle(df.select(F.col(place).alias("_place"), F.col(region).alias("_region"),
                               code.alias("code")).distinct(), "spellings")
    return (spelled.select(canonical_place(F.col("_place")).alias("place"),
                           canonical_place(F.col("_region")).alias("region"), "code")
            .groupBy("place", "region").agg(F.max("code").alias("code")))


def place_codes(df: DataFrame, place: str, region: str, codes: DataFrame,
                names: Sequence[str] = ("place_norm", "region_norm"), out: str = "code") -> DataFrame:
    """Settled lookup from the raw spelling of a place to its canonical names and code.

    One row per distinct spelling in ``df`` (only the two columns are read); join it with
    :func:`enrich_by_place`.
    """
    pairs = df.select(F.col(place).alias("_raw_place"), F.col(region).alias("_raw_region")).distinct()
    named = pairs.withColumns({names[0]: canonical_place(F.col("_raw_place")),
                               names[1]: canonical_place(F.col("_raw_region"))})
    return settle(resolve_code(named, codes, names[0], names[1], out), "places")


def enrich_by_place(facts: DataFrame, places: DataFrame, place: str, region: str) -> DataFrame:
    """Left join of :func:`place_codes` on the raw spelling, missing parts included."""
    on = (F.col(place).eqNullSafe(F.col("_raw_place"))
          & F.col(region).eqNullSafe(F.col("_raw_region")))
    return facts.join(places, on, "left").drop("_raw_place", "_raw_region")


def unique_places(codes: DataFrame) -> DataFrame:
    """Places whose name has exactly one code in the whole country."""
    return (codes.groupBy("place").agg(F.countDistinct("code").alias("n_codes"),
                                       F.max("code").alias("only_code"))
            .filter(F.col("n_codes") == 1).select("place", "only_code"))


def resolve_code(facts: DataFrame, codes: DataFrame, place: str, region: str,
                 out: str = "code") -> DataFrame:
    """Code by (place, region), else by a nationally unique place name, else null.

    ``codes`` should be a settled or stored :func:`code_table`.
    """
    exact = codes.select(F.col("place").alias("_p"), F.col("region").alias("_r"),
                         F.col("code").alias("_exact"))
    national = unique_places(codes).select(F.col("place").alias("_u"),
                                           F.col("only_code").alias("_only"))
    joined = facts.join(exact, (F.col(place) == F.col("_p")) & (F.col(region) == F.col("_r")),
                        "left")
    joined = joined.join(settle(national, "unique_places"), F.col(place) == F.col("_u"), "left")
    return joined.withColumn(out, F.coalesce("_exact", "_only")).drop(
        "_p", "_r", "_u", "_exact", "_only")


def rates_by_code(df: DataFrame, code: Column, rates: Mapping[str, str],
                  count_as: str = "population") -> DataFrame:
    """Mean of permissively cast columns ``{out: column}`` and the row count per code."""
    return df.groupBy(code.alias("code")).agg(
        *[F.avg(to_double(F.col(c))).alias(out) for out, c in rates.items()],
        F.count("*").alias(count_as))


def enrich_by_code(facts: DataFrame, lookup: DataFrame, code: str,
                   lookup_code: str = "code") -> DataFrame:
    """Left join of a lookup on its code."""
    side = lookup.withColumnRenamed(lookup_code, "_lookup_code")
    return facts.join(side, F.col(code) == F.col("_lookup_code"), "left").drop("_lookup_code")


def latest_rows(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Rows of the latest snapshot per key by descending ``order``; ties stay, nulls come last.

    The latest value per key is an aggregate with map-side combining; a ranking window would
    sort all rows of a hot key in one task.
    """
    newest = settle(df.groupBy(F.col(key).alias("_key"))
                    .agg(F.max(F.struct(*order)).alias("_newest")), "newest")
    on = F.col(key).eqNullSafe(F.col("_key")) & F.struct(*order).eqNullSafe(F.col("_newest"))
    return df.join(newest, on, "left_semi")


def latest_totals(df: DataFrame, key: str, order: Sequence[str], value: str) -> DataFrame:
    """Sum of ``value`` over the latest snapshot per key, and the snapshot's first order column.

    Two aggregations: first per (key, snapshot), which spreads a hot key, then the newest.
    """
    per_snapshot = df.groupBy(key, *order).agg(F.sum(value).alias("_total"))
    newest = per_snapshot.groupBy(key).agg(F.max(F.struct(*order, "_total")).alias("_s"))
    return newest.select(key, F.col("_s._total").alias("latest_total"),
                         F.col(f"_s.{order[0]}").alias(f"latest_{order[0]}"))


def quantile_cuts(df: DataFrame, value: str, probs: Sequence[float] = (0.33, 0.66)) -> Column:
    """Cut points over the positive values as a scalar subquery; zeros when there are none.

    The exact discrete quantiles: the smallest value with at least the share of the rows up to it.
    """
    counts = value_counts_table(df.filter(F.col(value) > 0), value)
    reached = running_totals(counts, [value], {"_upto": "n"})
    rows = F.coalesce(counts.agg(F.sum("n")).scalar(), F.lit(0))
    # decimals, as 0.33 * n in binary may pass a whole number
    cuts = reached.agg(F.array(*[
        F.min(F.when(F.col("_upto") >= rows * F.lit(Decimal(str(p))), F.col(value)))
        for p in probs]).alias("cuts")).scalar()
    zero = F.lit(0).cast(dict(df.dtypes)[value])
    return F.array(*[F.coalesce(F.get(cuts, F.lit(i)), zero) for i in range(len(probs))])


def band_column(facts: DataFrame, value: str, cuts: Column, out: str = "band") -> DataFrame:
    """Fill missing values with 0, then 0 / low / middle / high by the cut points."""
    return facts.fillna(0, subset=[value]).withColumn(out, band_by_cuts(F.col(value), cuts))


def coverage(df: DataFrame, col: str) -> Column:
    """Share of non-null values, as an aggregate expression."""
    return F.avg(F.col(col).isNotNull().cast("double"))
