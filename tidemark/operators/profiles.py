"""Profiles and reports over whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import exact_quantiles, ranked, value_counts_table
from tidemark.session import settle


def null_profile(df: DataFrame) -> DataFrame:
    """``column, type, nulls, null_pct`` from one pass over the table."""
    places = [f"c{i}" for i in range(len(df.columns))]  # names may hold dots and quotes
    wide = df.toDF(*places).agg(F.count("*").alias("_rows"),
                                *[F.count_if(F.col(c).isNull()).alias(c) for c in places])
    long = wide.unpivot(["_rows"], places, "_place", "nulls")

    def by_place(values):
        return F.element_at(F.create_map(*[F.lit(x) for pair in zip(places, values, strict=True)
                                           for x in pair]), F.col("_place"))
    return long.select(by_place(df.columns).alias("column"),
                       by_place([kind for _, kind in df.dtypes]).alias("type"), "nulls",
                       (F.try_divide(F.col("nulls").cast("double"),
                                     F.col("_rows").cast("double")) * 100.0).alias("null_pct"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col)


def group_mean(df: DataFrame, group: str, value: str) -> DataFrame:
    return df.groupBy(group).agg(F.count(value).alias("n"), F.avg(value).alias("mean"))


def period_prevalence(df: DataFrame, t: str, target: str) -> DataFrame:
    """Rows and mean target per period; the mean is null where the target is censored."""
    return df.groupBy(t).agg(F.count("*").alias("n"),
                             F.avg(F.col(target).cast("double")).alias("prevalence"))


def period_profile(df: DataFrame, t: str, entity: str, target: str) -> DataFrame:
    return df.groupBy(t).agg(
        F.count(entity).alias("n"), F.countDistinct(entity).alias("entities"),
        F.avg(F.col(target).cast("double")).alias("prevalence"),
        F.avg(F.col(target).isNull().cast("double")).alias("censored"))


def dataset_summary(df: DataFrame, entity: str, target: str) -> DataFrame:
    labelled = F.col(target).isNotNull()
    return df.agg(
        F.count("*").alias("rows_total"), F.count(target).alias("rows_labelled"),
        F.avg(F.col(target).cast("double")).alias("prevalence"),
        F.countDistinct(F.when(labelled, F.col(entity))).alias("n_entities"))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum; empty bins are left out."""
    edges = _range(df, value)
    width = (edges["hi"] - edges["lo"]) / F.lit(float(bins))
    position = F.floor(F.try_divide(F.col(value) - edges["lo"], width)).cast("int")
    bin_no = F.coalesce(F.least(position, F.lit(bins - 1)), F.lit(0))
    counts = (df.filter(F.col(value).isNotNull()).select(bin_no.alias("bin"))
              .groupBy("bin").agg(F.count("*").alias("n")))
    return counts.select("bin", (edges["lo"] + F.col("bin") * width).alias("bin_from"), "n")


def _range(df: DataFrame, value: str) -> Column:
    return df.agg(F.struct(F.min(value).cast("double").alias("lo"),
                           F.max(value).cast("double").alias("hi"))).scalar()


def density(df: DataFrame, value: str, bins: int = 512, grid: int = 200) -> DataFrame:
    """Gaussian kernel density on a grid, from binned counts.

    Bandwidth by Scott's rule; the grid spans the data plus three bandwidths at each side. Work
    per row is one bin number; the bins (at most ``bins``) meet the grid in a fixed-size step.
    """
    stats = df.agg(F.struct(
        F.count(value).alias("n"), F.stddev_samp(value).alias("sd"),
        F.min(value).cast("double").alias("lo"),
        F.max(value).cast("double").alias("hi"))).scalar()
    width = (stats["hi"] - stats["lo"]) / F.lit(float(bins))
    position = F.floor(F.try_divide(F.col(value) - stats["lo"], width)).cast("int")
    bin_no = F.coalesce(F.least(position, F.lit(bins - 1)), F.lit(0))
    counts = (df.filter(F.col(value).isNotNull()).groupBy(bin_no.alias("bin"))
              .agg(F.count("*").alias("n")))
    bandwidth = stats["sd"] * F.pow(stats["n"].cast("double"), F.lit(-0.2))
    step = (stats["hi"] - stats["lo"] + bandwidth * 6.0) / F.lit(float(grid - 1))
    x = stats["lo"] - bandwidth * 3.0 + F.col("point") * step
    center = stats["lo"] + (F.col("bin") + 0.5) * width
    z = (F.col("x") - center) / bandwidth
    weight = (F.col("n") * F.exp(z * z * -0.5)
              / (stats["n"].cast("double") * bandwidth * F.sqrt(F.lit(2.0) * F.pi())))
    return (counts.select("bin", "n", F.explode(F.sequence(F.lit(0), F.lit(grid - 1)))
                          .alias("point"))
            .withColumn("x", x).groupBy("point", "x").agg(F.sum(weight).alias("density")))


def box_summary(df: DataFrame, group: str, value: str) -> DataFrame:
    """Exact quartiles, whiskers (1.5 IQR) and the number of points beyond them per group."""
    counts = value_counts_table(df, value, [group])
    box = exact_quantiles(counts, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [group])
    fence = (F.col("q3") - F.col("q1")) * 1.5
    box = box.withColumns({"_low": F.col("q1") - fence, "_high": F.col("q3") + fence})
    inside = F.col(value).between(F.col("_low"), F.col("_high"))
    return (counts.join(box.withColumnRenamed(group, "_g"),
                        F.col(group).eqNullSafe(F.col("_g")))
            .groupBy(group).agg(
                *[F.max(c).alias(c) for c in ("n_rows", "q1", "median", "q3")],
                F.min(F.when(inside, F.col(value))).alias("whisker_low"),
                F.max(F.when(inside, F.col(value))).alias("whisker_high"),
                F.sum(F.when(~inside, F.col("n")).otherwise(0)).alias("outliers")))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlations, long form, all pairs in one pass."""
    pairs = list(combinations_with_replacement(cols, 2))
    wide = df.agg(*[F.corr(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    both = [(a, b, i) for i, (a, b) in enumerate(pairs)]
    both += [(b, a, i) for i, (a, b) in enumerate(pairs) if a != b]
    cells = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                               F.col(f"p{i}").alias("r")) for a, b, i in both])
    return wide.select(F.inline(cells))


def top_categories(df: DataFrame, cols: Sequence[str], n: int = 200) -> DataFrame:
    """The ``n`` most frequent values per column (ties by value).

    The rank filter is applied per map task before the shuffle (window group limit).
    """
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot(
        [], list(cols), "column", "value").filter(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count("*").alias("n"))
    order = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    return (counts.withColumn("position", F.row_number().over(order))
            .filter(F.col("position") <= n))


def ranking(table: DataFrame, by: str, tie: str, out: str = "ranking") -> DataFrame:
    """Rank from 1 by a numeric column, largest first, ties by another column."""
    keyed = settle(table.withColumn("_neg", -F.col(by)), "ranking")
    return ranked(keyed, ["_neg", tie], out).drop("_neg")


def thin(table: DataFrame, order: Sequence[str], points: int = 200) -> DataFrame:
    """Every k-th row along ``order`` with k = max(1, rows // points)."""
    table = settle(table, "thin")
    step = max(1, table.count() // points)
    numbered = ranked(table, order, "_rank")
    return numbered.filter((F.col("_rank") - 1) % step == 0).drop("_rank")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A repeatable random sample of at most ``n`` rows: the smallest seeded hashes."""
    order = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(order, key).limit(n)


def region_report(df: DataFrame, region: str, means: Mapping[str, Column], target: str,
                  top: int = 20) -> DataFrame:
    """Labelled rows by region: count, means, churned; the ``top`` largest."""
    return (df.filter(F.col(target).isNotNull()).groupBy(region).agg(
        F.count("*").alias("entities"), *[F.avg(c).alias(k) for k, c in means.items()],
        F.sum(F.col(target).cast("bigint")).alias("churned"))
        .orderBy(F.desc("entities"), region).limit(top))


def coverage_report(df: DataFrame, period: str, entity: str, context: str, mean_of: str,
                    target: str) -> DataFrame:
    """Per period: rows, rows with context, mean context (half-up), labelled rows."""
    return df.groupBy(period).agg(
        F.count(entity).alias("entities"), F.count(context).alias("with_context"),
        F.round(F.avg(mean_of), 2).alias("mean_context"),
        F.count(target).alias("labelled")).orderBy(period)


def top_places(df: DataFrame, place: str, entity: str, code: str, mean_of: str,
               top: int = 5) -> DataFrame:
    """The ``top`` places with a code, by rows."""
    return (df.filter(F.col(code).isNotNull()).groupBy(place).agg(
        F.count(entity).alias("entities"), F.round(F.avg(mean_of), 4).alias("mean_value"))
        .orderBy(F.desc("entities"), place).limit(top))


def union_all(parts: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Union by name; ``allow_missing`` makes a column that a part lacks null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), parts)
