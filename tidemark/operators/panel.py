"""Entity-by-period panels: calendar, de-duplication, churn target, history as of a period.

A period is an integer ordinal of a calendar, so an entity has at most one panel row per
calendar period however many raw rows it has. Every operator first folds the raw rows to that
grain with a partial (map-side) aggregation; only then is anything grouped by entity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def attach_calendar(df: DataFrame, calendar: DataFrame, key: str) -> DataFrame:
    """Inner join to the calendar; rows of unknown periods drop out.

    A calendar is an inline or tiny table, which Catalyst broadcasts by its size.
    """
    return df.join(calendar, key, "inner")


def unknown_periods(df: DataFrame, calendar: DataFrame, key: str) -> DataFrame:
    """Rows per period code that :func:`attach_calendar` drops."""
    return (df.groupBy(key).agg(F.count("*").alias("n_rows"))
            .join(calendar.select(key), key, "left_anti"))


def dedup_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = (),
                 keep: str = "first") -> DataFrame:
    """One row per key: the first (or last) by ``order`` and then by all other columns.

    A minimum over structs combines on the map side, so a key with a huge number of copies
    sends one row per task instead of all of them to one task. Maps, which have no order, are
    compared by their JSON text.
    """
    rest = [c for c in df.columns if c not in keys]
    maps = [c for c in rest if "map<" in df.schema[c].dataType.simpleString()]
    ranks = [c.alias(f"_k{i}") for i, c in enumerate(order)]
    if maps:
        pick = {"first": F.min_by, "last": F.max_by}[keep]
        by = F.struct(*ranks, *[F.to_json(c).alias(c) if c in maps else F.col(c) for c in rest])
        best = df.groupBy(*keys).agg(pick(F.struct(*rest), by).alias("_best"))
    else:
        pick = {"first": F.min, "last": F.max}[keep]
        best = df.groupBy(*keys).agg(pick(F.struct(*ranks, *rest)).alias("_best"))
    return best.select(*[F.col(k) if k in keys else F.col(f"_best.{k}") for k in df.columns])


def last_period(df: DataFrame, t: str) -> Column:
    """The last observed period as a scalar subquery: no driver round trip, no join."""
    return df.agg(F.max(t)).scalar()


def churn_panel(df: DataFrame, entity: str, t: str, last: Column | None = None) -> DataFrame:
    """Panel ``entity, t`` with the right-censored target and the history up to ``t``.

    ``churned_next``: null in the last observed period, 0 when the entity is present in the
    very next period, else 1 (a skipped period counts as churn). The periods of an entity travel
    as one small sorted array, which costs a single shuffle with map-side combining.
    """
    last = last_period(df, t) if last is None else last
    folded = (df.groupBy(entity).agg(F.array_sort(F.collect_set(t)).alias("_ts"))
              .select(entity, "_ts", F.posexplode("_ts").alias("_i", t)))
    following = F.get("_ts", F.col("_i") + 1)
    previous = F.get("_ts", F.col("_i") - 1)
    return folded.select(
        entity, t,
        following.alias("next_t"),
        _target(F.col(t), following, last).alias("churned_next"),
        (F.col("_i") + 1).cast("bigint").alias("periods_so_far"),
        (F.col(t) - previous).alias("gap_since_previous"),
        F.when(previous.isNull(), 1).otherwise(0).alias("is_first_period"))


def _target(now: Column, following: Column, last: Column) -> Column:
    return (F.when(now >= last, F.lit(None).cast("int"))
            .when(following.isNull(), F.lit(1))
            .when(following == now + 1, F.lit(0)).otherwise(F.lit(1)))


def attach_panel(facts: DataFrame, panel: DataFrame, entity: str, t: str) -> DataFrame:
    """Left join of panel columns on (entity, t)."""
    return facts.join(panel, [entity, t], "left")


def with_panel_columns(facts: DataFrame, entity: str, t: str, last: Column | None = None) -> DataFrame:
    """The columns of :func:`churn_panel` on every row of a fact that is already unique per
    (entity, period): one exchange on the entity, no separate panel and no join back.

    The distinct periods of the entity come from an unordered window, so the rows are not sorted
    by ``t``, and whole-history windows on the entity share the same pass. Rows of an entity are
    bounded by the calendar. (``sort_array`` is generated code, ``array_sort`` compares by a lambda.)
    """
    last = last_period(facts, t) if last is None else last
    periods = F.sort_array(F.collect_set(t).over(Window.partitionBy(entity)))
    placed = facts.withColumn("_ts", periods)
    placed = placed.withColumn("_i", F.array_position("_ts", F.col(t)).cast("int"))
    previous = F.get("_ts", F.col("_i") - 2)
    return (placed.withColumn("next_t", F.get("_ts", F.col("_i")))
            .withColumns({
                "churned_next": _target(F.col(t), F.col("next_t"), last),
                "periods_so_far": F.col("_i").cast("bigint"),
                "gap_since_previous": F.col(t) - previous,
                "is_first_period": F.when(previous.isNull(), 1).otherwise(0)})
            .drop("_ts", "_i"))


def with_entity_history(facts: DataFrame, entity: str, t: str) -> DataFrame:
    """Whole-history columns per entity on a fact unique per (entity, period).

    For reports only: they look into the future and must not become features.
    """
    whole = Window.partitionBy(entity)
    return (facts.withColumns({
                "total_periods": F.count(entity).over(whole),
                "first_t": F.min(t).over(whole),
                "last_t": F.max(t).over(whole)})
            .withColumn("presence_ratio", F.col("total_periods").cast("double")
                        / (F.col("last_t") - F.col("first_t") + 1).cast("double")))


def pick_per_period(facts: DataFrame, entity: str, t: str, priority: Sequence[Column],
                    count_as: str = "n_in_period") -> DataFrame:
    """One row per (entity, t), the first by ``priority`` then by all columns, and the row count.

    A single aggregation with map-side combining gives both the survivor and the count.
    """
    keys = [entity, t]
    rest = [c for c in facts.columns if c not in keys]
    ranked = F.struct(*[c.alias(f"_k{i}") for i, c in enumerate(priority)], *rest)
    best = facts.groupBy(*keys).agg(F.min(ranked).alias("_best"), F.count("*").alias(count_as))
    return best.select(*keys, *[F.col(f"_best.{c}") for c in rest], count_as)


def rank_of(col: Column, ordered_values: Sequence[str]) -> Column:
    """Position of a value in a priority list; values outside it share the last place."""
    out = None
    for i, value in enumerate(ordered_values, start=1):
        hit = F.when(col == value, i) if out is None else out.when(col == value, i)
        out = hit
    return out.otherwise(len(ordered_values) + 1)
