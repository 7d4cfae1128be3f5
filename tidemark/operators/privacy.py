"""Publishable aggregates: churn counts, rates with confidence rules, small-cell suppression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import half_even, null_unless, rate_pct
from tidemark.operators.lookup import coverage
from tidemark.operators.reshape import tidy_dimensions
from tidemark.session import settle

# Thresholds of the publication rules and the label of merged cells.
MIN_CELL = 10
MIN_RATE_N = 30
MERGED = "OTROS"

COUNTS = ("enrolled", "evaluable", "churned")


def churn_aggregates(entity: str, target: str) -> list[Column]:
    """Distinct entities, rows with a known target, and churned rows."""
    return [F.countDistinct(entity).alias("enrolled"),
            F.count(target).alias("evaluable"),
            F.coalesce(F.sum(F.col(target).cast("bigint")), F.lit(0)).alias("churned")]


def churn_counts(df: DataFrame, dims: Sequence[str], entity: str, target: str) -> DataFrame:
    """The churn triple per group.

    The single distinct aggregate is planned on (dims, entity) first, so a group that holds
    most rows is spread over the entities.
    """
    return df.groupBy(*dims).agg(*churn_aggregates(entity, target))


def with_rate(counts: DataFrame, min_rate_n: int = MIN_RATE_N) -> DataFrame:
    """Add ``churn_pct`` and ``low_confidence``.

    A homogeneous cell (nobody or everybody churned) publishes no rate.
    """
    homogeneous = (F.col("churned") == 0) | (F.col("churned") == F.col("evaluable"))
    return counts.withColumns({
        "churn_pct": null_unless(~homogeneous, rate_pct(F.col("churned"), F.col("evaluable"))),
        "low_confidence": homogeneous | (F.col("evaluable") < min_rate_n)})


def suppress(cells: DataFrame, child: str, parents: Sequence[str] = (),
             min_cell: int = MIN_CELL, merged: str = MERGED, strict: bool = False) -> DataFrame:
    """Merge small cells into one, with complementary suppression inside each parent.

    Cells below ``min_cell`` merge. The merged cell needs two members and ``min_cell`` entities;
    where it lacks either, the smallest of the other cells (ties by name) joins it. One is always
    enough: every such cell has ``min_cell`` entities by itself. So three plain aggregates per
    parent decide, and neither an ordered window nor a loop is needed. Null parents drop out,
    null children stay; the child comes back as text. When all cells of a parent merge, the result may still be small;
    ``strict`` withholds it.
    """
    parents = list(parents)
    for parent in parents:
        cells = cells.filter(F.col(parent).isNotNull())
    # the merged label is text, so the child becomes text whatever it was
    cells = settle(cells.withColumn(child, F.col(child).cast("string")), "cells")
    small = F.col("enrolled") < min_cell
    rule = cells.groupBy(*parents).agg(F.struct(
        F.count_if(small).alias("n_small"),
        F.sum(F.when(small, F.col("enrolled")).otherwise(0)).alias("sum_small"),
        F.min(F.when(~small, F.struct("enrolled", child))).alias("next")).alias("_rule"))
    placed = cells.join(rule, parents) if parents else cells.withColumn("_rule", rule.scalar())
    short = (F.col("_rule.n_small") > 0) & ((F.col("_rule.n_small") < 2)
                                            | (F.col("_rule.sum_small") < min_cell))
    moved = F.struct("enrolled", child).eqNullSafe(F.col("_rule.next"))
    label = F.when(small | (short & moved), F.lit(merged)).otherwise(F.col(child))
    out = (placed.withColumn("_label", label).withColumn("_merged", small | (short & moved))
           .groupBy(*parents, "_label", "_merged")
           .agg(*[F.sum(c).alias(c) for c in COUNTS]))
    if strict:
        out = out.filter(~F.col("_merged") | (F.col("enrolled") >= min_cell))
    return out.select(*parents, F.col("_label").alias(child), *COUNTS)


def suppressed_rates(df: DataFrame, dims: Sequence[str], entity: str, target: str,
                     min_cell: int = MIN_CELL, min_rate_n: int = MIN_RATE_N) -> DataFrame:
    """Counts by ``dims``, suppression of the last one inside the others, rates."""
    *parents, child = dims
    cells = churn_counts(df, dims, entity, target)
    return with_rate(suppress(cells, child, parents, min_cell), min_rate_n)


def period_trend(df: DataFrame, periods: Sequence[str], entity: str, target: str) -> DataFrame:
    """Counts and rate per period; null periods drop out."""
    known = df.dropna(subset=list(periods))
    return with_rate(churn_counts(known, periods, entity, target))


def demographic_table(df: DataFrame, dims: Sequence[str], entity: str, target: str,
                      min_cell: int = MIN_CELL) -> DataFrame:
    """Tidy table of several dimensions, each suppressed on its own."""
    tidy = tidy_dimensions(df, dims, [entity, target])
    return suppressed_rates(tidy, ["dimension", "category"], entity, target, min_cell)


def regional_context(df: DataFrame, region: str, entity: str, target: str, code: str,
                     means: Sequence[str], min_cell: int = MIN_CELL,
                     min_coverage: float = 0.5) -> DataFrame:
    """Rate per region with mean context columns, blanked where few rows have a code."""
    known = df.filter(F.col(region).isNotNull())
    regions = known.groupBy(region).agg(
        *churn_aggregates(entity, target),
        *[F.avg(m).alias(m) for m in means], coverage(known, code).alias("_coverage"))
    regions = with_rate(regions.filter(F.col("enrolled") >= min_cell))
    covered = F.col("_coverage") >= min_coverage
    return regions.withColumns({m: null_unless(covered, half_even(F.col(m), 4))
                                for m in means}).drop("_coverage")


def current_risk(scores: DataFrame, attributes: DataFrame, entity: str, t: str,
                 dims: Sequence[str], label: str, band: str = "band", score: str = "score",
                 high: str = "alto", min_cell: int = MIN_CELL) -> DataFrame:
    """Risk by group in the last scored period: entities, high-risk rows, mean score."""
    now = scores.agg(F.max(t)).scalar()
    current = scores.filter(F.col(t) == now)
    profile = attributes.filter(F.col(t) == now).select(entity, *dims)
    joined = current.select(entity, band, score, label).join(profile, entity, "left")
    groups = (joined.dropna(subset=list(dims)).groupBy(*dims).agg(
        F.countDistinct(entity).alias("n_entities"),
        F.count_if(F.col(band) == high).alias("n_high"),
        half_even(F.avg(score), 4).alias("mean_score"),
        F.max(label).alias(label)).filter(F.col("n_entities") >= min_cell))
    homogeneous = (F.col("n_high") == 0) | (F.col("n_high") == F.col("n_entities"))
    return groups.withColumns({
        "high_pct": null_unless(~homogeneous, rate_pct(F.col("n_high"), F.col("n_entities"))),
        "low_confidence": homogeneous})


def rate_gap(tidy: DataFrame, dimension: str, low: Sequence[str], high: Sequence[str]) -> Column:
    """Pooled rate of the low categories minus that of the high ones, in points, as a scalar.

    Computed on published cells; null where a side has nothing evaluable.
    """
    def pooled(values: Sequence[str]) -> Column:
        inside = F.col("category").isin(list(values))
        return F.try_divide(F.sum(F.when(inside, F.col("churned"))).cast("double"),
                            F.sum(F.when(inside, F.col("evaluable"))).cast("double")) * 100.0

    return (tidy.filter(F.col("dimension") == dimension)
            .agg(half_even(pooled(low) - pooled(high), 2)).scalar())


def kpi_rows(trend: DataFrame, t: str, gaps: dict[str, Column],
             extra: dict[str, Column] | None = None) -> DataFrame:
    """``id, value`` rows: overall rate, retention, enrolment of the last period, gaps, extras."""
    base = trend.agg(
        F.sum("churned").alias("_churned"), F.sum("evaluable").alias("_evaluable"),
        F.max_by("enrolled", t).cast("double").alias("matricula_ultimo_semestre"))
    overall = F.try_divide(F.col("_churned").cast("double"),
                           F.col("_evaluable").cast("double")) * 100.0
    named = {**gaps, **(extra or {})}
    wide = base.select(
        half_even(overall, 2).alias("tasa_desercion"),
        half_even(100.0 - overall, 2).alias("tasa_retencion"),
        "matricula_ultimo_semestre",
        *[c.cast("double").alias(k) for k, c in named.items()])
    return wide.unpivot([], wide.columns, "id", "value")
