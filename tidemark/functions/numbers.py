"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(col: Column) -> Column:
    """Bad numbers become null (``cast`` would raise under ANSI)."""
    return col.try_cast("double")


def to_long(col: Column) -> Column:
    return col.try_cast("bigint")


def half_even(col: Column, digits: int = 2) -> Column:
    """Round like numpy and pandas: scale, round half to even, scale back."""
    scale = float(10 ** digits)
    return F.rint(col * scale) / F.lit(scale)


def half_up(col: Column, digits: int = 2) -> Column:
    """Round like SQL ``ROUND``."""
    return F.round(col, digits)


def null_unless(condition: Column, col: Column) -> Column:
    return F.when(condition, col)


def rate_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part / whole`` in percent; null for an empty whole."""
    return half_even(F.try_divide(part.cast("double"), whole.cast("double")) * 100.0, digits)


def band_by_cuts(col: Column, cuts: Column) -> Column:
    """0 for zero, then 1, 2, 3 by two cut points. Fill nulls first: a null falls in band 3."""
    return (F.when(col == 0, 0).when(col < F.get(cuts, F.lit(0)), 1)
            .when(col < F.get(cuts, F.lit(1)), 2).otherwise(3))


# Names of the risk bands.
HIGH, MEDIUM, LOW = "alto", "medio", "bajo"


def risk_band(score: Column, threshold: Column | float) -> Column:
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (F.when(score >= limit, HIGH).when(score >= limit * 0.5, MEDIUM).otherwise(LOW))


def presence_ratio(periods: Column, first: Column, last: Column) -> Column:
    """Periods present over the periods between first and last."""
    return periods.cast("double") / (last - first + F.lit(1)).cast("double")
