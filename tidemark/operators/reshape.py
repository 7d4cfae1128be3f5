"""Wide to long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import label_or_missing


def melt(df: DataFrame, ids: Sequence[str], var: str, value: str,
         columns: Sequence[str] | None = None) -> DataFrame:
    """Wide to long; null values stay."""
    columns = list(columns) if columns else [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), columns, var, value)


def tidy_dimensions(df: DataFrame, dims: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per input row and dimension: ``dimension, category`` plus the kept columns.

    One scan and one later aggregation serve all dimensions.
    """
    labelled = df.select(*keep, *[label_or_missing(F.col(d)).alias(d) for d in dims])
    return labelled.unpivot(list(keep), list(dims), "dimension", "category")
