"""Replace the rows of some entities in a partitioned table and leave its other partitions alone.

The new partitions are prepared aside: first the new rows (:func:`stage_rows`), then those that stay
(:func:`stage_kept`). :func:`apply_replacement` moves them into the table.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import make_folder, replace_folder


def same_entity(a: DataFrame, b: DataFrame, entity: str) -> Column:
    """Equal entities; null is one too."""
    return a[entity].eqNullSafe(b[entity])


def stage_rows(fresh: DataFrame, by: str, staged: str) -> None:
    """Write the new rows of the touched entities to ``staged``, over what was there.

    Rows that come from a shuffle are in tasks of a size that AQE chose; they are not moved again.
    """
    fresh.write.mode("overwrite").partitionBy(by).parquet(staged)


def stage_kept(spark: SparkSession, path: str, touched: DataFrame, entity: str, by: str,
               staged: str) -> list[Any]:
    """Add to the rows in ``staged`` those of other entities in the partitions that change.

    These are the partitions in which an entity of ``touched`` (one column, distinct) has or had
    rows. Returns their values, which are few; the table itself is not changed. A partition that
    has no rows left is an empty folder in ``staged``.
    """
    old = spark.read.parquet(path)
    ready = spark.read.schema(old.schema).parquet(staged)
    had = old.select(entity, by).join(touched, same_entity(old, touched, entity), "left_semi")
    values = sorted(r[0] for r in
                    had.select(by).union(ready.select(by)).distinct().toLocalIterator())
    (old.filter(F.col(by).isin(values))
     .join(touched, same_entity(old, touched, entity), "left_anti")
     .write.mode("append").partitionBy(by).parquet(staged))
    for value in values:
        make_folder(spark, f"{staged}/{by}={value}")
    return values


def apply_replacement(spark: SparkSession, path: str, staged: str, by: str,
                      values: list[Any]) -> None:
    """Move the staged partitions in place of the table's; one that has no rows left is removed.

    A partition leaves ``staged`` in the last step, so this can be repeated after a failure at any
    point: what is not there any more is in place.
    """
    for value in values:
        replace_folder(spark, f"{staged}/{by}={value}", f"{path}/{by}={value}")
