"""Publication of aggregate tables with a manifest, and the reader that trusts the manifest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.artifacts import _write_json, artifacts_exist, read_json_document


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame],
            documents: dict[str, Any], manifest: dict[str, Any],
            forbidden: tuple[str, ...] = ("id",),
            order: Mapping[str, Sequence[str]] | None = None) -> dict[str, Any]:
    """Write ``data/<name>`` for every table (CSV) and document (JSON), then the manifest.

    A table is one file, ordered by the columns that ``order`` names or else by its text columns:
    it is an aggregate of a few rows by now. Only aggregates may be published: a table with a forbidden column is refused.
    """
    for name, df in tables.items():
        leaked = sorted(set(df.columns) & set(forbidden))
        if leaked:
            raise ValueError(f"{name} would publish entity columns {leaked}")
    for name, df in tables.items():
        by = (order or {}).get(name) or [c for c, kind in df.dtypes if kind == "string"]
        one = df.repartition(1)
        (one.sortWithinPartitions(*by) if by else one).write.mode("overwrite").option(
            "header", True).csv(f"{root}/data/{name}")
    for name, document in documents.items():
        _write_json(spark, f"{root}/data/{name}", document)
    written = [*tables, *documents, "manifest.json"]
    full = {"generated_at": datetime.now(timezone.utc).isoformat(), **manifest,
            "files": sorted(f"data/{name}" for name in written)}
    _write_json(spark, f"{root}/data/manifest.json", full)
    return full


def read_published(spark: SparkSession, root: str) -> tuple[dict[str, Any], dict[str, DataFrame],
                                                            dict[str, Any]] | None:
    """Manifest, tables and documents it lists; None when nothing was published."""
    if not artifacts_exist(spark, f"{root}/data/manifest.json"):
        return None
    manifest = read_json_document(spark, f"{root}/data/manifest.json")
    tables, documents = {}, {}
    for name in manifest["files"]:
        short = name.removeprefix("data/")
        if short.endswith(".csv"):
            tables[short] = (spark.read.option("header", True).option("inferSchema", True)
                             .csv(f"{root}/{name}"))
        elif short != "manifest.json":
            documents[short] = read_json_document(spark, f"{root}/{name}")
    return manifest, tables, documents


