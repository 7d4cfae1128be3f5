"""Versioned model artefacts: a Spark ML pipeline plus two JSON documents."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def run_stamp() -> str:
    """UTC run id such as ``20250131T070000Z``."""
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%SZ")


def _write_json(spark: SparkSession, path: str, document: dict[str, Any]) -> None:
    text = json.dumps(document, ensure_ascii=False)
    spark.range(1, numPartitions=1).select(F.lit(text).alias("value")).write.mode(
        "overwrite").text(path)


def read_json_document(spark: SparkSession, path: str) -> dict[str, Any]:
    """One JSON document written by this package (a few kilobytes)."""
    return json.loads(spark.read.text(path).first()["value"])


def artifacts_exist(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)  # resolves the path, reads nothing
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def save_artifacts(spark: SparkSession, root: str, run_id: str, model: PipelineModel,
                   metrics: dict[str, Any], schema: dict[str, Any]) -> None:
    """Write model, metrics and feature schema under ``<run_id>/``, then point ``latest/`` to it.

    ``latest/`` holds the two documents; the schema names the run whose model belongs to them. It
    is written last, so readers see a complete version or the one before.
    """
    model.write().overwrite().save(f"{root}/{run_id}/model")
    for version in (run_id, "latest"):
        _write_json(spark, f"{root}/{version}/metrics.json", metrics)
        _write_json(spark, f"{root}/{version}/feature_schema.json", schema)


def load_latest(spark: SparkSession, root: str) \
        -> tuple[PipelineModel, dict[str, Any], dict[str, Any]] | None:
    """Model, metrics and schema of ``latest/``, or None when nothing was trained yet."""
    base = f"{root}/latest"
    if not artifacts_exist(spark, f"{base}/feature_schema.json"):
        return None
    schema = read_json_document(spark, f"{base}/feature_schema.json")
    metrics = read_json_document(spark, f"{base}/metrics.json")
    require_same_version(schema["spark_version"], spark.version)
    return PipelineModel.load(f"{root}/{schema['run_id']}/model"), metrics, schema


def require_same_version(trained_with: str, running: str) -> None:
    if trained_with != running:
        raise RuntimeError(f"model was trained with Spark {trained_with}, this is {running}: "
                           "train again or align the versions")
