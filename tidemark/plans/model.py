"""Train and score on the modelling table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.learning.features import FeatureSpec
from tidemark.learning.training import TrainSettings, score_batch, train
from tidemark.plans.fixed import CHURN_SPEC
from tidemark.sources.artifacts import load_latest, save_artifacts
from tidemark.sources.tables import read_partitioned, write_scores


def train_and_save(spark: SparkSession, table: DataFrame, root: str, run_id: str,
                   spec: FeatureSpec = CHURN_SPEC,
                   settings: TrainSettings = TrainSettings()) -> dict:
    model, metrics, schema = train(table, spec, run_id, settings)
    save_artifacts(spark, root, run_id, model, metrics, schema)
    return metrics


def score_and_save(spark: SparkSession, table_path: str, model_root: str, out_path: str,
                   run_id: str) -> DataFrame | None:
    """Score every period with the latest model; without a model nothing is written."""
    latest = load_latest(spark, model_root)
    if latest is None:
        return None
    model, metrics, schema = latest
    scores = score_batch(read_partitioned(spark, table_path), model, metrics, schema, run_id,
                         ["anio", "semestre_academico", "semestre_orden"])
    write_scores(scores, out_path)
    return read_partitioned(spark, out_path)
