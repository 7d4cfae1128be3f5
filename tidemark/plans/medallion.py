"""The whole flow over one lake folder."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tidemark.learning.training import TrainSettings
from tidemark.plans.fixed import MIRRORS
from tidemark.plans.gold import gold_checks, missing_silver, silver_to_gold
from tidemark.plans.incremental import FACTS, raw_files, refresh, silver_students, start_ledger
from tidemark.plans.model import score_and_save, train_and_save
from tidemark.plans.publish import publish_dashboard
from tidemark.plans.silver import raw_to_silver
from tidemark.session import scratch, settle
from tidemark.sources.artifacts import load_latest, run_stamp
from tidemark.sources.tables import (
    ensure_database, mirror, read_partitioned, register_table)


def run_flow(spark: SparkSession, lake: str, schemas: Mapping[str, str], silver_db: str,
             gold_db: str, retrain: bool = False, settings: TrainSettings = TrainSettings(),
             incremental: bool = False) -> dict[str, Any]:
    """Raw files under ``<lake>/raw`` to published aggregates under ``<lake>/web``.

    Full overwrite, so a run can be repeated. With ``incremental`` new period files go into the
    facts that are there (:mod:`tidemark.plans.incremental`); without any the run ends at once, and
    it is a full run where that is not possible. Training happens on request; without a model the
    scores are skipped and the descriptive aggregates are published alone. A source that is absent
    is left out; when the facts cannot be built without it, the flow ends after the silver tables
    and names it under ``missing``. Intermediate tables are deleted at the end.
    """
    with scratch(spark):
        run_id = run_stamp()
        added = refresh(spark, lake, run_id) if incremental else None
        if added is not None:
            paths = {name: f"{lake}/gold/{name}" for name in FACTS}
            if not added["files"]:
                return {"run_id": run_id, "gold": paths, "added": added}
            for name, path in paths.items():
                register_table(spark, f"{gold_db}.{name}", path, ["anio"])
            out = _results(spark, lake, run_id, silver_students(spark, lake), paths, retrain,
                           settings)
            return {"run_id": run_id, "gold": paths, "added": added, **out}
        return _run(spark, lake, schemas, silver_db, gold_db, run_id, retrain, settings)


def _run(spark: SparkSession, lake: str, schemas: Mapping[str, str], silver_db: str, gold_db: str,
         run_id: str, retrain: bool, settings: TrainSettings) -> dict[str, Any]:
    silver, gold = f"{lake}/silver", f"{lake}/gold"
    files = settle(raw_files(spark, f"{lake}/raw"), "raw-files")
    ensure_database(spark, silver_db)
    for name in raw_to_silver(spark, f"{lake}/raw", silver, run_id, schemas):
        register_table(spark, f"{silver_db}.{name}", f"{silver}/{name}")
    ensure_database(spark, gold_db)
    mirrored = mirror(spark, MIRRORS, silver_db, gold, run_id)
    missing = missing_silver(spark, silver)
    if missing:
        return {"run_id": run_id, "mirrored": mirrored, "gold": {}, "missing": missing}
    paths = silver_to_gold(spark, silver, gold, run_id)
    for name, path in paths.items():
        register_table(spark, f"{gold_db}.{name}", path,
                       ["anio"] if name.startswith("fact_") else [])
    start_ledger(spark, lake, files)
    out = _results(spark, lake, run_id, spark.read.parquet(f"{silver}/estudiantes"), paths,
                   retrain, settings)
    return {"run_id": run_id, "mirrored": mirrored, "gold": paths, **out}


def _results(spark: SparkSession, lake: str, run_id: str, students: DataFrame,
             paths: dict[str, str], retrain: bool, settings: TrainSettings) -> dict[str, Any]:
    """Model, scores and publication from the facts."""
    gold, models = f"{lake}/gold", f"{lake}/models/churn"
    semester = read_partitioned(spark, paths["fact_estudiante_semestre"])
    if retrain:
        train_and_save(spark, semester, models, run_id, settings=settings)
    scores = score_and_save(spark, paths["fact_estudiante_semestre"], models,
                            f"{gold}/ml_predictions_desertion", run_id)
    latest = load_latest(spark, models)
    manifest = publish_dashboard(spark, semester, f"{lake}/web", run_id, scores,
                                 latest[1] if latest else None)
    return {"manifest": manifest, "checks": gold_checks(spark, students, paths)}
