"""Gold tables to published aggregates."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import to_double
from tidemark.operators.privacy import (
    MIN_CELL, MIN_RATE_N, current_risk, demographic_table, kpi_rows, period_trend, rate_gap,
    regional_context, suppressed_rates)
from tidemark.operators.profiles import ranking
from tidemark.plans.fixed import (
    CONNECTIVITY_HIGH, CONNECTIVITY_LOW, DEMOGRAPHIC_DIMS, KPI_TEXTS, PRIVACY_NOTE,
    PUBLISHED_NAMES, STRATUM_HIGH, STRATUM_LOW, WHOLE_NUMBER_KPIS)
from tidemark.session import settle
from tidemark.sources.publication import publish
from tidemark.sources.tables import literal_rows


def named(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(PUBLISHED_NAMES)


def descriptive_tables(semester: DataFrame, min_cell: int = MIN_CELL) -> dict[str, DataFrame]:
    """Generic names; :func:`publish_dashboard` gives them the published ones."""
    base = semester.withColumns({"desertion_t1": to_double(F.col("desertion_t1")).cast("int"),
                                 "estrato_social": to_double(F.col("estrato_social"))})
    args = ("id", "desertion_t1")
    return {
        "desercion_por_semestre.csv":
            period_trend(base, ["semestre_academico", "semestre_orden"], *args),
        "desercion_por_escuela.csv": suppressed_rates(base, ["escuela"], *args, min_cell),
        "desercion_por_programa.csv":
            suppressed_rates(base, ["escuela", "programa"], *args, min_cell),
        "desercion_demografia.csv": demographic_table(base, DEMOGRAPHIC_DIMS, *args, min_cell),
        "mapa_departamento.csv": regional_context(
            base, "departamento_residencia", *args, "codigo_divipola",
            ["promedio_ipm_mpio", "tasa_informalidad_mpio"], min_cell),
    }


def model_card(metrics: dict[str, Any]) -> dict[str, Any]:
    """The publishable part of the metrics document; its keys are fixed values of the consumer."""
    folds = metrics["validation"]["kfold"]
    return {
        "modelo": metrics["model"], "version": metrics["run_id"],
        "fecha_entrenamiento": metrics["trained_at"],
        "validacion": {"holdout": metrics["validation"]["holdout_fraction"],
                       "kfold": folds["k"], "agrupado_por_estudiante": True},
        "umbral": metrics["threshold"], "test": metrics["test"],
        "cv": {k: folds[k] for k in ("f1_mean_default", "f1_std_default", "pr_auc_mean",
                                     "pr_auc_std")},
        "temporal": metrics.get("temporal"),
        "baseline_logreg_test": metrics.get("baseline_logreg_test"),
        "meta_80_80": metrics.get("target_goal"), "exclusiones": metrics.get("dataset", {}),
        "curva_pr_test": metrics.get("pr_curve_test"),
    }


def publish_dashboard(spark: SparkSession, semester: DataFrame, out: str, run_id: str,
                      scores: DataFrame | None = None, metrics: dict[str, Any] | None = None,
                      min_cell: int = MIN_CELL) -> dict[str, Any]:
    """Write all aggregates, indicators, the model card and the manifest; returns the manifest.

    Without scores or metrics the descriptive part is published alone.
    """
    tables = {k: settle(df, "published") for k, df in
              descriptive_tables(semester, min_cell).items()}
    documents: dict[str, Any] = {}
    extra = {}
    if scores is not None:
        risk = settle(current_risk(
            scores, semester, "id", "semestre_orden", ["escuela", "programa"],
            "semestre_academico", "banda_riesgo", "score_riesgo", min_cell=min_cell), "risk")
        tables["riesgo_por_programa.csv"] = risk
        extra["riesgo_alto"] = risk.agg(F.coalesce(F.sum("n_high"), F.lit(0))).scalar()
    if metrics is not None:
        documents["metricas_modelo.json"] = model_card(metrics)
        importances = literal_rows(
            spark, [(r["feature"], r["importance_mean"], r["importance_std"])
                    for r in metrics["permutation_importance"]],
            "feature string, importance_mean double, importance_std double")
        tables["importancia_variables.csv"] = ranking(importances, "importance_mean", "feature")
        extra["f1_modelo"] = F.lit(round(metrics["test"]["f1"], 3))

    tidy = tables["desercion_demografia.csv"]
    trend = tables["desercion_por_semestre.csv"]
    gaps = {"brecha_estrato": rate_gap(tidy, "estrato_social", STRATUM_LOW, STRATUM_HIGH),
            "brecha_conectividad": rate_gap(tidy, "nivel_conectividad", CONNECTIVITY_LOW,
                                            CONNECTIVITY_HIGH)}
    label = trend.agg(F.max_by("semestre_academico", "semestre_orden")).first()[0]
    kpis = []
    for row in kpi_rows(trend, "semestre_orden", gaps, extra).collect():  # one row per indicator
        title, unit, definition = KPI_TEXTS[row["id"]]
        value = row["value"]
        if value is not None and row["id"] in WHOLE_NUMBER_KPIS:
            value = int(value)
        kpis.append({"id": row["id"], "etiqueta": title, "valor": value, "unidad": unit,
                     "definicion": definition.format(semestre=label)})
    documents["kpis.json"] = kpis
    manifest = {"publish_run_id": run_id, "min_cell_threshold": min_cell,
                "min_rate_n": MIN_RATE_N,
                "model_version": metrics["run_id"] if metrics else None,
                "nota_ley_1581": PRIVACY_NOTE.format(min_cell=min_cell)}
    return publish(spark, out, {k: named(df) for k, df in tables.items()}, documents, manifest,
                   order={"desercion_por_semestre.csv": ["semestre_orden"],
                          "importancia_variables.csv": ["ranking"]})
