"""Training protocol: holdout first, out-of-fold threshold, one look at the holdout."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import risk_band
from tidemark.functions.text import OTHER, UNKNOWN
from tidemark.learning.features import (
    FeatureSpec, apply_categories, build_features, freeze_categories)
from tidemark.learning.importance import permutation_importance
from tidemark.learning.models import (
    baseline_pipeline, fit_balanced, observed_numerics, tree_pipeline, with_score)
from tidemark.learning.splits import group_folds, in_holdout
from tidemark.operators.evaluation import (
    cv_summary, evaluate, pr_curve, score_counts, tune_threshold)
from tidemark.operators.profiles import dataset_summary, union_all
from tidemark.session import settle


@dataclass(frozen=True)
class TrainSettings:
    trees: int = 100
    depth: int = 5
    folds: int = 5
    holdout: float = 0.2
    min_precision: float = 0.80
    goal_f1: float = 0.80
    repeats: int = 5
    seed: int = 42
    parallelism: int = 5


@dataclass(frozen=True)
class Frames:
    """Labelled rows, settled once: training and holdout part, and what was frozen on training."""

    train: DataFrame
    test: DataFrame
    labelled: DataFrame
    categories: dict[str, list[str]]
    numeric: list[str]


def prepare(df: DataFrame, spec: FeatureSpec, settings: TrainSettings) -> Frames:
    """Features, grouped holdout and frozen categories."""
    spec.check(df.columns)
    wanted = list(dict.fromkeys([spec.entity, spec.period, spec.target, *spec.features]))
    labelled = build_features(df, spec).filter(F.col(spec.target).isNotNull()).select(
        *wanted, in_holdout(F.col(spec.entity), settings.holdout, settings.seed).alias("_test"))
    # every fit reads these rows many times: AQE sizes the files by their bytes
    labelled = settle(labelled.withColumn(spec.target, F.col(spec.target).cast("int"))
                      .hint("rebalance", spec.entity, spec.period), "labelled")
    categories = freeze_categories(labelled.filter(~F.col("_test")), spec)
    mapped = apply_categories(labelled, categories)
    train = mapped.filter(~F.col("_test")).drop("_test")
    test = mapped.filter("_test").drop("_test")
    return Frames(train, test, mapped.drop("_test"), categories,
                  observed_numerics(train, spec.numeric))


def out_of_fold_scores(frames: Frames, spec: FeatureSpec, settings: TrainSettings) -> DataFrame:
    """``fold, target, score`` of the training rows, each scored by a model that never saw its
    entity. One fit per fold; the rows are united, not collected."""
    folds = settle(group_folds(frames.train, spec.entity, spec.target, settings.folds,
                               settings.seed), "folds")
    rows = settle(frames.train.join(folds, spec.entity)
                  .hint("rebalance", spec.entity, spec.period), "foldrows")
    pipeline = tree_pipeline(frames.numeric, frames.categories, spec.target, "boosted",
                             settings.trees, settings.depth)

    def score_fold(k: int) -> DataFrame:
        model = fit_balanced(pipeline, rows.filter(F.col("fold") != k), spec.target)
        return (with_score(model, rows.filter(F.col("fold") == k))
                .select("fold", spec.target, "score"))

    # the fits submit their jobs side by side, as CrossValidator does
    with ThreadPoolExecutor(max(1, settings.parallelism)) as pool:
        parts = list(pool.map(score_fold, range(settings.folds)))
    return settle(union_all(parts), "oof")


def fold_metrics(oof: DataFrame, target: str) -> DataFrame:
    return evaluate(score_counts(oof, "score", target, ["fold"]), 0.5, ["fold"]).select(
        "fold", F.col("n").alias("n_val"), F.col("prevalence").alias("prevalence_val"),
        F.col("f1").alias("f1_default"), "pr_auc")


def _as_dict(df: DataFrame) -> dict[str, Any]:
    """A one-row result as a plain dictionary."""
    return df.first().asDict(recursive=True)


def _metrics(df: DataFrame, score: str, target: str, threshold: float) -> dict[str, Any]:
    flat = _as_dict(evaluate(score_counts(df, score, target), threshold))
    flat["confusion_matrix"] = {k: flat.pop(k) for k in ("tn", "fp", "fn", "tp")}
    return flat


def temporal_scores(frames: Frames, spec: FeatureSpec, settings: TrainSettings) \
        -> tuple[DataFrame, list] | None:
    """Settled scores of the last labelled period by a model of the others, and the periods; None
    if a side is empty."""
    periods = sorted(r[0] for r in frames.labelled.select(spec.period).distinct()
                     .toLocalIterator())
    if len(periods) < 2:
        return None
    early = frames.labelled.filter(F.col(spec.period) < periods[-1])
    late = frames.labelled.filter(F.col(spec.period) == periods[-1])
    model = fit_balanced(
        tree_pipeline(observed_numerics(early, frames.numeric), frames.categories, spec.target,
                      "boosted", settings.trees, settings.depth), early, spec.target)
    return settle(with_score(model, late), "late"), periods


def temporal_check(scored: tuple[DataFrame, list] | None, target: str, threshold: float) \
        -> dict[str, Any] | None:
    """Metrics of :func:`temporal_scores`."""
    if scored is None:
        return None
    late, periods = scored
    return {**_metrics(late, "score", target, threshold),
            "train_semestres": periods[:-1], "test_semestre": periods[-1]}


def train(df: DataFrame, spec: FeatureSpec, run_id: str,
          settings: TrainSettings = TrainSettings()) \
        -> tuple[PipelineModel, dict[str, Any], dict[str, Any]]:
    """Model, metrics document and feature schema.

    What reaches the driver are one-row metrics, the fold table, the thinned curve and the
    importances; all have a fixed size.
    """
    spark = df.sparkSession
    frames = prepare(df, spec, settings)
    target = spec.target

    def fit_all() -> PipelineModel:
        return fit_balanced(tree_pipeline(frames.numeric, frames.categories, target, "boosted",
                                          settings.trees, settings.depth), frames.train, target)

    def baseline_scores() -> DataFrame:
        baseline = baseline_pipeline(frames.numeric, frames.categories, target,
                                     float(frames.train.count()))
        return with_score(fit_balanced(baseline, frames.train, target), frames.test)

    # none of these fits needs another: their many small jobs run beside those of the folds
    with ThreadPoolExecutor(3 if settings.parallelism > 1 else 1) as pool:
        whole = pool.submit(fit_all)
        early = pool.submit(temporal_scores, frames, spec, settings)
        plain = pool.submit(baseline_scores)
        oof = out_of_fold_scores(frames, spec, settings)
        model, late, base_scores = whole.result(), early.result(), plain.result()
    folds = settle(fold_metrics(oof, target), "foldmetrics")
    tuned = _as_dict(tune_threshold(score_counts(oof, "score", target), settings.min_precision))
    limit = tuned["threshold"]

    test = settle(with_score(model, frames.test), "holdout")
    holdout = _metrics(test, "score", target, limit)

    importance = permutation_importance(
        model, frames.test, [spec.entity, spec.period],
        [*frames.numeric, *frames.categories], target, settings.repeats, settings.seed)
    curve = pr_curve(score_counts(test, "score", target)).orderBy("position")

    summary = _as_dict(dataset_summary(df, spec.entity, target))
    by_period = (df.filter(F.col(target).isNotNull()).groupBy(spec.period).count()
                 .orderBy(spec.period).collect())
    metrics = {
        "run_id": run_id,
        "trained_at": datetime.now(timezone.utc).isoformat(),
        "model": "GBTClassifier",
        "library_versions": {"spark": spark.version},
        "dataset": {"rows_total": summary["rows_total"],
                    "rows_labeled": summary["rows_labelled"],
                    "prevalence": summary["prevalence"], "n_students": summary["n_entities"],
                    "semestres": {str(r[0]): r[1] for r in by_period}},
        "validation": {"holdout_fraction": settings.holdout, "grouped_by": spec.entity,
                       "kfold": {**_as_dict(cv_summary(folds)),
                                 "oof": _metrics(oof, "score", target, limit),
                                 "folds": [r.asDict() for r in folds.orderBy("fold").collect()]}},
        "threshold": tuned,
        "test": holdout,
        "temporal": temporal_check(late, target, limit),
        "baseline_logreg_test": _metrics(base_scores, "score", target, limit),
        "permutation_importance": [r.asDict() for r in importance.orderBy(
            F.desc("importance_mean"), "feature").collect()],
        "pr_curve_test": [{"precision": r["precision"], "recall": r["recall"]}
                          for r in curve.collect()],
        "target_goal": {"f1": settings.goal_f1, "precision": settings.min_precision,
                        "goal_met": holdout["f1"] >= settings.goal_f1
                        and holdout["precision"] >= settings.min_precision},
    }
    schema = feature_schema(spec, frames.categories, run_id, spark.version)
    return model, metrics, schema


def feature_schema(spec: FeatureSpec, categories: dict[str, list[str]], run_id: str,
                   spark_version: str) -> dict[str, Any]:
    """The feature contract as a document, frozen at training and read back at scoring."""
    return {
        "run_id": run_id, "entity": spec.entity, "period": spec.period, "target": spec.target,
        "numeric_features": list(spec.numeric), "logs": dict(spec.logs),
        "categorical_features": list(spec.categorical), "categories": categories,
        "excluded_leakage": list(spec.barred), "unknown_category": UNKNOWN,
        "other_category": OTHER, "spark_version": spark_version,
    }


def spec_of(schema: dict[str, Any]) -> FeatureSpec:
    """The feature contract back from its stored form."""
    return FeatureSpec(schema["entity"], schema["period"], schema["target"],
                       schema["numeric_features"], schema["categorical_features"],
                       schema["logs"], schema["excluded_leakage"])


def score_batch(df: DataFrame, model: PipelineModel, metrics: dict[str, Any],
                schema: dict[str, Any], run_id: str, keep: list[str]) -> DataFrame:
    """Scores of all rows with band, threshold and provenance."""
    spec = spec_of(schema)
    frame = apply_categories(build_features(df, spec), schema["categories"])
    limit = float(metrics["threshold"]["threshold"])
    scored = with_score(model, frame, "score_riesgo")
    return scored.select(
        F.col(spec.entity).cast("string").alias("id"), *keep, "score_riesgo",
        risk_band(F.col("score_riesgo"), limit).alias("banda_riesgo"),
        F.lit(limit).alias("threshold"), F.lit(schema["run_id"]).alias("model_version"),
        F.lit(run_id).alias("_predict_run_id"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("_predicted_at"))
