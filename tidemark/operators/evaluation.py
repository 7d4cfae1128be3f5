"""Binary-classifier evaluation from a table of scores: curve, areas, threshold, error rates.

Rows are folded to distinct scores first; everything after works on that table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import ranked, running_totals
from tidemark.session import settle


def score_counts(df: DataFrame, score: str, label: str, groups: Sequence[str] = ()) -> DataFrame:
    """Settled ``groups, score, p, n``: positives and rows per distinct score."""
    return settle(df.groupBy(*groups, F.col(score).cast("double").alias("score"))
                  .agg(F.sum(F.col(label).cast("bigint")).alias("p"),
                       F.count("*").alias("n")), "scores")


def pr_points(counts: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Adds ``tp, selected, precision, recall`` for every distinct score as the threshold."""
    totals = counts.groupBy(*groups).agg(F.sum("p").alias("pos"), F.sum("n").alias("rows"))
    points = running_totals(counts, ["score"], {"tp": "p", "selected": "n"}, groups,
                            descending=True)
    if groups:
        points = points.join(totals, list(groups))
    else:
        both = totals.select(F.struct("pos", "rows").alias("s")).scalar()
        points = points.withColumns({"pos": both["pos"], "rows": both["rows"]})
    return points.withColumns({
        "precision": F.col("tp") / F.col("selected"),
        "recall": F.try_divide(F.col("tp").cast("double"), F.col("pos").cast("double"))})


def pr_curve(counts: DataFrame, points: int = 200) -> DataFrame:
    """The precision-recall curve on ascending thresholds, thinned to every k-th point.

    Thresholds below the first that reaches full recall do not belong to the curve, and it ends
    at precision 1, recall 0.
    """
    curve = settle(_candidates(pr_points(counts)).select("score", "precision", "recall"), "curve")
    size = curve.count()
    step = max(1, (size + 1) // points)
    thinned = (ranked(curve, ["score"], "_rank").withColumn("position", F.col("_rank") - 1)
               .select("position", "precision", "recall"))
    end = curve.sparkSession.range(1).select(
        F.lit(size).cast("bigint").alias("position"), F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"))
    return thinned.unionByName(end).filter(F.col("position") % step == 0)


def _candidates(points: DataFrame) -> DataFrame:
    return points.filter((F.col("tp") < F.col("pos")) | (F.col("p") > 0))


# How the metrics document words the criterion.
SAFE_CRITERION = "max recall s.t. precision>={limit}"
FALLBACK_CRITERION = "max F1 (NINGUN threshold alcanzo precision>={limit} en OOF)"


def tune_threshold(counts: DataFrame, min_precision: float = 0.80) -> DataFrame:
    """One row: the threshold of highest recall with ``precision >= min_precision`` (the lowest
    of equals), else that of highest F1, with the criterion as text."""
    points = _candidates(pr_points(counts))
    f1 = (F.col("precision") * F.col("recall") * 2.0
          / F.greatest(F.col("precision") + F.col("recall"), F.lit(1e-9)))
    point = F.struct(F.col("score").alias("threshold"), F.col("precision").alias("oof_precision"),
                     F.col("recall").alias("oof_recall"))
    feasible = F.col("precision") >= min_precision
    best = points.agg(
        F.max(F.when(feasible, F.struct("recall", -F.col("score"), point.alias("point"))))
        .alias("safe"),
        F.max(F.struct(f1.alias("f1"), -F.col("score"), point.alias("point"))).alias("any"))
    return best.select(
        F.coalesce("safe.point", "any.point").alias("point"),
        F.when(F.col("safe").isNotNull(), SAFE_CRITERION.format(limit=min_precision))
        .otherwise(FALLBACK_CRITERION.format(limit=min_precision))
        .alias("criterion")).select("point.*", "criterion")


def evaluate(counts: DataFrame, threshold: float | Column, groups: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and F1 (0 when undefined), ROC-AUC, PR-AUC, confusion, n, prevalence."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    points = pr_points(counts, groups)
    hit = F.col("score") >= limit
    neg = F.col("n") - F.col("p")
    tp_before = F.col("tp") - F.col("p") / 2
    sums = points.groupBy(*groups).agg(
        F.sum(F.when(hit, F.col("p")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, neg).otherwise(0)).alias("fp"),
        F.sum(F.when(hit, 0).otherwise(F.col("p"))).alias("fn"),
        F.sum(F.when(hit, 0).otherwise(neg)).alias("tn"),
        F.sum(F.col("precision") * F.col("p")).alias("_ap"),
        F.sum(neg * tp_before).alias("_roc"))
    pos, negatives = F.col("tp") + F.col("fn"), F.col("fp") + F.col("tn")
    d = "double"
    precision = F.coalesce(F.try_divide(F.col("tp").cast(d), (F.col("tp") + F.col("fp")).cast(d)),
                           F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("tp").cast(d), pos.cast(d)), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(F.col("tp") * 2.0,
                                 F.col("tp") * 2.0 + F.col("fp") + F.col("fn")), F.lit(0.0))
    return sums.select(
        *groups, precision.alias("precision"), recall.alias("recall"), f1.alias("f1"),
        F.try_divide(F.col("_roc").cast(d), pos.cast(d) * negatives.cast(d)).alias("roc_auc"),
        F.try_divide(F.col("_ap"), pos.cast(d)).alias("pr_auc"),
        "tn", "fp", "fn", "tp", (pos + negatives).alias("n"),
        F.try_divide(pos.cast(d), (pos + negatives).cast(d)).alias("prevalence"))


def group_error_rates(df: DataFrame, dims: Sequence[str], label: str, predicted: str,
                      min_rows: int = 100) -> DataFrame:
    """Per dimension and category: n, prevalence, recall, precision; small groups left out.

    Rows without a category drop out of that dimension.
    """
    y, yhat = F.col(label) == 1, F.col(predicted) == 1
    long = (df.select(label, predicted, *[F.col(c).cast("string").alias(c) for c in dims])
            .unpivot([label, predicted], list(dims), "dimension", "category")
            .filter(F.col("category").isNotNull()))
    sums = long.groupBy("dimension", "category").agg(
        F.count("*").alias("n"), F.count_if(y).alias("_pos"), F.count_if(yhat).alias("_sel"),
        F.count_if(y & yhat).alias("_tp")).filter(F.col("n") >= min_rows)

    def share(a: str, b: str) -> Column:
        ratio = F.try_divide(F.col(a).cast("double"), F.col(b).cast("double"))
        return F.rint(F.coalesce(ratio, F.lit(0.0)) * 1000.0) / 1000.0

    return sums.select("dimension", "category", "n", share("_pos", "n").alias("prevalence"),
                       share("_tp", "_pos").alias("recall"),
                       share("_tp", "_sel").alias("precision"))


def cv_summary(folds: DataFrame) -> DataFrame:
    """Mean and population standard deviation over the folds."""
    return folds.agg(
        F.count("*").alias("k"), F.avg("f1_default").alias("f1_mean_default"),
        F.stddev_pop("f1_default").alias("f1_std_default"),
        F.avg("pr_auc").alias("pr_auc_mean"), F.stddev_pop("pr_auc").alias("pr_auc_std"))


def goal_met(metrics: DataFrame, f1: float = 0.80, precision: float = 0.80) -> DataFrame:
    return metrics.withColumn("goal_met",
                              (F.col("f1") >= f1) & (F.col("precision") >= precision))
