"""Histogram boosting against a plain search over all splits."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pyspark.ml import PipelineModel
from tidemark.learning import boosting, models, trees
from tidemark.learning.boosting import MISSING, BinPlan, BoostSettings, fit_trees, plan_bins
from tidemark.learning.models import fit_balanced, tree_pipeline, with_score
from tidemark.operators.evaluation import evaluate, score_counts

PLAN = BinPlan({"x": [1.0, 2.0, 3.0], "z": [0.5]}, {"c": ["a", "b", "d"]})


def made(n=400, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x = None if rng.random() < 0.3 else float(rng.integers(0, 5))
        z = [None, float("nan"), 0.0, 1.0][rng.integers(0, 4)]
        c = ["a", "b", "d", "new", None][rng.integers(0, 5)]
        chance = 0.8 if x is None else 0.7 if c in ("a", "d") and x > 2 else 0.15
        rows.append((i, x, z, c, int(rng.random() < chance), float(rng.integers(1, 3))))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, x double, z double, c string, y int, w double")


def bins_of(row):
    _, x, z, c, *_ = row
    def number(v, cuts):
        return MISSING if v is None or math.isnan(v) else sum(v > t for t in cuts)
    return [number(x, PLAN.cuts["x"]), number(z, PLAN.cuts["z"]),
            PLAN.categories["c"].index(c) if c in PLAN.categories["c"] else MISSING]


def plain_fit(rows, s):
    """Splits of a greedy search, node by node."""
    bins = [bins_of(r) for r in rows]
    y, w = np.array([r[4] for r in rows]), np.array([r[5] for r in rows])
    f = np.full(len(rows), math.log((w * y).sum() / (w * (1 - y)).sum()))
    out = []
    for tree in range(s.trees):
        p = 1 / (1 + np.exp(-f))
        g, h = (p - y) * w, p * (1 - p) * w
        step = np.zeros(len(rows))
        todo = [(1, np.arange(len(rows)))]
        for node, at in todo:
            best = None
            for k in range(3):
                of = np.array([bins[i][k] for i in at])
                there = sorted(set(of) - {MISSING})
                if k == 2:
                    there.sort(key=lambda b: (g[at][of == b].sum() / (h[at][of == b].sum() + 10), b))
                for place in range(len(there)):
                    for missing_left in (False, True):
                        left = np.isin(of, there[:place + 1]) | ((of == MISSING) & missing_left)
                        lg, lh = g[at][left].sum(), h[at][left].sum()
                        rg, rh = g[at][~left].sum(), h[at][~left].sum()
                        gain = round((lg ** 2 / (lh + s.l2) + rg ** 2 / (rh + s.l2)
                                      - (lg + rg) ** 2 / (lh + rh + s.l2)) / 2, 9)
                        if min(lh, rh) >= s.min_hessian and gain > s.min_gain \
                                and (best is None or gain > best[0] + 1e-8):
                            best = (gain, k, missing_left, left, -lg / (lh + s.l2) * s.rate,
                                    -rg / (rh + s.l2) * s.rate)
            if best is None:
                continue
            gain, k, missing_left, left, a, b = best
            out.append((tree, node, k, missing_left, a, b, gain))
            todo += [(2 * node, at[left]), (2 * node + 1, at[~left])] \
                if 2 * node < 2 ** s.depth else []
            for side, value in ((left, a), (~left, b)):
                step[at[side]] = value
        f = f + step
    return sorted(out), f


def test_trees_equal_a_plain_search(spark):
    rows = made()
    s = BoostSettings(trees=3, depth=2, rate=0.3, settle_every=2)
    model = fit_trees(frame(spark, rows).repartition(5), "y", PLAN, s, weight="w")
    want, margins = plain_fit(rows, s)
    got = sorted((r["tree"], r["node"], r["feature"], r["missing_left"], r["left_value"],
                  r["right_value"], r["gain"]) for r in model.splits)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4:] for g in got], [w[4:] for w in want], atol=1e-6)
    assert any(r["missing_left"] for r in model.splits)
    assert any(r["left_bins"] for r in model.splits)
    scored = model.with_score(frame(spark, rows)).orderBy("id").toPandas()["score"]
    assert np.allclose(scored, 1 / (1 + np.exp(-margins)), atol=1e-6)
    table = model.table(spark)
    assert table.count() == len(model.splits) and table.filter("tree = 0 and node = 1").count() == 1


def test_no_rows_one_class_and_unseen_values(spark):
    rows = frame(spark, made(30))
    none = fit_trees(rows.limit(0), "y", PLAN)
    assert none.splits == [] and none.start == 0.0
    ones = fit_trees(rows.withColumn("y", F.lit(1)), "y", PLAN)
    assert ones.splits == [] and ones.start > 3
    assert {round(r["score"], 6) for r in ones.with_score(rows).collect()} == {
        round(1 / (1 + math.exp(-ones.start)), 6)}
    plan = plan_bins(rows.withColumn("e", F.lit(None).cast("double")), ["x", "z", "e"], {}, bins=4)
    assert plan.cuts["e"] == [] and plan.cuts["z"][-1] <= 1.0 and len(plan.cuts["x"]) <= 3


def test_as_good_as_filled_trees_where_missing_tells(spark):
    train, test = frame(spark, made(3000, 1)), frame(spark, made(1500, 2))
    cats = {"c": ["a", "b", "d", "new", "none"]}
    fill = {"c": F.coalesce("c", F.lit("none")), "z": F.nanvl("z", F.lit(None).cast("double"))}
    settings = BoostSettings(trees=10, depth=3, rate=0.2)
    native = fit_trees(train, "y", plan_bins(train, ["x", "z"], cats), settings)
    filled = fit_balanced(tree_pipeline(["x", "z"], cats, "y", trees=10, depth=3),
                          train.withColumns(fill), "y")

    def area(scored):
        return evaluate(score_counts(scored, "score", "y"), 0.5).first()["pr_auc"]
    ours, theirs = area(native.with_score(test)), area(with_score(filled, test.withColumns(fill)))
    assert ours > theirs - 0.01 and ours > 0.6


def test_equal_rows_reach_the_trees_once(spark, monkeypatch):
    rows = spark.createDataFrame([(i % 40, float(i % 8), i % 2) for i in range(400)],
                                 "id int, x double, y int")
    seen = []

    class Learner:
        def getFeaturesCol(self): return "x"
        def getLabelCol(self): return "y"
        def getWeightCol(self): return "w"
        def fit(self, df): seen.append(sorted(tuple(r) for r in df.select("x", "y", "w").collect()))

    models.FoldedRows(Learner())._fit(rows.withColumn("w", F.lit(0.5)))
    assert seen == [[(float(x), x % 2, 25.0) for x in range(8)]]

    kept = []
    monkeypatch.setattr(boosting, "settle", lambda df, label: kept.append(df.count()) or df)
    plan = boosting.BinPlan({"x": [3.5]})
    boosting.fit_trees(rows, "y", plan, boosting.BoostSettings(trees=1, depth=1))
    assert kept == [4]


def test_bins_part_few_values_and_leave_a_constant_whole(spark):
    rows = spark.range(1000).select(F.when(F.col("id") == 7, 9.0).otherwise(F.col("id") % 2)
                                    .alias("a"), F.lit(3.0).alias("b"), F.col("id").cast("double")
                                    .alias("c"))
    made = models.Binner(["a", "b", "c"], ["p", "q", "r"], 8)._fit(rows).transform(rows)
    assert [made.select(c).distinct().count() for c in ("p", "q", "r")] == [3, 1, 8]


def filled(spark, n=1500):
    cats = {"c": ["a", "b", "d", "new", "none"]}
    fill = {"c": F.coalesce("c", F.lit("none")), "z": F.nanvl("z", F.lit(None).cast("double"))}
    rows = frame(spark, made(n)).withColumns(fill).withColumn("v", F.rand(3)).localCheckpoint()
    return rows, tree_pipeline(["x", "z", "v"], cats, "y", trees=12, depth=4)


def test_held_rows_give_the_trees_of_spark(spark, monkeypatch, tmp_path):
    """Sets of bins and categories, a cut of the flag, a constant flag, weights, leaves, gains."""
    rows, pipeline = filled(spark)

    def of(model):
        return [r["score"] for r in with_score(model, rows).orderBy("id").collect()]
    held = fit_balanced(pipeline, rows, "y")
    monkeypatch.setattr(trees, "MOST_ROWS", 10)
    own = fit_balanced(pipeline, rows, "y")
    ours, theirs = held.stages[-1], own.stages[-1]
    assert np.allclose(of(held), of(own), atol=1e-9)
    assert [t.numNodes for t in ours.trees] == [t.numNodes for t in theirs.trees]
    assert any("<=" in t.toDebugString for t in ours.trees)
    assert np.allclose(ours.featureImportances.toArray(), theirs.featureImportances.toArray())
    held.write().save(str(tmp_path / "m"))
    assert of(PipelineModel.load(str(tmp_path / "m"))) == of(held)


def test_a_fit_is_few_jobs(spark):
    """Not two stages per level of a tree, whose tasks the driver starts and remembers."""
    rows, pipeline = filled(spark, 300)
    spark.sparkContext.setJobGroup("one fit", "")
    try:
        fit_balanced(pipeline, rows, "y")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("one fit")) < 40


def test_spark_grows_trees_in_no_more_tasks_than_run_at_once(spark, monkeypatch):
    monkeypatch.setattr(models, "ROWS_PER_TASK", 10)
    slots = spark.sparkContext.defaultParallelism
    spread = [models._spread(spark.range(n)).rdd.getNumPartitions() for n in (5, 20, 5000)]
    assert spread == [1, 2, slots]
    monkeypatch.setattr(models, "MOST_ROWS", 100)
    assert models._spread(spark.range(5000)).rdd.getNumPartitions() == 50


def test_trees_refuse_what_is_no_whole_number_and_labels_beside_0_and_1():
    inputs = trees.Inputs([3], [True])
    with pytest.raises(ValueError, match="whole"):
        trees.Grower(np.array([[3]], np.uint8), np.ones(1), np.ones(1), inputs)
    with pytest.raises(ValueError, match="labels"):
        trees.Grower(np.array([[1]], np.uint8), np.full(1, 2.0), np.ones(1), inputs)
    one = trees.Grower(np.ones((4, 1), np.uint8), np.ones(4), np.ones(4), inputs)
    assert [len(t) for t in one.boosted(2, 5, 0.1)] == [1, 1]
