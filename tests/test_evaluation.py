import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators.evaluation import (
    evaluate, group_error_rates, pr_curve, pr_points, score_counts, tune_threshold)
from tidemark.operators import ordered


def brute(y, s):
    """(threshold, precision, recall) on ascending thresholds, cut at the first full recall."""
    out = []
    for t in np.unique(s):
        hit = s >= t
        out.append((t, y[hit].mean(), y[hit].sum() / y.sum()))
    full = [i for i, p in enumerate(out) if p[2] == 1.0]
    return out[full[-1]:]


@pytest.fixture(scope="module", params=[1, 2, 3])
def scored(spark, request):
    rng = np.random.default_rng(request.param)
    y = rng.integers(0, 2, 600)
    s = np.round(np.clip(rng.normal(0.35 + 0.3 * y, 0.2), 0, 1), 2)
    df = spark.createDataFrame(list(zip(y.tolist(), s.tolist())), "y int, s double")
    return y, s, score_counts(df, "s", "y")


def test_areas_and_confusion_equal_brute_force(scored):
    y, s, counts = scored
    m = evaluate(counts, 0.5).first()
    ap, last = 0.0, 0.0
    for t in np.unique(s)[::-1]:
        hit = s >= t
        recall = y[hit].sum() / y.sum()
        ap, last = ap + (recall - last) * y[hit].mean(), recall
    pos, neg = s[y == 1], s[y == 0]
    roc = np.mean([(pos > n).mean() + (pos == n).mean() / 2 for n in neg])
    assert m["pr_auc"] == pytest.approx(ap, abs=1e-12)
    assert m["roc_auc"] == pytest.approx(roc, abs=1e-12)
    hit = s >= 0.5
    assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (
        y[hit].sum(), (1 - y[hit]).sum(), y[~hit].sum(), (1 - y[~hit]).sum())


@pytest.mark.parametrize("p", [0.3, 0.6, 0.8, 0.95, 1.01])
def test_threshold_equals_brute_force(scored, p):
    y, s, counts = scored
    points = brute(y, s)
    feasible = [q for q in points if q[1] >= p]
    if feasible:
        best = max(feasible, key=lambda q: (q[2], -q[0]))
    else:
        best = max(points, key=lambda q: (2 * q[1] * q[2] / max(q[1] + q[2], 1e-9), -q[0]))
    got = tune_threshold(counts, p).first()
    assert got["threshold"] == best[0]
    assert got["oof_precision"] == pytest.approx(best[1])
    assert got["criterion"].startswith("max recall" if feasible else "max F1")


def test_curve_is_thinned_and_ends_at_recall_zero(scored):
    y, s, counts = scored
    points = brute(y, s)
    got = [tuple(r) for r in pr_curve(counts, 10).orderBy("position").collect()]
    full = [(i, a, b) for i, (_, a, b) in enumerate(points)] + [(len(points), 1.0, 0.0)]
    step = max(1, len(full) // 10)
    assert got == [pytest.approx(p) for p in full[::step]]


def test_distributed_curve_equals_the_small_one(scored, monkeypatch):
    _, _, counts = scored
    small = sorted(map(tuple, pr_points(counts).select("score", "tp", "selected").collect()))
    monkeypatch.setattr(ordered.running_totals, "__defaults__", ((), False, 7))
    large = sorted(map(tuple, pr_points(counts).select("score", "tp", "selected").collect()))
    assert small == large


def test_undefined_rates_are_zero(spark):
    df = spark.createDataFrame([(0, 0.1)] * 5, "y int, s double")
    m = evaluate(score_counts(df, "s", "y"), 0.5).first()
    assert (m["precision"], m["recall"], m["f1"], m["roc_auc"]) == (0.0, 0.0, 0.0, None)


def test_error_rates_leave_small_groups_out(spark):
    df = spark.createDataFrame([("a", 1, 1)] * 60 + [("a", 1, 0)] * 40 + [("b", 0, 1)] * 99
                               + [(None, 1, 1)] * 200, "g string, y int, p int")
    assert [tuple(r) for r in group_error_rates(df, ["g"], "y", "p").collect()] == [
        ("g", "a", 100, 1.0, 0.6, 1.0)]
