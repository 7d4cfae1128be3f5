import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.lookup import quantile_cuts
from tidemark.operators.ordered import (
    exact_quantiles, in_ranges, ranked, running_totals, value_counts_table)


@pytest.fixture(scope="module")
def table(spark):
    """Distinct values per group; two thirds of all values sit in a narrow span."""
    rng = np.random.default_rng(5)
    near = rng.choice(4000, 1000, replace=False) / 1e6
    wide = rng.choice(100000, 500, replace=False) / 1000.0 + 1
    data = [(g, float(v), int(rng.integers(1, 9)))
            for g, vs in (("a", near), ("b", wide), (None, wide[:200])) for v in vs]
    return spark.createDataFrame(data, "g string, v double, n long").cache()


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("limit", [20, 60, 10**6])  # 20: the ranges' totals are added in ranges
def test_running_totals_by_group(table, limit, descending):
    got = running_totals(table, ["v"], {"cum": "n"}, ["g"], descending, limit).toPandas()
    want = table.toPandas().sort_values("v", ascending=not descending)
    want["cum"] = want.groupby("g", dropna=False)["n"].cumsum()
    keys = ["g", "v"]
    pd.testing.assert_frame_equal(
        got.sort_values(keys).reset_index(drop=True)[["g", "v", "n", "cum"]],
        want.sort_values(keys).reset_index(drop=True)[["g", "v", "n", "cum"]])


def test_distributed_path_has_many_ranges(table):
    plan = running_totals(table, ["v"], {"cum": "n"}, (), rows_per_range=60)
    assert "_range" in plan._jdf.queryExecution().toString()
    last = plan.agg(F.max("cum")).first()[0]
    assert last == table.agg(F.sum("n")).first()[0]


def test_ranks_break_ties_by_second_column(spark):
    data = [(float(i // 50), i) for i in range(500)]
    df = spark.createDataFrame(data, "v double, k int")
    got = rows(ranked(df, ["v", "k"], "r", rows_per_range=40).select("k", "r"), "k")
    assert got == [(i, i + 1) for i in range(500)]


@pytest.mark.parametrize("limit", [50, 10**6])
def test_exact_quantiles_equal_numpy(spark, limit):
    rng = np.random.default_rng(9)
    values = np.round(rng.exponential(10, 2000), 1)
    values[:700] = 3.0  # one value holds a third of the rows
    group = rng.choice(["x", "y"], 2000)
    df = spark.createDataFrame(list(zip(group.tolist(), values.tolist())), "g string, v double")
    counts = value_counts_table(df, "v", ["g"])
    got = {r["g"]: r for r in exact_quantiles(counts, "v", {"q1": .25, "q2": .5, "q9": .9},
                                              ["g"], limit).collect()}
    for g in "xy":
        want = np.quantile(values[group == g], [.25, .5, .9])
        assert [got[g]["q1"], got[g]["q2"], got[g]["q9"]] == pytest.approx(list(want))
        assert got[g]["n_rows"] == (group == g).sum()


def test_a_hot_value_is_spread_over_ranges(spark):
    """Two thirds of the rows share one value: the second order column cuts them."""
    data = [(1.0 if i < 800 else float(i), i) for i in range(1200)]
    df = spark.createDataFrame(data, "v double, k int")
    placed = in_ranges(df, [F.col("v"), F.col("k")], 12)
    sizes = [r["count"] for r in placed.groupBy("_range").count().collect()]
    assert sum(sizes) == 1200 and max(sizes) <= 400
    out = ranked(df, ["v", "k"], "r", rows_per_range=100)
    assert rows(out.select("k", "r"), "k") == [(i, i + 1) for i in range(1200)]


def test_cuts_are_the_exact_discrete_quantiles(spark):
    df = spark.range(-50, 100_700).select((F.col("id") * 7).alias("x")).repartition(9)
    positive = [7 * i for i in range(1, 100_700)]
    want = [positive[-(-100_699 * p // 100) - 1] for p in (33, 66)]
    got = spark.range(1).select(quantile_cuts(df, "x").alias("c")).first()["c"]
    assert got == want
    nothing = spark.range(1).select(quantile_cuts(df.filter("x < 0"), "x").alias("c")).first()["c"]
    assert nothing == [0, 0]
