"""One key holds most rows: results stay whole and equal to plain computation."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.lookup import code_table, latest_rows, latest_totals
from tidemark.operators.panel import churn_panel, dedup_by_key, pick_per_period
from tidemark.operators.privacy import churn_counts

N = 40_000


@pytest.fixture(scope="module")
def facts(spark):
    """Key 0 owns two thirds of the rows."""
    k = F.when(F.col("i") % 3 == 0, F.col("i") % 97).otherwise(0)
    df = spark.range(N).withColumnRenamed("id", "i").select(
        "i", k.alias("k"), (F.col("i") % 7).cast("int").alias("t"),
        (F.col("i") % 4 + 2020).cast("int").alias("y"), (F.col("i") % 11).alias("v"))
    return df.repartition(16).cache()


@pytest.fixture(scope="module")
def pdf(facts):
    return facts.toPandas()


def test_dedup_and_pick(facts, pdf):
    want = pdf.sort_values(["k", "t", "v", "i"]).groupby(["k", "t"], as_index=False).first()
    got = dedup_by_key(facts.select("k", "t", "v", "i"), ["k", "t"], [F.col("v"), F.col("i")])
    assert rows(got) == sorted(map(tuple, want[["k", "t", "v", "i"]].values.tolist()), key=repr)
    sizes = pdf.groupby(["k", "t"]).size()
    picked = pick_per_period(facts.select("k", "t", "i"), "k", "t", [F.col("i")])
    assert {(r["k"], r["t"]): r["n_in_period"] for r in picked.collect()} == sizes.to_dict()


def test_latest(facts, pdf):
    newest = pdf[pdf["y"] == pdf.groupby("k")["y"].transform("max")]
    assert latest_rows(facts, "k", ["y"]).count() == len(newest)
    got = {r["k"]: (r["latest_total"], r["latest_y"])
           for r in latest_totals(facts, "k", ["y"], "v").collect()}
    want = newest.groupby("k").agg(total=("v", "sum"), y=("y", "max"))
    assert got == {k: (r.total, r.y) for k, r in want.iterrows()}


def test_panel_and_counts(facts, pdf):
    panel = churn_panel(facts, "k", "t")
    pairs = pdf[["k", "t"]].drop_duplicates()
    assert panel.count() == len(pairs)
    counts = {r["t"]: r["enrolled"] for r in churn_counts(
        facts.withColumn("z", F.lit(1)), ["t"], "k", "z").collect()}
    assert counts == pdf.groupby("t")["k"].nunique().to_dict()


def test_code_table_folds_spellings(spark, facts):
    named = facts.select(
        F.when(F.col("i") % 2 == 0, "Bogotá, D.C.").otherwise(" bogota ").alias("place"),
        F.lit("Región").alias("region"), F.lpad(F.col("v").cast("string"), 5, "0").alias("c"))
    got = code_table(named, "place", "region", F.col("c"))
    assert rows(got) == [("BOGOTA", "REGION", "00010")]
