from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.panel import (
    attach_calendar, churn_panel, dedup_by_key, pick_per_period, rank_of, unknown_periods,
    with_entity_history, with_panel_columns)
from tidemark.plans.fixed import CALENDAR, CALENDAR_SCHEMA, COHORT_PRIORITY
from tidemark.sources import literal_rows

PRESENCE = [("always", t) for t in (1, 2, 3, 4)] + [("gap", 1), ("gap", 3), ("late", 4),
                                                    ("left", 1), ("left", 2)]
EXPECTED = [
    ("always", 1, 2, 0, 1, None, 1), ("always", 2, 3, 0, 2, 1, 0), ("always", 3, 4, 0, 3, 1, 0),
    ("always", 4, None, None, 4, 1, 0), ("gap", 1, 3, 1, 1, None, 1), ("gap", 3, None, 1, 2, 2, 0),
    ("late", 4, None, None, 1, None, 1), ("left", 1, 2, 0, 1, None, 1),
    ("left", 2, None, 1, 2, 1, 0)]


def test_churn_panel(spark):
    raw = spark.createDataFrame(PRESENCE * 3, "id string, t int")
    assert rows(churn_panel(raw, "id", "t"), "id", "t") == EXPECTED


def test_panel_columns_on_fact_agree_with_the_panel(spark):
    fact = spark.createDataFrame([(i, t, f"{t}{c}") for i, t in PRESENCE for c in "ab"],
                                 "id string, t int, period string")
    got = with_panel_columns(fact, "id", "t").select(
        "id", "t", "next_t", "churned_next", "periods_so_far", "gap_since_previous",
        "is_first_period").distinct()
    assert rows(got, "id", "t") == EXPECTED


def test_target_is_null_exactly_in_the_last_period(spark):
    raw = spark.createDataFrame(PRESENCE, "id string, t int")
    bad = churn_panel(raw, "id", "t").filter((F.col("t") == 4) != F.col("churned_next").isNull())
    assert bad.count() == 0


def test_dedup_is_deterministic_and_keeps_one_row_of_a_hot_key(spark):
    hot = [("h", "p", f"v{i:04d}", None if i % 2 else i) for i in range(3000)]
    df = spark.createDataFrame(hot + [("x", "p", "b", 1), ("x", "p", "a", 2)],
                               "id string, p string, v string, n int")
    first = rows(dedup_by_key(df.repartition(7), ["id", "p"]))
    assert first == rows(dedup_by_key(df.repartition(3), ["id", "p"]))
    assert first == [("h", "p", "v0000", 0), ("x", "p", "a", 2)]
    last = rows(dedup_by_key(df, ["id", "p"], [F.col("v")], keep="last"))
    assert last[0][2] == "v2999"


def test_dedup_takes_maps(spark):
    df = spark.createDataFrame([("x", {"b": 1}, 1), ("x", {"a": 2}, 2), ("y", None, 3)],
                               "id string, m map<string,int>, n int")
    assert rows(dedup_by_key(df, ["id"])) == [("x", {"a": 2}, 2), ("y", None, 3)]


def test_calendar_drops_and_counts_unknown_periods(spark):
    calendar = literal_rows(spark, CALENDAR, CALENDAR_SCHEMA)
    df = spark.createDataFrame([("1", "periodo_1701"), ("2", "periodo_0000")],
                               "id string, periodo_codigo string")
    assert [r["id"] for r in attach_calendar(df, calendar, "periodo_codigo").collect()] == ["1"]
    assert rows(unknown_periods(df, calendar, "periodo_codigo")) == [("periodo_0000", 1)]


def test_pick_prefers_the_main_cohort_and_counts(spark):
    df = spark.createDataFrame(
        [("1", 1, "complementaria", 3), ("1", 1, "principal", 1), ("1", 1, "secundaria", 2),
         ("2", 1, "otra", 9)], "id string, t int, cohort string, o int")
    got = pick_per_period(df, "id", "t", [rank_of(F.col("cohort"), COHORT_PRIORITY), F.col("o")])
    assert rows(got.select("id", "cohort", "n_in_period")) == [("1", "principal", 3),
                                                               ("2", "otra", 1)]


def test_entity_history(spark):
    df = spark.createDataFrame([("1", 1), ("1", 4)], "id string, t int")
    assert rows(with_entity_history(df, "id", "t"), "t") == [("1", 1, 2, 1, 4, 0.5),
                                                             ("1", 4, 2, 1, 4, 0.5)]
