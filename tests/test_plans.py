"""The physical plans stay what they are meant to be."""

import pytest

from tidemark.queries import QUERIES
from tidemark.queries.gold import gold_fact

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "CartesianProduct", "BroadcastNestedLoopJoin")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "churn_rate_by_period", "demographics_tidy", "suppress_nested", "code_resolve", "geo_normalize",
    "latest_snapshot", "box_summary", "density_grid", "export_clean", "tercile_bands"])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not [node for node in PYTHON_NODES if node in text]


def test_calendar_and_lookups_are_broadcast_before_any_run(spark):
    """Sizes are known when the query is planned, so the facts are never shuffled for a lookup."""
    assert "SortMergeJoin" not in plan(QUERIES["calendar_join"](spark, SF))
    text = plan(gold_fact(spark, SF))
    assert text.count("BroadcastHashJoin") >= 5 and "SortMergeJoin" not in text


def test_panel_needs_one_shuffle_of_the_facts(spark):
    text = plan(QUERIES["churn_target"](spark, SF))
    assert text.count("Exchange hashpartitioning") == 1


def test_only_needed_columns_are_scanned(spark):
    text = plan(QUERIES["churn_rate_by_period"](spark, SF))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in text


def test_top_categories_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["top_categories"](spark, SF))
