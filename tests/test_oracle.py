"""Every registered query with SQL equals DuckDB on the smallest tables."""

import os

import pytest

from tests.compare import connect, differences
from tidemark.learning.training import TrainSettings
from tidemark.queries import training
from tidemark.queries import QUERIES, SQL

SF = os.environ.get("TIDEMARK_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(autouse=True, scope="module")
def quick_fits():
    """The registered queries fit with the default settings; here the trees are few."""
    kept = training.SETTINGS
    training.SETTINGS = TrainSettings(trees=3, depth=3, repeats=2)
    yield
    training.SETTINGS = kept


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF), duck, SQL[name]) == []
