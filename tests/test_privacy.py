import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.privacy import demographic_table, rate_gap, suppress, with_rate

SCHEMA = "parent string, child string, enrolled long, evaluable long, churned long"


def by_hand(cells, k):
    """The rule as a person would apply it: merge, then absorb the next smallest while needed."""
    groups = {}
    for parent, child, *counts in cells:
        groups.setdefault(parent, []).append((counts[0], child, counts))
    out = set()
    for parent, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1]))
        merged = [m for m in members if m[0] < k]
        kept = members[len(merged):]
        while merged and kept and (len(merged) < 2 or sum(m[0] for m in merged) < k):
            merged.append(kept.pop(0))
        out |= {(parent, child, *counts) for _, child, counts in kept}
        if merged:
            out.add((parent, "OTROS", *[sum(m[2][i] for m in merged) for i in range(3)]))
    return out


@pytest.fixture(scope="module")
def cells():
    rnd = random.Random(4)
    out = []
    for p in range(400):
        for c in range(rnd.randint(1, 8)):
            n = rnd.choice([rnd.randint(1, 12), rnd.randint(1, 40)])
            out.append((f"p{p:03d}", f"c{c}", n, n - 1, rnd.randint(0, n)))
    return out


def test_suppression_equals_the_rule_by_hand(spark, cells):
    df = spark.createDataFrame(cells, SCHEMA)
    got = {tuple(r) for r in suppress(df, "child", ["parent"]).collect()}
    assert got == by_hand(cells, 10)


def test_flat_suppression(spark, cells):
    for size in (1, 2, 3, 40, 400):
        part = [("all", f"{p}{c}", *rest) for p, c, *rest in cells[:size]]
        flat = spark.createDataFrame(part, SCHEMA).drop("parent")
        got = {("all", *r) for r in suppress(flat, "child").collect()}
        assert got == by_hand(part, 10)


def test_totals_are_kept_and_small_cells_only_where_all_merged(spark, cells):
    df = spark.createDataFrame(cells, SCHEMA)
    out = suppress(df, "child", ["parent"])
    total = [F.sum(c) for c in ("enrolled", "evaluable", "churned")]
    assert out.agg(*total).first() == df.agg(*total).first()
    small = out.filter("enrolled < 10").select("parent").distinct()
    alone = out.groupBy("parent").count().filter("count = 1").select("parent")
    assert small.subtract(alone).count() == 0
    strict = suppress(df, "child", ["parent"], strict=True)
    assert strict.filter("enrolled < 10").count() == 0


def test_real_child_named_like_the_merged_cell_stays_apart(spark):
    df = spark.createDataFrame([("p", "OTROS", 50, 50, 5), ("p", "a", 5, 5, 1),
                                ("p", "b", 6, 6, 1), (None, "a", 99, 9, 9)], SCHEMA)
    assert rows(suppress(df, "child", ["parent"])) == [("p", "OTROS", 11, 11, 2),
                                                       ("p", "OTROS", 50, 50, 5)]


@pytest.mark.parametrize("evaluable, churned, pct, low", [
    (0, 0, None, True), (40, 0, None, True), (40, 40, None, True), (29, 3, 10.34, True),
    (30, 3, 10.0, False), (800, 1, 0.12, False), (200, 1, 0.5, False)])
def test_rate_rules(spark, evaluable, churned, pct, low):
    df = spark.createDataFrame([("p", "c", 50, evaluable, churned)], SCHEMA)
    row = with_rate(df).first()
    assert (row["churn_pct"], row["low_confidence"]) == (pct, low)


def test_demographics_and_gap(spark):
    people = [(f"{s}{i}", float(s) if s else None, int(i % (s + 2) == 0))
              for s in (0, 1, 3, 4) for i in range(40)]
    df = spark.createDataFrame(people, "id string, stratum double, y int")
    tidy = demographic_table(df, ["stratum"], "id", "y")
    assert {r["category"] for r in tidy.collect()} == {"SIN DATO", "1.0", "3.0", "4.0"}
    low, high = 14 / 40 * 100, (8 + 7) / 80 * 100
    gap = tidy.agg(F.max(rate_gap(tidy, "stratum", ["1.0"], ["3.0", "4.0"]))).first()[0]
    assert gap == round(low - high, 2)
    none = tidy.agg(F.max(rate_gap(tidy, "stratum", ["9"], ["3.0"]))).first()[0]
    assert none is None
