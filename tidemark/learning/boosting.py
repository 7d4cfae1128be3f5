"""Histogram boosting on DataFrames with native missing values and categories.

Features become bin numbers once: a numeric value by the cuts it exceeds, a category by its place
in the frozen list, what is missing or unknown by -1. A level of a tree is one aggregation: sums of
gradients, Hessians and rows per (node, feature, bin), combined before the shuffle, so it moves at
most nodes x features x bins rows per task whatever the table. Splits are chosen on that small
table: missing rows are tried on both sides and go where the gain is higher, categories are put in
the order of their gradient ratio and cut like numbers. Only the chosen splits reach the driver, at
most 2 ** depth a level. The model is a table of splits; scoring is one expression.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import settle
from tidemark.sources.tables import literal_rows

MISSING = -1
#: Added to the Hessian sum when categories are put in order, so that rare ones do not lead.
CATEGORY_SMOOTHING = 10.0
MODEL_SCHEMA = ("tree int, node int, feature int, cut int, left_bins array<int>, "
                "missing_left boolean, left_value double, right_value double, gain double")


@dataclass(frozen=True)
class BoostSettings:
    """``l2`` is added to Hessian sums, a side needs ``min_hessian``, a split ``min_gain``."""

    trees: int = 100
    depth: int = 5
    rate: float = 0.1
    bins: int = 32
    l2: float = 1.0
    min_hessian: float = 1.0
    min_gain: float = 0.0
    settle_every: int = 10


@dataclass(frozen=True)
class BinPlan:
    """Cuts per numeric feature and values per categorical one; together the feature order."""

    cuts: dict[str, list[float]]
    categories: dict[str, list[str]] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return [*self.cuts, *self.categories]

    def bins(self) -> Column:
        """The bin numbers of a row as one array, in the order of :attr:`features`."""
        parts = []
        for name, cuts in self.cuts.items():
            x = F.col(name).cast("double")
            above = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c < x)) \
                if cuts else F.lit(0)
            parts.append(F.when(x.isNull() | F.isnan(x), MISSING).otherwise(above))
        for name, values in self.categories.items():
            place = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(name)) \
                if values else F.lit(0)
            parts.append(F.coalesce(place, F.lit(0)).cast("int") - 1)
        return F.array(*[p.cast("int") for p in parts])


@dataclass(frozen=True)
class BoostedTrees:
    """A fitted model: its bins, the log odds it starts from and its splits, tree by tree."""

    plan: BinPlan
    start: float
    splits: list[dict]

    def margin(self, bins: Column) -> Column:
        """Log odds as an expression of a row's bin numbers."""
        trees: dict[int, list[dict]] = {}
        for split in self.splits:
            trees.setdefault(split["tree"], []).append(split)
        return reduce(lambda a, b: a + b, [_tree_value(t, bins) for t in trees.values()],
                      F.lit(self.start))

    def with_score(self, df: DataFrame, out: str = "score") -> DataFrame:
        """All columns and the probability of the positive class."""
        placed = df.withColumn("_bins", self.plan.bins())
        return placed.withColumn(out, 1 / (1 + F.exp(-self.margin(F.col("_bins"))))).drop("_bins")

    def table(self, spark: SparkSession) -> DataFrame:
        """The splits as a table, one row each."""
        names = [f.split(" ")[0] for f in MODEL_SCHEMA.split(", ")]
        return literal_rows(spark, [tuple(s[n] for n in names) for s in self.splits], MODEL_SCHEMA)


def _goes_left(split: dict, bins: Column) -> Column:
    value = F.get(bins, F.lit(split["feature"]))
    known = value.isin(split["left_bins"]) if split["left_bins"] is not None \
        else value <= split["cut"]
    return F.when(value == MISSING, F.lit(split["missing_left"])).otherwise(known)


def _tree_value(splits: Sequence[dict], bins: Column) -> Column:
    by_node = {s["node"]: s for s in splits}

    def value(node: int, leaf: float) -> Column:
        split = by_node.get(node)
        if split is None:
            return F.lit(float(leaf))
        return F.when(_goes_left(split, bins), value(2 * node, split["left_value"])).otherwise(
            value(2 * node + 1, split["right_value"]))
    return value(1, 0.0)


def _node_of(splits: Sequence[dict], bins: Column) -> Column:
    """The node a row has reached."""
    by_node = {s["node"]: s for s in splits}

    def place(node: int) -> Column:
        split = by_node.get(node)
        if split is None:
            return F.lit(node)
        return F.when(_goes_left(split, bins), place(2 * node)).otherwise(place(2 * node + 1))
    return place(1)


def plan_bins(df: DataFrame, numeric: Sequence[str], categories: Mapping[str, Sequence[str]],
              bins: int = 32) -> BinPlan:
    """Cuts at approximate quantiles of the values that are there, in one pass."""
    probs = [i / bins for i in range(1, bins)]
    columns = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in numeric]
    found = df.agg(*[F.percentile_approx(x, probs, 10_000).alias(f"q{i}")
                     for i, x in enumerate(columns)]).first() if numeric else []
    cuts = {c: sorted(set(found[i] or [])) for i, c in enumerate(numeric)}
    return BinPlan(cuts, {c: list(v) for c, v in categories.items()})


def histogram(rows: DataFrame, node: Column, n: Column | None = None) -> DataFrame:
    """``node, feature, bin, g, h, n`` of rows with ``_bins, _g, _h``, which stand for ``n`` (1) each."""
    n = F.lit(1) if n is None else n
    return (rows.select(node.alias("node"), "_g", "_h", n.cast("bigint").alias("_n"),
                        F.posexplode("_bins").alias("feature", "bin"))
            .groupBy("node", "feature", "bin")
            .agg(F.sum("_g").alias("g"), F.sum("_h").alias("h"), F.sum("_n").alias("n")))


def best_splits(sums: DataFrame, first_category: int, s: BoostSettings) -> DataFrame:
    """The best split of every node of a :func:`histogram`.

    Ties go to the first feature, then the lowest place, then missing rows on the right.
    """
    by = ["node", "feature"]
    whole = Window.partitionBy(*by)
    ratio = F.when(F.col("feature") >= first_category,
                   F.col("g") / (F.col("h") + F.lit(CATEGORY_SMOOTHING))).otherwise(F.col("bin"))
    along = whole.orderBy("key", "bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    absent = F.col("bin") == MISSING
    told = sums.withColumns({
        "gt": F.sum("g").over(whole), "ht": F.sum("h").over(whole),
        "gm": F.coalesce(F.sum(F.when(absent, F.col("g"))).over(whole), F.lit(0.0)),
        "hm": F.coalesce(F.sum(F.when(absent, F.col("h"))).over(whole), F.lit(0.0)),
        "key": ratio}).filter(~absent)
    cut = told.withColumns({
        "gl": F.sum("g").over(along), "hl": F.sum("h").over(along),
        "place": F.count("*").over(along), "members": F.collect_list("bin").over(along)})
    # only now: a generator beside windows would be run ahead of them
    cut = cut.withColumn("missing_left", F.explode(F.array(F.lit(False), F.lit(True))))
    side = F.col("missing_left").cast("int")
    tried = cut.withColumns({"lg": F.col("gl") + side * F.col("gm"),
                             "lh": F.col("hl") + side * F.col("hm")}).withColumns(
        {"rg": F.col("gt") - F.col("lg"), "rh": F.col("ht") - F.col("lh")})

    def score(g: str, h: str) -> Column:
        return F.col(g) * F.col(g) / (F.col(h) + s.l2)
    tried = tried.withColumn("gain", F.round(
        (score("lg", "lh") + score("rg", "rh") - score("gt", "ht")) / 2, 9))
    allowed = tried.filter((F.col("lh") >= s.min_hessian) & (F.col("rh") >= s.min_hessian)
                           & (F.col("gain") > s.min_gain))
    order = F.struct("gain", -F.col("feature"), -F.col("place"), ~F.col("missing_left"))
    return allowed.groupBy("node").agg(F.max_by(F.struct(
        "feature", F.col("bin").alias("cut"), "members", "missing_left", "gain",
        (-F.col("lg") / (F.col("lh") + s.l2) * s.rate).alias("left_value"),
        (-F.col("rg") / (F.col("rh") + s.l2) * s.rate).alias("right_value")), order)
        .alias("best")).select("node", "best.*")


def fit_trees(rows: DataFrame, target: str, plan: BinPlan, settings: BoostSettings = BoostSettings(),
              weight: str | None = None) -> BoostedTrees:
    """Fit on the rows with a 0/1 target; a null target takes no part.

    The result does not depend on the order or the partitions of the rows up to the rounding of
    sums. Without rows, or with one class, there are no trees and the start is the smoothed share.
    """
    first_category = len(plan.cuts)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    # equal rows take the same way through every tree: they are folded to one, with the summed weight
    state = settle(rows.filter(F.col(target).isNotNull()).select(
        F.col(target).cast("double").alias("_y"), w.alias("_w"), plan.bins().alias("_bins"))
        .groupBy("_y", "_bins").agg(F.sum("_w").alias("_w"), F.count("*").alias("_n")),
        "binned")
    sums = state.agg(F.coalesce(F.sum("_w"), F.lit(0.0)).alias("w"),
                     F.coalesce(F.sum(F.col("_w") * F.col("_y")), F.lit(0.0)).alias("p")).first()
    if not 0 < sums["p"] < sums["w"]:
        share = (sums["p"] + 0.5) / (sums["w"] + 1)
        return BoostedTrees(plan, math.log(share / (1 - share)), [])
    start = math.log(sums["p"] / (sums["w"] - sums["p"]))
    state = state.withColumn("_f", F.lit(start))
    bins, splits = F.col("_bins"), []
    for tree in range(settings.trees):
        p = 1 / (1 + F.exp(-F.col("_f")))
        slopes = state.withColumn("_p", p).withColumns({
            "_g": (F.col("_p") - F.col("_y")) * F.col("_w"),
            "_h": F.col("_p") * (1 - F.col("_p")) * F.col("_w")})
        mine: list[dict] = []
        active = [1]
        for _ in range(settings.depth):
            sums = histogram(slopes.withColumn("_node", _node_of(mine, bins)).filter(
                F.col("_node").isin(active)), F.col("_node"), F.col("_n"))
            found = [{**r.asDict(), "tree": tree, "left_bins":
                      r["members"] if r["feature"] >= first_category else None}
                     for r in best_splits(sums, first_category, settings).orderBy("node").collect()]
            mine += [{k: v for k, v in r.items() if k != "members"} for r in found]
            active = [child for r in found for child in (2 * r["node"], 2 * r["node"] + 1)]
            if not active:
                break
        if not mine:
            break
        splits += mine
        state = state.withColumn("_f", F.col("_f") + _tree_value(mine, bins))
        if (tree + 1) % settings.settle_every == 0:
            state = settle(state, "margins")
    return BoostedTrees(plan, start, splits)
