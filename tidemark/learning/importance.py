"""Permutation importance in one scoring job."""

from __future__ import annotations

import random
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.evaluation import evaluate, score_counts
from tidemark.operators.ordered import ranked
from tidemark.session import settle

#: Pairs of a row and its donor that a task scores, and that it scores at once.
PAIRS_PER_TASK = 100_000
PAIRS_AT_ONCE = 1024
#: Every shift of it by 0 to 63 bits has different upper six bits.
DE_BRUIJN = 0x03F79D71B4CB0A89
MAX_DEPTH = 6  # 64 leaves, the bits of a word


def shifts(n: int, repeats: int, seed: int) -> list[int]:
    """How far each repeat turns the random order of ``n`` rows; different as long as they can be."""
    draws = random.Random(seed)
    distinct = draws.sample(range(1, n), min(repeats, n - 1)) if n > 1 else [0]
    return [distinct[r % len(distinct)] for r in range(repeats)]


def permuted_rows(df: DataFrame, key: Sequence[str], features: Sequence[str], repeats: int,
                  seed: int) -> DataFrame:
    """Every row once per repeat, numbered ``_repeat`` from 1, with ``_perm``, the features of
    another row.

    The rows are put in one seeded random order over the whole table (ranges, so nothing is in one
    task). A repeat turns the order by its own shift and every row takes the features that come to
    its place: each is a permutation without a row that keeps its own, at any size above one row.
    ``key`` must be unique and without nulls.
    """
    placed = settle(ranked(
        settle(df.withColumn("_draw", F.xxhash64(F.lit(seed), *key)), "drawn"),
        ["_draw", *key], "_place").drop("_draw"), "placed")
    n = placed.count()
    turns = F.array(*[F.struct(F.lit(r + 1).alias("r"), F.lit(s).cast("long").alias("s"))
                      for r, s in enumerate(shifts(n, repeats, seed))])
    lent = placed.select("_place", F.struct(*features).alias("_perm"),
                         F.explode(turns).alias("_turn")).select(
        ((F.col("_place") + F.col("_turn.s") - 1) % F.lit(max(n, 1)) + 1).alias("_place"),
        F.col("_turn.r").alias("_repeat"), "_perm")
    # rows of arrays, once per repeat: Catalyst takes them for few bytes and would send all of them
    # through the driver to broadcast them
    return placed.join(lent.hint("merge"), "_place").drop("_place")


@dataclass
class LeafMasks:
    """Boosted trees over small whole numbers as bit masks.

    ``masks[i][v]`` holds per tree a bit for each leaf that a row whose i-th input is ``v`` may
    reach; the masks of all inputs have the bit of its own leaf in common. ``inputs`` names the
    places that come from a feature, ``values`` weighs the leaves, by tree and bit.
    """

    masks: list[np.ndarray]
    inputs: Mapping[str, list[int]]
    values: np.ndarray

    @classmethod
    def of(cls, trees: GBTClassificationModel, names: Sequence[str], top: int) -> LeafMasks:
        """Of a fitted model on inputs called ``<feature>__<part>``, whole numbers up to ``top``."""
        known = np.arange(top + 1)
        masks = [np.full((top + 1, len(trees.trees)), 2 ** 64 - 1, np.uint64) for _ in names]
        values = np.zeros((len(trees.trees), 2 ** MAX_DEPTH))

        def walk(node, tree: int, first: int, weight: float) -> int:
            """Number the leaves below ``node`` from ``first``; the number after the last."""
            if node.subtreeDepth() == 0:
                values[tree, first] = weight * node.prediction()
                return first + 1
            split = node.split()
            middle = walk(node.leftChild(), tree, first, weight)
            end = walk(node.rightChild(), tree, middle, weight)
            if split.getClass().getSimpleName() == "ContinuousSplit":
                left = known <= split.threshold()
            else:
                left = np.isin(known, list(split.leftCategories()))
            sides = [(1 << b) - (1 << a) for a, b in ((first, middle), (middle, end))]
            masks[split.featureIndex()][:, tree] &= ~np.where(
                left, np.uint64(sides[1]), np.uint64(sides[0]))
            return end

        for t, (tree, weight) in enumerate(zip(trees.trees, trees.treeWeights, strict=True)):
            leaves = walk(tree._java_obj.rootNode(), t, 0, weight)
            for mask in masks:
                mask[:, t] &= np.uint64((1 << leaves) - 1)
        inputs: dict[str, list[int]] = {}
        for i, name in enumerate(names):
            inputs.setdefault(name.rsplit("__", 1)[0], []).append(i)
        place = (np.uint64(DE_BRUIJN) << np.arange(64, dtype=np.uint64)) >> np.uint64(58)
        by_place = np.zeros_like(values)
        by_place[:, place] = values
        return cls(masks, inputs, by_place)

    def scores(self, leaves: np.ndarray) -> np.ndarray:
        """Probabilities of rows whose masks (by row and tree) hold the bit of their leaf alone."""
        place = (leaves * np.uint64(DE_BRUIJN)) >> np.uint64(58)
        margin = np.zeros(len(leaves))
        for t in range(leaves.shape[1]):  # in one order, so equal rows get equal scores
            margin += self.values[t][place[:, t]]
        return 1 / (1 + np.exp(-2 * margin))

    def of_features(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """Per feature the masks of its inputs, by row and tree."""
        found = {}
        for name, places in self.inputs.items():
            found[name] = self.masks[places[0]][x[:, places[0]]]
            for i in places[1:]:
                found[name] &= self.masks[i][x[:, i]]
        return found

    def variants(self, own: np.ndarray, lent: np.ndarray, features: Sequence[str]) \
            -> Iterator[np.ndarray]:
        """Scores of rows that take one feature from their donors, feature by feature, and last
        those of the rows as they are."""
        mine, other = self.of_features(own), self.of_features(lent)
        whole = np.full((len(own), self.values.shape[0]), 2 ** 64 - 1, np.uint64)
        names = list(mine)
        after = {names[-1]: whole} if names else {}
        for name, before in zip(names[:0:-1], names[-2::-1], strict=True):
            after[before] = after[name] & mine[name]
        rest, ahead = {}, whole
        for name in names:
            rest[name] = ahead & after[name]
            ahead = ahead & mine[name]
        plain = self.scores(ahead)
        for feature in features:
            yield self.scores(rest[feature] & other[feature]) if feature in rest else plain
        yield plain


def _variant_rows(batches: Iterator[pa.RecordBatch], model: LeafMasks, features: Sequence[str]) \
        -> Iterator[pa.RecordBatch]:
    """``target, feature, repeat, score`` of batches of ``target, repeat, own, lent``."""
    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy().reshape(len(column), -1)

    for batch in batches:
        parts = []
        for at in range(0, batch.num_rows, PAIRS_AT_ONCE):
            part = batch.slice(at, PAIRS_AT_ONCE)
            target, repeat = part.column(0), part.column(1).to_numpy()
            first = pa.array(repeat == 1)
            found = model.variants(matrix(part.column(2)), matrix(part.column(3)), features)
            for i, score in enumerate(found):
                out = pa.RecordBatch.from_arrays(
                    [target, pa.array(np.full(len(score), i, np.int32)),
                     pa.array(repeat if i < len(features) else np.zeros_like(repeat)),
                     pa.array(score)], names=["target", "feature", "repeat", "score"])
                parts.append(out if i < len(features) else out.filter(first))
        if parts:  # few large batches: a small one costs Spark as much
            yield from pa.Table.from_batches(parts).combine_chunks().to_batches()


def variant_scores(model: PipelineModel, df: DataFrame, key: Sequence[str],
                   features: Sequence[str], target: str, repeats: int, seed: int) -> DataFrame:
    """``target, feature, repeat, score``: every row once per feature (its number in ``features``)
    and repeat, and once as it is (number ``len(features)``, repeat 0).

    ``model`` is a fitted :func:`~tidemark.learning.models.tree_pipeline` of boosted trees. A row's
    inputs are made once; a pair of a row and its donor meets all features in one task, where what
    the others leave of each tree is shared. Pairs are dealt to tasks by their number: the tables
    are small in bytes and the work is not.
    """
    *before, trees = model.stages
    names = next(s for s in before if isinstance(s, VectorAssembler)).getInputCols()
    if not isinstance(trees, GBTClassificationModel) or trees.getMaxDepth() > MAX_DEPTH:
        raise ValueError(f"boosted trees of at most {MAX_DEPTH} levels are needed")
    masks = LeafMasks.of(trees, names, trees.getMaxBins())
    inputs = F.transform(vector_to_array("features"), lambda x: x.cast("smallint"))
    made = PipelineModel(before).transform(df).select(*key, target, inputs.alias("_own"))
    rows = permuted_rows(made, key, ["_own"], repeats, seed).select(
        F.col(target).cast("int").alias("target"), F.col("_repeat"), "_own",
        F.col("_perm._own").alias("_lent"))
    tasks = max(1, -(-df.count() * repeats // PAIRS_PER_TASK))
    shared = df.sparkSession.sparkContext.broadcast(masks)
    return rows.repartition(tasks).mapInArrow(
        lambda batches: _variant_rows(batches, shared.value, features),
        "target int, feature int, repeat int, score double")


def permutation_importance(model: PipelineModel, df: DataFrame, key: Sequence[str],
                           features: Sequence[str], target: str, repeats: int = 5,
                           seed: int = 42) -> DataFrame:
    """``feature, importance_mean, importance_std``: loss of PR-AUC when a feature is permuted.

    Each row is scored once as it is and once per feature and repeat, all in one job
    (:func:`variant_scores`).
    """
    by = ["feature", "repeat"]
    scored = variant_scores(model, df, key, features, target, repeats, seed)
    areas = settle(evaluate(score_counts(scored, "score", "target", by), 0.5, by)
                   .select(*by, "pr_auc"), "areas")
    plain = F.col("feature") == len(features)
    base = areas.filter(plain).agg(F.max("pr_auc")).scalar()
    loss = base - F.col("pr_auc")
    name = F.get(F.array(*[F.lit(f) for f in features]), F.col("feature"))
    return areas.filter(~plain).groupBy(name.alias("feature")).agg(
        F.avg(loss).alias("importance_mean"), F.stddev_pop(loss).alias("importance_std"))
