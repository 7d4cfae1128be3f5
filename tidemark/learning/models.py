"""Estimator pipelines over a feature frame."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LogisticRegression, RandomForestClassifier)
from pyspark.ml.feature import (
    Bucketizer, Imputer, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexerModel,
    VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.learning.splits import with_balanced_weight
from tidemark.learning.trees import fit_held
from tidemark.session import settle

SEED = 42
#: Rows a task passes over while Spark grows trees, and may hold. A fit passes over them hundreds of
#: times, so the tasks follow from the rows and not from their bytes, which are few; more tasks than
#: run at once would only make the driver start and remember them.
ROWS_PER_TASK, MOST_ROWS = 20_000, 1_000_000


def _indexers(categories: Mapping[str, Sequence[str]]) -> list:
    # one model per column: the multi-column constructor pads lists of unequal length with nulls
    return [StringIndexerModel.from_labels(list(labels), inputCol=c, outputCol=f"{c}__code",
                                           handleInvalid="keep")
            for c, labels in categories.items()]


def _imputed(numeric: Sequence[str]) -> list:
    if not numeric:
        return []
    return [Imputer(strategy="median", inputCols=list(numeric),
                    outputCols=[f"{c}__filled" for c in numeric])]


def _missing_flags(numeric: Sequence[str]) -> SQLTransformer:
    flags = ", ".join(f"CAST(`{c}` IS NULL AS DOUBLE) AS `{c}__missing`" for c in numeric)
    return SQLTransformer(statement=f"SELECT *{', ' + flags if flags else ''} FROM __THIS__")


class Binner(Estimator):
    """Bin numbers of numeric columns without gaps: between neighbours where a column has few
    values, else at approximate quantiles. The trees bin their inputs anyway, by a sample."""

    def __init__(self, inputs: Sequence[str], outputs: Sequence[str], bins: int):
        super().__init__()
        self.inputs, self.outputs, self.bins = list(inputs), list(outputs), bins

    def _fit(self, dataset: DataFrame) -> Bucketizer:
        probs = [i / self.bins for i in range(1, self.bins)]
        found = dataset.agg(*[F.struct(
            F.percentile_approx(c, probs, 10_000).alias("cuts"),
            F.approx_count_distinct(c).alias("n")).alias(c) for c in self.inputs]).first()
        few = [c for c in self.inputs if found[c]["n"] <= self.bins]
        values = dataset.agg(*[F.collect_set(c).alias(c) for c in few]).first() if few else {}
        splits = []
        for c in self.inputs:
            known = sorted(values[c]) if c in few else []
            cuts = [a / 2 + b / 2 for a, b in zip(known, known[1:])] if c in few \
                else found[c]["cuts"]
            # a column with one value has no cut; a bucketizer wants one
            inner = sorted({x for x in cuts if math.isfinite(x)}) or [0.0]
            splits.append([-math.inf, *inner, math.inf])
        return Bucketizer(splitsArray=splits, inputCols=self.inputs, outputCols=self.outputs)


class FoldedRows(Estimator):
    """Fits boosted trees on one row per different feature vector and label, with the summed
    weight: without subsampling a row of weight n is n rows to them."""

    def __init__(self, learner: GBTClassifier):
        super().__init__()
        self.learner = learner

    def _fit(self, dataset: DataFrame) -> Model:
        features, label, weight = (self.learner.getFeaturesCol(), self.learner.getLabelCol(),
                                   self.learner.getWeightCol())
        folded = settle(dataset.groupBy(features, label).agg(F.sum(weight).alias(weight)),
                        "folded")
        held = fit_held(self.learner, folded, folded.count()) \
            if isinstance(self.learner, GBTClassifier) else None
        return held or self.learner.fit(_spread(folded))


class SpreadRows(Estimator):
    """Fits a forest, whose bootstrap draws single rows, on rows dealt by their number."""

    def __init__(self, learner: RandomForestClassifier):
        super().__init__()
        self.learner = learner

    def _fit(self, dataset: DataFrame) -> Model:
        rows = settle(dataset.select(self.learner.getFeaturesCol(), self.learner.getLabelCol(),
                                     self.learner.getWeightCol()), "forestrows")
        return self.learner.fit(_spread(rows))


def _spread(rows: DataFrame) -> DataFrame:
    """``rows``, a settled table, in tasks of :data:`ROWS_PER_TASK` or, where these are more than run
    at once, of more rows."""
    n, slots = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(1, min(-(-n // ROWS_PER_TASK), slots), -(-n // MOST_ROWS)))


def tree_pipeline(numeric: Sequence[str], categories: Mapping[str, Sequence[str]], target: str,
                  kind: str = "boosted", trees: int = 100, depth: int = 5) -> Pipeline:
    """Boosted trees (or a random forest) with categorical splits on frozen codes.

    The trees take no missing values, so numerics are filled with the median and get a flag.
    Filled numerics become bin numbers, which lets equal rows be folded before the fit.
    """
    inputs = [*[f"{c}__bin" for c in numeric], *[f"{c}__missing" for c in numeric],
              *[f"{c}__code" for c in categories]]
    bins = max([32, *[len(v) + 2 for v in categories.values()]])
    common = dict(featuresCol="features", labelCol=target, weightCol="weight", maxBins=bins,
                  maxDepth=depth, seed=SEED)
    if kind == "boosted":
        learner = FoldedRows(GBTClassifier(maxIter=trees, stepSize=0.1, **common))
    else:
        learner = SpreadRows(RandomForestClassifier(numTrees=trees, **common))
    binned = [Binner([f"{c}__filled" for c in numeric], [f"{c}__bin" for c in numeric], bins)] \
        if numeric else []
    return Pipeline(stages=[_missing_flags(numeric), *_imputed(numeric), *binned,
                            *_indexers(categories),
                            VectorAssembler(inputCols=inputs, outputCol="features"), learner])


def baseline_pipeline(numeric: Sequence[str], categories: Mapping[str, Sequence[str]],
                      target: str, weight_sum: float) -> Pipeline:
    """Median fill, standardise, one-hot, balanced logistic regression.

    An L2 strength of 1 per unit of total weight corresponds to ``regParam = 1 / weight_sum``.
    """
    stages = [*_imputed(numeric)]
    parts = []
    if numeric:
        stages += [VectorAssembler(inputCols=[f"{c}__filled" for c in numeric],
                                   outputCol="__numeric"),
                   StandardScaler(inputCol="__numeric", outputCol="__scaled", withMean=True)]
        parts.append("__scaled")
    if categories:
        stages += [*_indexers(categories),
                   OneHotEncoder(inputCols=[f"{c}__code" for c in categories],
                                 outputCols=[f"{c}__hot" for c in categories],
                                 dropLast=False, handleInvalid="error")]
        parts += [f"{c}__hot" for c in categories]
    stages += [VectorAssembler(inputCols=parts, outputCol="features"),
               LogisticRegression(featuresCol="features", labelCol=target, weightCol="weight",
                                  maxIter=1000, tol=1e-4, regParam=1.0 / max(weight_sum, 1.0),
                                  elasticNetParam=0.0, standardization=False)]
    return Pipeline(stages=stages)


def observed_numerics(train: DataFrame, numeric: Sequence[str]) -> list[str]:
    """Numeric features with at least one value; a column without any cannot be filled."""
    if not numeric:
        return []
    seen = train.agg(*[F.count(c).alias(c) for c in numeric]).first()
    return [c for c in numeric if seen[c] > 0]


def fit_balanced(pipeline: Pipeline, train: DataFrame, target: str) -> PipelineModel:
    return pipeline.fit(with_balanced_weight(train, target))


def with_score(model: PipelineModel, df: DataFrame, out: str = "score") -> DataFrame:
    """Input columns plus the probability of the positive class."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(out))
