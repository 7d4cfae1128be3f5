"""What the two vector searches share: rows that take part, matrices, the merge of results."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def finite_vector(v: Column, zero_too: bool = True) -> Column:
    """Whether a vector is there and none of its components is null, NaN or infinite."""
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)
                    & (F.abs(x) < F.lit(float("inf"))))
    if not zero_too:
        good = good & F.exists(v, lambda x: x != 0)
    return v.isNotNull() & good


def finite(table: DataFrame, vector: str, key: str, zero_too: bool = True) -> DataFrame:
    """Rows with a key and a vector without null, NaN or infinite components."""
    return table.filter(F.col(key).isNotNull() & finite_vector(F.col(vector), zero_too))


def matrix(vectors, width: int | None = None) -> np.ndarray:
    """Rows of doubles; shorter vectors end in zeros."""
    vectors = list(vectors)
    width = max([width or 0, *map(len, vectors)])
    if all(len(v) == width for v in vectors):
        return np.array(vectors, np.float64).reshape(len(vectors), width)
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors, strict=True):
        row[:len(v)] = v
    return out


def ranked_hits(hits: DataFrame, k: int, *order) -> DataFrame:
    """The first ``k`` of ``query_id, vec_id, score`` per query with ``rank``; a query has at most
    ``k`` rows per shard it was sent to."""
    window = Window.partitionBy("query_id").orderBy(*order)
    return (hits.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
