"""Entity-grouped splits drawn from hashes, so every row decides for itself or by one rank."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import ranked
from tidemark.session import settle


def entity_hash(entity: Column, seed: int, hex_digits: int = 13) -> Column:
    """A number from the leading hex digits of a seeded MD5 (13 digits are exact as double)."""
    text = F.concat_ws("|", F.lit(str(seed)), entity.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, hex_digits), 16, 10).cast("bigint")


def in_holdout(entity: Column, fraction: float = 0.2, seed: int = 42) -> Column:
    """True for about ``fraction`` of the entities; no shuffle."""
    return entity_hash(entity, seed, 8) < F.lit(int(fraction * 2 ** 32)).cast("bigint")


def exact_holdout(df: DataFrame, entity: str, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``in_holdout`` for exactly ``ceil(fraction * entities)`` entities.

    The cut is the hash of that rank; rows compare with it, no join is needed.
    """
    key = F.col(entity).cast("string")
    ids = settle(df.select(entity_hash(F.col(entity), seed).alias("h"), key.alias("key"))
                 .distinct(), "ids")
    wanted = math.ceil(fraction * ids.count())
    cut = (ranked(ids, ["h", "key"], "position").filter(F.col("position") == wanted)
           .agg(F.max(F.struct("h", "key"))).scalar())
    here = F.struct(entity_hash(F.col(entity), seed).alias("h"), key.alias("key"))
    # no entity is wanted (fraction 0, no rows): there is no cut, and nobody is in
    return df.withColumn("in_holdout", F.coalesce(here <= cut, F.lit(False)))


def group_folds(df: DataFrame, entity: str, target: str, k: int = 5, seed: int = 42) -> DataFrame:
    """``entity, fold``: folds of equal size within each stratum (entity ever positive or not)."""
    ids = settle(df.groupBy(entity).agg(F.max(target).cast("int").alias("stratum"))
                 .withColumns({"h": entity_hash(F.col(entity), seed),
                               "key": F.col(entity).cast("string")}), "strata")
    placed = ranked(ids, ["h", "key"], "position", ["stratum"])
    return placed.select(entity, ((F.col("position") - 1) % k).cast("int").alias("fold"))


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """``target, n, weight`` with weight n_total / (classes * n_class)."""
    counts = df.filter(F.col(target).isNotNull()).groupBy(target).agg(F.count("*").alias("n"))
    whole = counts.agg(F.struct(F.sum("n").alias("n"), F.count("*").alias("k"))).scalar()
    return counts.withColumn(
        "weight", whole["n"].cast("double") / (whole["k"] * F.col("n")).cast("double"))


def with_balanced_weight(df: DataFrame, target: str, out: str = "weight") -> DataFrame:
    """Row weights of a 0/1 target by :func:`class_weights`; no join."""
    one = F.col(target) == 1
    totals = df.agg(F.struct(F.count_if(one).alias("pos"), F.count(target).alias("n"))).scalar()
    own = F.when(one, totals["pos"]).otherwise(totals["n"] - totals["pos"])
    return df.withColumn(out, totals["n"].cast("double") / (own * 2).cast("double"))
