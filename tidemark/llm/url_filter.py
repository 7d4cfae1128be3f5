"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

All of it is DataFrame expressions and Spark's own trees. Features: lengths of url, host, path and
query, depth, labels of the host, digits, other signs, entropy of the characters, parameters, and
how often the labelled urls of the same host suffix are blocked. The labels are the urls that a rule
judges; the trees then judge the urls that no rule fits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import settle

#: Rules as (verdict, host and path). Fixed values of the query.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))
#: Labelled urls that the trees are fitted on, chosen by hash of the url.
SAMPLE = 20_000
TREES, DEPTH = 20, 4
#: Weight of the overall share in a suffix's share.
PRIOR = 20.0

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FEATURES = ["url_length", "host_length", "path_length", "query_length", "depth", "labels",
            "digit_ratio", "sign_ratio", "entropy", "parameters", "has_fragment", "is_secure",
            "longest_part", "suffix_length", "suffix_share"]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null or without ``://``."""
    cut = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, cut, 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(url, cut, 2), F.lit(""))
    return F.translate(host, UPPER, LOWER), path


def fitting_rule(host: Column, path: Column,
                 rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """``struct<verdict, rule>`` of the longest rule that fits, else null; a short rule list."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    if not ordered:
        return F.lit(None).cast("struct<verdict:string,rule:string>")
    best = None
    for verdict, rule in ordered:
        at = rule.index("/")
        name, start = rule[:at], rule[at:]
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        value = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        best = F.when(fits, value) if best is None else best.when(fits, value)
    return best


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """The features that need nothing but the url; null counts as empty."""
    url = F.coalesce(url, F.lit(""))
    length = F.greatest(F.length(url), F.lit(1)).cast("double")
    kinds = F.array_distinct(F.split(url, ""))
    shares = F.transform(kinds, lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit(""))))
                         / length)
    entropy = F.aggregate(shares, F.lit(0.0), lambda a, p: a - F.when(p > 0, p * F.log2(p))
                          .otherwise(0.0))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    return {
        "url_length": F.length(url).cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "query_length": F.length(query).cast("double"),
        "depth": F.regexp_count(path, F.lit("/[^/]")).cast("double"),
        "labels": F.size(F.split(host, r"\.")).cast("double"),
        "digit_ratio": F.regexp_count(url, F.lit("[0-9]")) / length,
        "sign_ratio": F.regexp_count(url, F.lit("[^A-Za-z0-9]")) / length,
        "entropy": entropy,
        "parameters": F.regexp_count(query, F.lit("=")).cast("double"),
        "has_fragment": F.contains(url, F.lit("#")).cast("double"),
        "is_secure": F.startswith(url, F.lit("https")).cast("double"),
        "longest_part": F.coalesce(F.array_max(F.transform(
            F.split(path, "/"), lambda p: F.length(p))), F.lit(0)).cast("double"),
        "suffix_length": F.length(suffix(host)).cast("double"),
    }


def suffix(host: Column) -> Column:
    """The last label of a host."""
    return F.element_at(F.split(host, r"\."), -1)


def judge(pages: DataFrame, url: str = "url", rules: Sequence[tuple[str, str]] = RULES,
          sample: int = SAMPLE, trees: int = TREES, depth: int = DEPTH) -> DataFrame:
    """All rows with ``host, path, rule, verdict, score``.

    ``verdict`` is the rule's, else block when the trees' probability of block (``score``) is at
    least one half. Null, empty and malformed urls have no host, so no rule fits them and the trees
    judge them by their features. Without labelled urls of both verdicts the score is the labelled
    share of block (0 without labels). Columns of the same names are replaced; rows that repeat
    are judged alike; an empty table gives an empty result.
    """
    pages = pages.drop("host", "path", "rule", "verdict", "score", *FEATURES)
    kept = pages.columns
    host, path = split_url(F.col(url))
    parted = (pages.withColumns({"host": host, "path": path})
              .withColumn("_rule", fitting_rule(F.col("host"), F.col("path"), rules))
              .withColumns(lexical(F.col(url), F.col("host"), F.col("path")))
              .withColumn("_suffix", suffix(F.col("host"))))
    marked = parted.filter("_rule is not null").withColumn(
        "label", (F.col("_rule.verdict") == "block").cast("double"))
    # every different labelled url once: copies of one must not outweigh the others
    urls = settle(marked.select(F.col(url).alias("_url"), "label", "_suffix", *FEATURES[:-1])
                  .distinct(), "labelled-urls")
    totals = urls.agg(F.count("*").alias("n"), F.coalesce(F.avg("label"), F.lit(0.0))
                      .alias("share")).first()
    shares = settle(urls.groupBy("_suffix").agg(
        ((F.sum("label") + PRIOR * totals["share"]) / (F.count("*") + PRIOR))
        .alias("_share")), "suffixes")
    # only the fit is bounded; the shares of the suffixes cover all labelled urls
    chosen = settle(urls.orderBy(F.xxhash64("_url"), "_url").limit(sample).drop("_url"), "sample")

    def with_share(rows: DataFrame) -> DataFrame:
        return rows.join(shares, "_suffix", "left").withColumn(
            "suffix_share", F.coalesce("_share", F.lit(float(totals["share"])))).drop("_share")

    known = F.col("_rule.verdict")
    if totals["n"] == 0 or totals["share"] in (0.0, 1.0):
        scored = parted.withColumn("score", F.lit(float(totals["share"])))
    else:
        model = fit(with_share(chosen), trees, depth)
        scored = _probability(model, with_share(parted))
    return scored.select(
        *kept, "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(known, F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
        .alias("verdict"), "score")


def fit(rows: DataFrame, trees: int = TREES, depth: int = DEPTH) -> GBTClassificationModel:
    """Boosted trees over ``label`` and :data:`FEATURES`; rows in a fixed order."""
    data = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(
        settle(rows.repartitionByRange(4, *FEATURES).sortWithinPartitions(*FEATURES), "urls"))
    return GBTClassifier(maxIter=trees, maxDepth=depth, seed=5, stepSize=0.3,
                         featureSubsetStrategy="all").fit(data.select("features", "label"))


def _probability(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    return (model.transform(assembled)
            .withColumn("score", F.element_at(vector_to_array("probability"), 2)))
