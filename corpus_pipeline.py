"""A corpus pipeline of five stages, each an operator of :mod:`tidemark.llm` on what is left.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import mixing, pieces, quality, simhash, toxicity
from tidemark.llm.common import word_count
from tidemark.llm.queries import tokenizer_bytes
from tidemark.session import settle

#: SQL cannot express the models and the merges; tests compare each stage with brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.toxicity_scores(docs, labels, carry=True)
    return scored.filter("predicted = 0").select(*docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.quality_scores(docs, labels, carry=True)
    return scored.filter("predicted = 1").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate component: that with the smallest doc_id.

    Of rows that share this doc_id inside a component the first by text and the other columns stays,
    and so does the first row of a component without any doc_id.
    """
    found = settle(simhash.near_duplicates(docs), "near-duplicates")
    times = found.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"))
    repeated = settle(times.filter("n > 1").select("doc_id"), "repeated")
    plain = found.filter("doc_id = component_id").join(repeated, "doc_id", "left_anti")
    kept = docs.join(plain.select("doc_id"), "doc_id", "left_semi").select(*docs.columns)
    nameless = docs.filter("doc_id is null")
    if repeated.isEmpty() and nameless.isEmpty():
        return kept
    # rows that a doc_id does not tell apart are known by their fingerprint as well
    unclear = docs.join(repeated, "doc_id", "left_semi").select(*docs.columns).unionByName(nameless)
    marks = simhash.fingerprints(unclear.select("text", F.col("text").alias("_text")).distinct(),
                                 "_text")
    classes = found.select(F.col("doc_id").alias("_id"), "fp", "component_id", "root").distinct()
    known = (unclear.join(marks, unclear["text"].eqNullSafe(marks["_text"])).join(
        classes, (marks["fp"] == classes["fp"]) & unclear["doc_id"].eqNullSafe(classes["_id"]))
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id"))))
    first = Window.partitionBy("root").orderBy("text", *[c for c in docs.columns if c != "text"])
    return kept.unionByName(known.withColumn("_place", F.row_number().over(first))
                            .filter("_place = 1").select(*docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's share takes it."""
    sized = docs.withColumn("_size", word_count(F.col("text")))
    return mixing.emit(mixing.mix(sized, "_size", ties=("text",))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text."""
    return pieces.encode_decode(docs, tokenizer_bytes())


STAGES = [("toxicity", drop_toxic), ("quality", keep_quality),
          ("near_duplicates", drop_near_duplicates), ("mix", mix_sources),
          ("sentence_pieces", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
