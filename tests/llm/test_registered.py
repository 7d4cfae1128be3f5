"""The registered queries equal DuckDB where SQL can say it; the pipeline equals its stages."""

import importlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.compare import connect, differences
from tidemark.llm import mixing, pieces, quality, simhash, toxicity
from tidemark.llm.queries import QUERIES, SQL, tokenizer_bytes

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF), duck, SQL[name]) == []


def test_every_operator_has_a_query():
    import __spark_entry__ as entry
    names = {n.split("_")[0] for n in entry.queries() if n.startswith("op")}
    assert names == {f"op{i}" for i in range(1, 14)} and "pipeline" in entry.queries()


def test_stages_keep_what_they_should(spark, tmp_path):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns
    left = docs
    for name, stage in pipeline.STAGES:
        before = {r["doc_id"] for r in left.select("doc_id").collect()}
        stage(spark, left, SF).write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name == "toxicity":
            scores = toxicity.toxicity_scores(left, labels)
            want = {r["doc_id"] for r in scores.filter("score < 0.3").collect()}
        elif name == "quality":
            scores = quality.quality_scores(left, labels)
            want = {r["doc_id"] for r in scores.filter("score >= 0.5").collect()}
        elif name == "near_duplicates":
            marks = [(r["doc_id"], simhash.simhash(r["text"].encode())) for r in left.collect()]
            want = {d for d, fp in marks if d == _smallest(d, marks)}
        elif name == "mix":
            sized = left.withColumn("w", F.size(F.split(F.trim("text"), r"\s+")).cast("long"))
            mixed = mixing.mix(sized, "w", ties=("text",))
            assert Counter(r["doc_id"] for r in out.select("doc_id").collect()) == Counter(
                {r["doc_id"]: r["copies"] for r in mixed.collect() if r["copies"]})
            want = {r["doc_id"] for r in mixed.collect() if r["copies"]}
        else:
            got = Counter(map(tuple, out.collect()))
            assert got == Counter(map(tuple, pieces.encode_decode(
                left, tokenizer_bytes()).collect()))
            want = before
        if name != "sentence_pieces":
            assert out.columns == columns
        assert {r["doc_id"] for r in out.select("doc_id").collect()} == want <= before
        left = out


def _smallest(start, marks):
    """The smallest key that links of at most 3 bits lead to."""
    reach, grown = {start}, True
    while grown:
        near = {fp for d, fp in marks if d in reach}
        more = {d for d, fp in marks if any((fp ^ x).bit_count() <= 3 for x in near)}
        grown = not more <= reach
        reach |= more
    return min(reach)


def test_stages_take_odd_rows(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    text = "some plain words that nobody minds at all in this text " * 4
    rows = [(1, text, "en", "a", 1), (2, text, None, None, None), (None, text, "en", "a", 1),
            (None, None, None, None, None), (3, "", "en", "b", 0), (3, "", "en", "b", 0),
            (4, "tail " * 100_000, "en", "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                       "n_chars long")
    for name, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).collect() == []
        out = stage(spark, docs, SF).collect()
        if name == "near_duplicates":
            assert sorted((r["doc_id"] or 0, (r["text"] or "")[:4]) for r in out) == [
                (1, "some"), (3, ""), (4, "tail")]

    other = "an entirely different text that has nothing in common with it " * 4
    rows = [(7, text, "en", "a", 1), (7, other, "en", "a", 1), (2, other, "en", "b", 1),
            (None, "one two three", "en", "a", 1), (None, "one two three", "en", "b", 1)]
    twice = spark.createDataFrame(rows, docs.schema)
    out = pipeline.drop_near_duplicates(spark, twice, SF).collect()
    assert sorted((r["doc_id"] or 0, r["text"][:3]) for r in out) == [
        (0, "one"), (2, "an "), (7, "som")]
