"""Toxicity and quality: held-out accuracy on given tables, gradients, edges."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality, toxicity

SF = "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def tables(spark):
    return (spark.read.parquet(f"{SF}/documents.parquet"),
            spark.read.parquet(f"{SF}/labels.parquet"))


def held_out(scored, labels, label):
    rows = scored.filter("held_out").join(labels, "doc_id").select(label, "predicted").collect()
    y, p = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    return (p[y == 1] == 1).mean(), (p[y == 0] == 0).mean()


def test_toxicity_on_held_out_rows(tables):
    docs, labels = tables
    scored = toxicity.toxicity_scores(docs, labels)
    assert scored.count() == docs.count()
    assert scored.filter("score < 0 or score > 1 or score is null").count() == 0
    caught, clean = held_out(scored, labels, "toxic")
    assert caught >= 0.9 and clean >= 0.99


def test_quality_on_held_out_rows(tables):
    docs, labels = tables
    scored = quality.quality_scores(docs, labels)
    assert scored.count() == docs.count()
    kept, dropped = held_out(scored, labels, "quality")
    assert kept >= 0.99 and dropped >= 0.97


@pytest.mark.parametrize("scores", [toxicity.toxicity_scores, quality.quality_scores])
def test_edges(spark, scores):
    rows = [(1, "a b c", None, "s", 1), (2, None, "en", None, None), (3, "", "en", "s", 0),
            (None, "x y", "en", "s", 3), (4, "good words here", "en", "s", 1),
            (4, "good words here", "en", "s", 1), (5, "very " * 700_000, "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS).withColumns(
        {"score": F.lit("c"), "label": F.lit(1), "fold": F.lit(1), "predicted": F.lit("p")})
    some = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (4, 1, 0), (4, 1, 0), (None, 1, 1),
                                  (5, None, None), (99, 0, 1)], LABELS)
    for labels in (some, some.limit(0), some.filter("doc_id = 4")):
        got = scores(docs, labels).collect()
        assert len(got) == len(rows)
        assert all(0 <= r["score"] <= 1 for r in got)
        assert {r["held_out"] for r in got if r["doc_id"] is None} == {False}
        assert len({r["score"] for r in got if r["doc_id"] == 4}) == 1
    assert scores(docs.limit(0), some).collect() == []


def test_scores_do_not_see_held_out_labels(tables):
    docs, labels = tables
    part = docs.filter("doc_id < 1500")
    turned = labels.withColumn("toxic", F.when(
        F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("toxic")).otherwise(
        F.col("toxic")))
    a = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(part, labels).collect()}
    b = {r["doc_id"]: r["score"] for r in toxicity.toxicity_scores(part, turned).collect()}
    assert a == b


TEXTS = [("you idiot, you are an idiot", 0, 1), ("an old clown and an idiot", 1, 1),
         ("the sea and the old town", 0, 0), ("an idea of the sea", 1, 0), ("a town", 2, 0),
         ("Ünder the sea", 2, 0), (None, 0, 0), ("", 1, 1)]


def plain_values(texts, without):
    """log-ratios of n-grams by dictionaries, and the common model by context."""
    n, d, mu = toxicity.ORDER, toxicity.DISCOUNT, toxicity.COMMON
    counts = {0: Counter(), 1: Counter()}
    seen = Counter()
    for text, fold, label in texts:
        for word in set(toxicity.words_of(text)):
            padded = toxicity.START * (n - 1) + word + toxicity.END
            grams = [padded[i:i + n] for i in range(len(word) + 1)]
            seen.update(grams)
            if fold != without:
                counts[label].update(grams)

    def continuation(order):
        longer = set(seen) if order == n - 1 else set(continuation(order + 1))
        return Counter(g[1:] for g in longer)

    tables = {k: continuation(k) for k in range(1, n)}

    def lower(g):
        if not g:
            return 1 / (len(tables[1]) + 1)
        own = {e: c for e, c in tables[len(g)].items() if e[:-1] == g[:-1]}
        return (own[g] - d + d * len(own) * lower(g[1:])) / sum(own.values())

    def p(table, g, rest, weight):
        own = {e: c for e, c in table.items() if e[:-1] == g[:-1] and c}
        return (max(table[g] - d, 0) + (d * len(own) + weight) * rest) / (
            sum(own.values()) + weight)

    out, common = {}, Counter()
    for g in seen:
        rest = p(seen, g, lower(g[1:]), 0)
        common[g[:-1]] += rest
        known = counts[0][g] + counts[1][g] > 0
        out[g] = np.log(p(counts[1], g, rest, mu) / p(counts[0], g, rest, mu)) if known else 0
    return out, common


def test_kneser_ney_terms_equal_plain_loops(spark):
    texts = spark.createDataFrame(TEXTS, "text string, fold int, label int")
    grams = toxicity.gram_counts(toxicity.class_words(texts)).cache()
    got = {r["gram"]: r for r in toxicity.gram_values(grams).collect()}
    for variant, without in enumerate((None, 0, 1, 2)):
        want, common = plain_values(TEXTS, without)
        assert set(got) == set(want)
        for gram, value in want.items():
            assert got[gram][f"v_{variant}"] == pytest.approx(toxicity.UNIT * value, abs=1)
        assert all(0 < total < 1 + 1e-9 for total in common.values())
    assert len(got) < toxicity.gram_counts(toxicity.class_words(texts.unionByName(
        spark.createDataFrame([("quite another vocabulary", 0, 0)], texts.schema)))).count()


def test_words_off_the_lookup_are_valued_like_the_others(spark, monkeypatch):
    texts = spark.createDataFrame(TEXTS, "text string, fold int, label int")
    values = toxicity.gram_values(
        toxicity.gram_counts(toxicity.class_words(texts)).cache()).cache()
    some = spark.createDataFrame([(t or "",) for t, *_ in TEXTS] * 2 + [("clowns & idiots " * 50,)],
                                 "text string")
    words = spark.createDataFrame([(w,) for w in sorted({w for r in some.collect()
                                                         for w in toxicity.words_of(r[0])})],
                                  "word string")
    plain = {r["word"]: r["v_2"] / toxicity.UNIT
             for r in toxicity.word_values(words, values).collect()}
    given = some.select(F.md5("text").cast("binary").alias("id"), F.lit(2).alias("variant"), "text")
    found, held = [], []
    for hot in (1 << 19, 30, 0):  # all n-grams at hand, some, none
        monkeypatch.setattr(toxicity, "HOT", hot)
        known = toxicity.lookup(values)
        held.append(sum(known.value(w, 2) is not None for w in plain))
        found.append({bytes(r["id"]): r["x"]
                      for r in toxicity.text_features(given, values, known).collect()})
    assert held[0] == len(plain) and held[0] > held[1] >= held[2]
    assert found[0].keys() == found[1].keys() == found[2].keys()
    for row in given.collect():
        own = toxicity.words_of(row["text"])
        n = max(own.total(), 1)
        x = [sum(plain[w] * k for w, k in own.items()) / n]
        for s in toxicity.STRONG:
            above = sum(max(plain[w] - s, 0) for w in own)
            x += [10 * above / n, above / np.sqrt(n)]
        x.append(max([0, *(plain[w] for w in own)]))
        for got in found:
            assert got[bytes(row["id"])] == pytest.approx(x, abs=1e-9)


def test_marked_rows_keep_every_marked_key(spark):
    docs = spark.range(20_000).select(F.col("id").alias("_key"), F.lit("t").alias("text"))
    marks = spark.range(0, 20_000, 7).select(F.col("id").cast("int").alias("doc_id"))
    kept = {r[0] for r in toxicity.marked_rows(docs, marks, "doc_id").select("_key").collect()}
    assert kept >= set(range(0, 20_000, 7)) and len(kept) < 2900
    assert toxicity.marked_rows(docs, marks.limit(0), "doc_id").count() == 0


def test_words_of_long_texts(monkeypatch):
    text = " ".join("abcdefg"[i % 7] * (i % 30 + 1) for i in range(3000))
    whole = toxicity.words_of(text)
    monkeypatch.setattr(toxicity, "CHARACTERS_AT_ONCE", 500)
    assert toxicity.words_of(text) == whole
    assert toxicity.words_of("\u6f22" * 60).total() == 3  # no blanks: pieces of 24 letters


def test_attention_gradient_is_the_derivative():
    s = quality.Settings(hidden=4, attention=3)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(9, 6))
    net = quality.AttentionNetwork.fresh(np.zeros(6), np.ones(6), s)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    first, y = np.array([0, 2, 3]), np.array([1.0, 0.0, 1.0])

    def loss():
        p = net.forward(x, first)["y"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))
    grads = net.gradient(net.forward(x, first), first, y)
    for name, grad in grads.items():
        flat = net.p[name].reshape(-1)
        for i in range(0, len(flat), 3):
            kept = flat[i]
            flat[i] = kept + 1e-6
            up = loss()
            flat[i] = kept - 1e-6
            down = loss()
            flat[i] = kept
            assert np.asarray(grad).reshape(-1)[i] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_passages_cover_whole_texts():
    texts = [b"", b" \n ", b"one two", b"w " * 1000, b"x" * 5_000_000]
    x, owner = quality.encode(texts)
    assert x.shape[1] == quality.FEATURES
    assert set(owner) == set(range(5)) and (np.diff(owner) >= 0).all()
    assert (owner == 3).sum() == -(-1000 // quality.WORDS_PER_PASSAGE)
    assert np.isfinite(x).all()


def test_attention_pass_equals_a_plain_loop():
    s = quality.Settings(hidden=4, attention=3)
    rng = np.random.default_rng(2)
    net = quality.AttentionNetwork.fresh(rng.normal(size=6), rng.random(6) + 0.5, s)
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    bags = [rng.normal(size=(n, 6)) for n in (1, 4, 2)]
    got = net.forward(np.concatenate(bags), np.array([0, 1, 5]))
    weights, want = [], []
    for bag in bags:
        hidden, logits = [], []
        for row in bag:
            h = np.tanh(((row - p["mean"]) / p["scale"]) @ p["W"] + p["b"])
            gate = 1 / (1 + np.exp(-(h @ p["U"])))
            hidden.append(h)
            logits.append(float((np.tanh(h @ p["V"]) * gate) @ p["w"]))
        total = sum(np.exp(e) for e in logits)
        weights += [np.exp(e) / total for e in logits]
        z = sum(np.exp(e) / total * h for e, h in zip(logits, hidden, strict=True))
        want.append(1 / (1 + np.exp(-(z @ p["c"] + p["d"][0]))))
    assert got["a"] == pytest.approx(weights, rel=1e-4)
    assert got["y"] == pytest.approx(want, rel=1e-4)


def test_long_documents_take_part_in_the_fit(spark):
    """All labelled documents are longer than a bag may be; the model learns from them."""
    rng = np.random.default_rng(4)

    def text(good):
        words = ["stone", "river", "Morning.", "walked,"] if good else ["$$9", "##", "0x!", "|||"]
        return " ".join(rng.choice(words, 1200))
    rows = [(i, text(i % 2), i % 2) for i in range(40)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    model = quality.train(docs, labels, settings=quality.Settings(passages=3))
    found = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert all((found[i] >= 0.5) == bool(y) for i, _, y in rows)


def test_drawn_passages_are_spread_over_the_text():
    s = quality.Settings(passages=20)
    bag = np.arange(1000.0)[:, None]
    kept = quality.drawn(bag, s)[:, 0]
    assert len(kept) == 20 and (np.diff(kept) > 0).all() and kept[0] < 250 and kept[-1] > 750
    assert quality.drawn(bag[:20], s) is not None and len(quality.drawn(bag[:20], s)) == 20


def test_texts_are_not_moved_for_their_scores(spark):
    """A text meets its score by a digest made before the join, so the join needs no text."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet")
                    for t in ("documents", "labels"))
    scored = toxicity.toxicity_scores(docs, labels)
    lines = scored._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joins = [line for line in lines if "Join " in line]
    assert joins and not [line for line in joins if "md5" in line]
