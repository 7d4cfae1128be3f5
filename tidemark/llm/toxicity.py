"""Toxicity by class-conditional Kneser-Ney models over the letters of words.

A word is a lower-cased run of letters (runs above :data:`LONGEST` letters, as in scripts without
blanks, are cut). Two models, one of the toxic and one of the ordinary labelled texts, give each
letter of a word, and its end, a probability after the :data:`ORDER` - 1 letters before it. Both
interpolate their discounted counts with one model of all labelled texts, which backs off through
the lower orders by continuation counts (after how many different letters an ending was seen). What
is rare in a class so costs both models nearly the same; an n-gram that no labelled text holds says
nothing. As most words are shorter than the order, the ratio of a word is close to that of the
word's own frequencies, and unknown words are judged by their letters.

A count is the number of labelled texts that hold the word, so a text that repeats itself does not
weigh more. N-grams are counted as they are, in tables that grow with the labelled text; nothing is hashed to a
fixed size and the table of them stays in Spark. The terms come from one grouping and two joins per
order. Tasks get the most frequent n-grams, at most :data:`HOT`, and a bitmap of hashes of the others
(:class:`Lookup`, 8 MB), and value the words whose n-grams are all among the first or in neither.
Each text brings its other words to a join with their values, which a join with all n-grams gives:
the lookup spares work and changes no value.

The length-normalised sum of the words' ratios and what exceeds :data:`STRONG` (:data:`FEATURES`)
go into a logistic curve, fitted out of fold: a labelled text is valued by the counts of the other
folds. Ratios are integers of 1 / :data:`UNIT` nat, so sums do not depend on the order of rows.

Null and empty texts and texts without letters have no words: their features are 0 and the curve's
bias scores them. Equal texts get equal scores, being valued once. Without labelled rows the scores
are near 0, with labels of one class they are that class's share.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_fold, labelled
from tidemark.session import settle

ORDER = 6
DISCOUNT = 0.75
#: Weight, in counts, of the common model in both classes.
COMMON = 5.0
FOLDS = 3
UNIT = 4096
LONGEST = 24
HOT = 1 << 18
BITMAP = 1 << 26
#: Values of words that a process remembers.
MEMO = 300_000
#: What a word's ratio must exceed (in nats) to count as an expression of the class; the excess is
#: added up over a text's different words, as one word repeated is no further evidence.
STRONG = (2.0, 4.0, 6.0)
#: Labelled texts that the logistic curve is fitted on, chosen by hash; the counts use all of them.
CURVE_ROWS = 8192
CHARACTERS_AT_ONCE = 1 << 20
WORDS_AT_ONCE = 500_000

START, END = "\x02", "\x03"
WORD = re.compile(rf"[^\W\d_]{{1,{LONGEST}}}")
COUNTS = [f"n_{f}_{c}" for f in range(FOLDS) for c in (0, 1)]
#: Values of all labelled texts, then without each fold.
VALUES = [f"v_{v}" for v in range(FOLDS + 1)]
SUMS = ["total", *[f"strong_{i}" for i in range(len(STRONG))]]
FEATURES = ("per word, whole text",
            *[f"above {s} nats, {by}" for s in STRONG for by in ("per word", "by root of words")],
            "most toxic word")


def words_of(text: str | None) -> Counter:
    """How often each word occurs. A very long text is cut at blanks, where there are any."""
    words: Counter = Counter()
    text, at = text or "", 0
    while at < len(text):
        end = at + CHARACTERS_AT_ONCE
        if end < len(text):
            end = text.rfind(" ", at, end) + 1 or end
        words.update(WORD.findall(text[at:end].lower()))
        at = end
    return words


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, group, n`` of batches of ``text, group``, a text counting once for a word; held
    counts are sent on when they are many, so a task's memory does not depend on its rows."""
    def rows(held):
        for group, counts in enumerate(held):
            if counts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(counts.keys(), pa.string()),
                     pa.array(np.full(len(counts), group, np.int32)),
                     pa.array(counts.values(), pa.int64())], names=["word", "group", "n"])
    held = [Counter() for _ in range(2 * FOLDS)]
    for batch in batches:
        for text, group in zip(*[batch.column(i).to_pylist() for i in range(2)], strict=True):
            held[group].update(words_of(text).keys())
            if sum(map(len, held)) > WORDS_AT_ONCE:
                yield from rows(held)
                held = [Counter() for _ in range(2 * FOLDS)]
    yield from rows(held)


def class_words(texts: DataFrame) -> DataFrame:
    """``word`` with a count per fold and label (:data:`COUNTS`) over ``text, fold, label``."""
    found = texts.select("text", (F.col("fold") * 2 + F.col("label")).alias("group")).mapInArrow(
        _word_rows, "word string, group int, n long")
    return found.groupBy("word").agg(*[
        F.coalesce(F.sum(F.when(F.col("group") == g, F.col("n"))), F.lit(0)).alias(name)
        for g, name in enumerate(COUNTS)])


def ngrams(word: Column) -> Column:
    """The n-grams that end at each letter of a word and at its end."""
    padded = F.concat(F.lit(START * (ORDER - 1)), word, F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(word) + 1),
                       lambda i: padded.substr(i, F.lit(ORDER)))


def gram_counts(words: DataFrame) -> DataFrame:
    """``gram`` and :data:`COUNTS` of a :func:`class_words` table."""
    return (words.select(F.explode(ngrams(F.col("word"))).alias("gram"), *COUNTS)
            .groupBy("gram").agg(*[F.sum(c).alias(c) for c in COUNTS]))


def shared_backoff(grams: DataFrame) -> DataFrame:
    """``ending, lower``: Kneser-Ney probabilities of order :data:`ORDER` - 1 by continuation."""
    levels = {}
    above, name = grams, "gram"
    for order in range(ORDER - 1, 0, -1):
        above = levels[order] = settle(
            above.groupBy(F.substring(name, 2, order).alias("ending"))
            .agg(F.count("*").alias("n")), f"endings-{order}")
        name = "ending"
    below = None
    for order in range(1, ORDER):
        level = levels[order].withColumn("h", F.substring("ending", 1, order - 1))
        contexts = level.groupBy("h").agg(F.sum("n").alias("sum"), F.count("*").alias("kinds"))
        joined = level.join(contexts, "h")
        if below is None:
            joined = joined.withColumn("rest", 1 / (F.col("kinds") + 1))
        else:
            joined = joined.withColumn("short", F.substring("ending", 2, order - 1)).join(
                below.select(F.col("ending").alias("short"), F.col("lower").alias("rest")),
                "short")
        below = settle(joined.select("ending", (
            (F.col("n") - DISCOUNT + DISCOUNT * F.col("kinds") * F.col("rest")) / F.col("sum"))
            .alias("lower")), f"backoff-{order}")
    return below


def gram_values(grams: DataFrame) -> DataFrame:
    """``gram, n`` and :data:`VALUES`, log p(letter | letters before, toxic) less the same of ordinary
    texts, of a settled :func:`gram_counts` table."""
    def counts(variant: int, label: int) -> Column:
        return sum((F.col(f"n_{f}_{label}") for f in range(FOLDS) if f != variant - 1), F.lit(0))

    own = {f"{label}_{v}": counts(v, label) for v in range(FOLDS + 1) for label in (0, 1)}
    own["all"] = counts(0, 0) + counts(0, 1)
    marked = grams.withColumns({"h": F.substring("gram", 1, ORDER - 1),
                                "ending": F.substring("gram", 2, ORDER - 1),
                                **{f"c_{k}": c for k, c in own.items()}})
    contexts = marked.groupBy("h").agg(
        *[F.sum(f"c_{k}").alias(f"sum_{k}") for k in own],
        *[F.count_if(F.col(f"c_{k}") > 0).alias(f"kinds_{k}") for k in own])
    joined = marked.join(contexts, "h").join(shared_backoff(grams), "ending")

    def p(key: str, rest: Column, weight: float) -> Column:
        kept = F.greatest(F.col(f"c_{key}") - DISCOUNT, F.lit(0.0))
        return (kept + (DISCOUNT * F.col(f"kinds_{key}") + weight) * rest) / (
            F.col(f"sum_{key}") + weight)

    joined = joined.withColumn("common", p("all", F.col("lower"), 0.0))
    return joined.select("gram", F.col("c_all").alias("n"), *[
        F.when(F.col(f"c_0_{v}") + F.col(f"c_1_{v}") > 0, F.round(UNIT * (
            F.log(p(f"1_{v}", F.col("common"), COMMON))
            - F.log(p(f"0_{v}", F.col("common"), COMMON)))).cast("int")).otherwise(0).alias(name)
        for v, name in enumerate(VALUES)])


def word_values(words: DataFrame, values: DataFrame) -> DataFrame:
    """:data:`VALUES` of every ``word``; n-grams that were not seen say nothing."""
    spread = words.select("word", F.explode(ngrams(F.col("word"))).alias("gram"))
    return spread.join(values.drop("n"), "gram", "left").groupBy("word").agg(
        *[F.coalesce(F.sum(v), F.lit(0)).alias(v) for v in VALUES])


@dataclass
class Lookup:
    """Values of the most frequent n-grams and a bitmap of hashes of the others."""

    grams: pa.ChunkedArray
    values: np.ndarray
    others: np.ndarray

    @cached_property
    def place(self) -> dict[str, int]:
        return {g: i for i, g in enumerate(self.grams.to_pylist())}

    @cached_property
    def memo(self) -> list[dict[str, int | None]]:
        return [{} for _ in VALUES]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("place", "memo")}

    def value(self, word: str, variant: int) -> int | None:
        """The word's value, None if it takes an n-gram that is not at hand."""
        memo = self.memo[variant]
        if word in memo:
            return memo[word]
        if len(memo) >= MEMO:
            memo.clear()
        padded = START * (ORDER - 1) + word + END
        found: int | None = 0
        for i in range(len(word) + 1):
            gram = padded[i:i + ORDER]
            at = self.place.get(gram)
            if at is not None:
                found += int(self.values[at, variant])
            else:
                bit = xxhash.xxh64_intdigest(gram.encode(), 42) & (BITMAP - 1)
                if self.others[bit >> 3] >> (bit & 7) & 1:
                    found = None
                    break
        memo[word] = found
        return found


def lookup(values: DataFrame) -> Lookup:
    """Of a settled :func:`gram_values` table; at most :data:`HOT` rows and 8 MB reach the driver."""
    size = F.floor(8 * F.log2("n")).cast("int")
    least, held = None, 0
    for row in values.groupBy(size.alias("size")).agg(F.count("*").alias("n")).orderBy(
            F.desc("size")).collect():  # eight rows per doubling of a count
        held += row["n"]
        if held > HOT:
            break
        least = row["size"]
    frequent = size >= least if least is not None else F.lit(False)
    known = values.filter(frequent).select("gram", *VALUES).toArrow()
    bit = F.pmod(F.xxhash64("gram"), F.lit(BITMAP))
    others = np.zeros(BITMAP // 8, np.uint8)
    for row in values.filter(~frequent).groupBy(F.floor(bit / 32768).alias("part")).agg(
            F.bitmap_construct_agg(bit % 32768).alias("bits")).toLocalIterator():
        bits = np.frombuffer(row["bits"], np.uint8)
        others[row["part"] * 4096:row["part"] * 4096 + len(bits)] = bits
    return Lookup(known["gram"], np.column_stack([known[v].to_numpy() for v in VALUES]), others)


def _text_rows(batches: Iterator[pa.RecordBatch], known: Lookup) -> Iterator[pa.RecordBatch]:
    """Sums over the words that ``known`` values, of batches of ``id, variant, text``, and the
    other words."""
    cuts = [int(s * UNIT) for s in STRONG]
    kinds = pa.list_(pa.struct([("word", pa.string()), ("times", pa.int32())]))
    names = ["id", "variant", "words", *SUMS, "top", "rare"]

    def out(rows):
        columns = list(zip(*rows, strict=True))
        types = [pa.binary(), pa.int32(), *[pa.int64()] * (len(SUMS) + 2)]
        arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=False)]
        offsets = np.cumsum([0, *map(len, columns[-1])])
        flat = pa.StructArray.from_arrays(
            [pa.array([w for pairs in columns[-1] for w, _ in pairs], pa.string()),
             pa.array([n for pairs in columns[-1] for _, n in pairs], pa.int32())],
            ["word", "times"])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat).cast(kinds)
        return pa.RecordBatch.from_arrays([*arrays, lists], names=names)

    for batch in batches:
        rows, held = [], 0
        for own, variant, text in zip(*[batch.column(i).to_pylist() for i in range(3)],
                                      strict=True):
            words = words_of(text)
            total, strong, top, rare = 0, [0] * len(cuts), 0, []
            for word, times in words.items():
                value = known.value(word, variant)
                if value is None:
                    rare.append((word, times))
                    continue
                total += value * times
                if value > cuts[0]:
                    strong = [s + max(value - c, 0) for s, c in zip(strong, cuts, strict=True)]
                if value > top:
                    top = value
            rows.append((own, variant, words.total(), total, *strong, top, rare))
            held += len(rare) + 1
            if held > WORDS_AT_ONCE // 4:
                yield out(rows)
                rows, held = [], 0
        if rows:
            yield out(rows)


def text_features(texts: DataFrame, values: DataFrame, known: Lookup) -> DataFrame:
    """``id`` and an array ``x`` of :data:`FEATURES` per different id of ``id, variant, text``.

    ``values`` is a settled :func:`gram_values` table, ``known`` its :func:`lookup`; equal ids must
    have equal texts.
    """
    shared = texts.sparkSession.sparkContext.broadcast(known)
    schema = ", ".join(["id binary, variant int, words long", *[f"{s} long" for s in SUMS],
                        "top long, rare array<struct<word string, times int>>"])
    parts = settle(texts.select("id", "variant", "text").mapInArrow(
        lambda batches: _text_rows(batches, shared.value), schema).dropDuplicates(["id"]), "texts")
    shared.unpersist()
    rare = parts.select("id", "variant", F.explode("rare").alias("r")).select(
        "id", "variant", F.col("r.word").alias("word"), F.col("r.times").alias("times"))
    valued = word_values(rare.select("word").distinct(), values)
    value = F.element_at(F.array(*VALUES), F.col("variant") + 1).cast("long")
    more = rare.join(valued, "word").select("id", "times", value.alias("v")).groupBy("id").agg(
        F.sum(F.col("v") * F.col("times")).alias("more_total"),
        *[F.sum(F.greatest(F.col("v") - int(s * UNIT), F.lit(0))).alias(f"more_strong_{i}")
          for i, s in enumerate(STRONG)],
        F.max("v").alias("more_top"))

    def whole(name: str) -> Column:
        return F.col(name) + F.coalesce(F.col(f"more_{name}"), F.lit(0))
    n = F.greatest(F.col("words"), F.lit(1)).cast("double")
    x = [whole("total") / UNIT / n]
    for i in range(len(STRONG)):
        x += [10 * whole(f"strong_{i}") / UNIT / n, whole(f"strong_{i}") / UNIT / F.sqrt(n)]
    x.append(F.greatest(F.col("top"), F.coalesce(F.col("more_top"), F.lit(0))) / UNIT)
    return parts.join(more, "id", "left").select("id", F.array(*x).alias("x"))


def marked_rows(docs: DataFrame, marks: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs`` whose ``_key`` may be a ``key`` of ``marks``: all that are, and few others.

    The bits of the hashes of the keys are :data:`BITMAP`, 8 MB whatever ``marks`` holds, which
    bounds the broadcast; it keeps most unmarked texts out of the shuffle that follows.
    """
    def place(name: str) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(BITMAP))
    # hashes depend on the type
    marks = marks.select(F.col(key).cast(docs.schema["_key"].dataType).alias("_key"))
    bits = marks.groupBy(F.floor(place("_key") / 32768).alias("_part")).agg(
        F.bitmap_construct_agg(place("_key") % 32768).alias("_bits"))
    at = place("_key") % 32768
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    own = F.floor(place("_key") / 32768) == F.col("_part")
    hit = F.getbit(byte.cast("int"), (at % 8).cast("int")) == 1
    return docs.join(F.broadcast(bits), own).filter(hit).select(*docs.columns)


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps on standardised columns."""
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.0
        return np.zeros(x.shape[1]), float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    design = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    penalty = np.diag([1e-6] + [ridge] * x.shape[1])
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (p - y) + penalty @ beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + penalty
        step = np.linalg.solve(hessian + 1e-9 * np.eye(len(beta)), gradient)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    weights = beta[1:] / scale
    return weights, float(beta[0] - weights @ mean)


def _digest(text: Column, variant: Column) -> Column:
    return F.unhex(F.md5(F.concat(variant.cast("string"), F.coalesce(text, F.lit("")))))


@dataclass
class ToxicityModel:
    """The settled values of n-grams, their lookup and the curve
    ``1 / (1 + exp(-(bias + weights . features)))``."""

    values: DataFrame
    known: Lookup
    weights: np.ndarray
    bias: float


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id",
          text: str = "text") -> ToxicityModel:
    """Fit on all labelled rows that are handed over (filter the held-out ones first)."""
    marks = settle(labelled(docs, labels, label, key).withColumn(
        "fold", F.pmod(F.xxhash64(key), F.lit(FOLDS)).cast("int")), "labels")
    named = docs.select(F.col(key).alias("_key"), F.col(text).alias("text"))
    # a hash table of the narrow side: the texts are moved once and not sorted
    texts = marked_rows(named, marks, key).join(
        marks.hint("shuffle_hash"), F.col("_key") == F.col(key))
    grams = settle(gram_counts(class_words(texts)), "grams")
    values = settle(gram_values(grams), "gram-values")
    known = lookup(values)

    sample = settle(marks.orderBy(F.xxhash64(key, F.lit(5)), key).limit(CURVE_ROWS), "curve")
    # CURVE_ROWS narrow rows bound this broadcast
    chosen = docs.select(F.col(key).alias("_key"), F.col(text).alias("text")).join(
        F.broadcast(sample), F.col("_key") == F.col(key)).withColumn(
        "variant", F.col("fold") + 1)
    chosen = chosen.withColumn("id", _digest(F.col("text"), F.col("variant")))
    fitted = text_features(chosen, values, known).join(
        chosen.select("id", F.col(key).cast("string").alias("key"), "label"), "id").select(
        "key", "label", "x").toPandas()
    rows = sorted(zip(fitted["key"], fitted["label"], map(tuple, fitted["x"]), strict=True))
    weights, bias = fit_curve(np.array([r[2] for r in rows]).reshape(-1, len(FEATURES)),
                              np.array([r[1] for r in rows], np.float64))
    return ToxicityModel(values, known, weights, bias)


def score(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text",
          carry: bool = False) -> DataFrame:
    """``key, score`` per row, or all columns and ``score`` with ``carry``."""
    own = _digest(F.col(text), F.lit(0))
    found = text_features(docs.select(own.alias("id"), F.lit(0).alias("variant"),
                                      F.col(text).alias("text")), model.values, model.known)
    z = F.lit(model.bias)
    for i, weight in enumerate(model.weights):
        z = z + float(weight) * F.get("x", F.lit(i))
    scored = found.select(F.col("id").alias("_id"), (
        1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(500.0)), F.lit(-500.0))))).alias("_score"))
    kept = [c for c in docs.columns if c != "score"] if carry else [key]
    # the digest is a column before the join, else the texts are moved to make it there
    named = docs.select(*[docs[f"`{c}`"] for c in kept], own.alias("_own"))
    return named.join(scored, F.col("_own") == F.col("_id")).select(
        *[named[f"`{c}`"] for c in kept], F.col("_score").alias("score"))


def toxicity_scores(docs: DataFrame, labels: DataFrame, carry: bool = False,
                    folds: int = 4, held_out: int = 2, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row; learns from the other folds only.

    A null doc_id is in no fold and counts as not held out. Repeated rows get equal scores; extra
    columns do not matter unless ``carry`` asks for them.
    """
    fold = crc_fold(F.col("doc_id"), folds)
    seen = fold.isNull() | (fold != held_out)
    model = train(docs.filter(seen), labels.filter(seen))
    kept = docs.drop("held_out", "predicted") if carry else docs
    return score(kept, model, carry=carry).withColumns({
        "held_out": F.coalesce(fold == held_out, F.lit(False)),
        "predicted": (F.col("score") >= threshold).cast("int")})
