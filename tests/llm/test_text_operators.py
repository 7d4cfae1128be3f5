"""Mixing, near-duplicates, licences, pieces against brute force and on edge cases."""

import hashlib
import itertools
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import licenses, mixing, pieces, simhash
from tidemark.llm.common import word_count
from tidemark.llm.components import connected_components
from tidemark.llm.queries import tokenizer_bytes

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# ---- mixing

def sized(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, size long")


def targets_by_rounds(sizes, weights=(1, 2, 3), most=3):
    """The contract word for word: share by weight, stop at the cap, share the excess again."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set(names)
    while left > 1e-9 and open_:
        whole, total = left, sum(weight[s] for s in open_)
        left = 0.0
        for s in list(open_):
            target[s] += whole * weight[s] / total
            cap = most * sizes[s]
            if target[s] >= cap:
                left += target[s] - cap
                target[s] = float(cap)
                open_.discard(s)
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 10, "c": 10}, {"a": 1000, "b": 1, "c": 2, None: 3},
    {"a": 0, "b": 5}, {"a": 5, "b": 0, "c": 0}, {"a": 0}, {"é": 40, "z": 7, "Z": 7, None: 1}])
def test_targets_fill_up_to_three_times(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(table).collect()}
    assert got == pytest.approx(targets_by_rounds(sizes))


def test_mix_is_near_its_targets_and_repeats(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None]), rng.randint(0, 60))
            for i in range(3000)]
    first = mixing.mix(sized(spark, rows), "size", rows_per_bucket=100)
    got = sorted(map(tuple, first.collect()), key=repr)
    again = mixing.mix(sized(spark, rows[::-1]).repartition(7), "size", rows_per_bucket=100)
    assert got == sorted(map(tuple, again.collect()), key=repr)
    by = first.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"),
                                     F.first("target").alias("target")).collect()
    for r in by:
        assert abs(r["taken"] - r["target"]) <= 0.05 * r["target"] + 60
    assert max(r[-1] for r in got) <= 3


def test_mix_is_near_its_targets_with_very_long_documents(spark):
    rng = random.Random(6)
    rows = [(i, f"s{i % 12}", min(20_000, int(rng.paretovariate(0.9) * 15))) for i in range(900)]
    by = mixing.mix(sized(spark, rows), "size").groupBy("source").agg(
        F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target"),
        F.max("size").alias("largest")).collect()
    for r in by:
        assert abs(r["taken"] - r["target"]) <= 0.6 * r["largest"] + 0.02 * r["target"]
    whole = sum(r["target"] for r in by)
    assert abs(sum(r["taken"] for r in by) - whole) <= 0.05 * whole


def test_mix_edges(spark):
    empty = mixing.mix(sized(spark, []), "size")
    assert empty.columns == ["doc_id", "source", "size", "source_size", "target", "copies"]
    assert empty.collect() == []
    rows = [(1, None, 0), (1, None, 0), (None, "a", 5), (None, "a", 5), (3, "a", 5)]
    clash = sized(spark, rows).withColumns({"target": F.lit("x"), "copies": F.lit(9)})
    got = mixing.mix(clash, "size").collect()
    assert len(got) == 5
    assert [r["copies"] for r in got if r["source"] is None] == [1, 1]  # nothing to share
    assert sum(r["copies"] * r["size"] for r in got) == 15  # the target of the only full source


def test_emit_repeats_rows(spark):
    got = mixing.emit(sized(spark, [(1, "a", 1), (2, "a", 1), (3, "a", 1)])
                      .withColumn("copies", F.col("doc_id") - 1)).collect()
    assert Counter(r["doc_id"] for r in got) == {2: 1, 3: 2}


@pytest.mark.parametrize("text, n", [(None, 0), ("", 0), (" \t\n\x0b\x0c\r", 0), ("a b", 2),
                                     ("a\u00a0b", 1), ("\x1fa\x1f", 1)])
def test_word_count(spark, text, n):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(word_count(F.col("t"))).first()[0] == n


# ---- near-duplicates

def slow_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
             .replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ")
             .replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64)
               if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(marks, radius=3):
    """marks: (key, fingerprint) pairs; smallest key reachable."""
    label = list(range(len(marks)))
    for i, j in itertools.combinations(range(len(marks)), 2):
        if (marks[i][1] ^ marks[j][1]).bit_count() <= radius and label[i] != label[j]:
            old, new = label[j], label[i]
            label = [new if x == old else x for x in label]
    least = {}
    for (key, _), root in zip(marks, label, strict=True):
        if key is not None:
            least[root] = min(key, least.get(root, key))
    return [(key, f"{fp:016x}", least.get(root))
            for (key, fp), root in zip(marks, label, strict=True)]


@pytest.mark.parametrize("text", [None, "", "A b", "Ä b C d", "One two three FOUR five " * 40,
                                  "x\u00a0y z\x1fw v", "a " * 70000])
def test_fingerprint(text):
    assert simhash.simhash((text or "").encode()) == slow_fingerprint(text)


def test_spark_agrees_on_the_hash(spark):
    assert spark.sql("select xxhash64('ab c d')").first()[0] % 2 ** 64 == \
        xxhash.xxh64(b"ab c d", seed=42).intdigest()


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(60):
        base = [rng.choice(words) for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(1, 4)):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                if copy:
                    copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((len(rows) * 7 % 1009, " ".join(copy)))
    rows += [(None, rows[0][1]), (None, "alone here"), (5000, None), (5001, ""), rows[3], rows[3]]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"fp": F.lit("clash"), "component_id": F.lit(1), "root": F.lit(2)})
    got = simhash.near_duplicates(table).select(
        "doc_id", simhash.hex_digits().alias("f"), "component_id").collect()
    want = slow_components([(k, slow_fingerprint(t)) for k, t in rows])
    assert Counter(map(tuple, got)) == Counter(want)


def test_near_duplicates_of_nothing(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).collect() == []


@pytest.mark.parametrize("radius", [1, 3])
def test_masks_cover_every_pair(radius):
    rng = random.Random(radius)
    for free in (range(64), range(0, 64, 3)):
        masks = simhash.covering_masks(list(free), radius, 5)
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(3000):
            differ = sum(1 << p for p in rng.sample(list(free), radius))
            assert any(not m & differ for m in masks)


def test_mask_levels_halve_the_free_bits():
    levels = simhash.mask_levels(3)
    assert [len(rows) for rows in levels] == [15, 225, 3375]
    assert [max(64 - m.bit_count() for *_, m in rows) for rows in levels] == [32, 16, 8]


def test_hot_buckets_lose_no_link(spark):
    rng = random.Random(9)
    fps = {0}
    chain = 0
    for _ in range(40):  # a chain of links through one crowded neighbourhood
        chain ^= sum(1 << b for b in rng.sample(range(64), 3))
        fps.add(chain)
    fps |= {chain ^ (1 << a) ^ (1 << b) for a, b in itertools.combinations(range(24), 2)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), bucket_limit=8)
    nodes = connected_components(links)
    want = slow_components([(f, f) for f in sorted(fps)])
    sizes = Counter(c for *_, c in want)
    got = Counter(r["root"] for r in nodes.collect())
    assert sorted(got.values()) == sorted(n for n in sizes.values() if n > 1)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, j) for j in range(101, 180)] + [(7, 7)]
    edges += [(200, 201), (201, 200), (None, 3)]
    got = {r["node"]: r["root"] for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(51), 0), **dict.fromkeys(range(100, 180), 100),
                   200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


# ---- licences

def slow_scan(key, text, threshold=licenses.THRESHOLD):
    import regex

    def grams(unit):
        words = regex.sub(r"[^\p{L}\p{N}]+", " ", unit.lower()).split()
        return set(zip(words, words[1:], strict=False)) if len(words) > 1 else set(words)
    lines = (text or "").split("\n")
    units = [(i + 1, line) for i, line in enumerate(lines)]
    units += [(0, text)] if len(lines) > 1 else []
    out = []
    for number, unit in units:
        mine = grams(unit)
        for name, template in licenses.TEMPLATES.items():
            theirs = grams(template)
            score = 2 * len(mine & theirs) / (len(mine) + len(theirs))
            if score >= threshold:
                out.append((key, number, name, score, len(mine)))
    return out


def test_licence_scan_equals_brute_force(spark):
    mit, apache = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["Apache-2.0"]
    texts = [None, "", "\n\n", "license", "Copyright. All RIGHTS reserved!", mit,
             mit.replace("Software", "Work"), f"hello\n{apache}\nbye", apache.replace(" ", "\n"),
             "Licensed under the Apache License Version 2.0", "word " * 5000, mit[:200],
             "SPDX-License-Identifier: MIT\nSPDX-License-Identifier: MIT", "ß\u00e9 " + mit]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, mit), (None, mit)]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"line": F.lit(1), "words": F.lit("x"), "lines": F.lit(0), "license": F.lit("y")})
    got = Counter((r[0], r[1], r[2], round(r[3], 9), r[4]) for r in licenses.scan(table).collect())
    want = Counter((k, n, name, round(s, 9), m) for key, t in rows
                   for k, n, name, s, m in slow_scan(key, t))
    assert got == want
    assert licenses.best_licenses(table.limit(0)).collect() == []


def words_wrapped(text, width=40):
    import textwrap
    return "\n".join(textwrap.wrap(text, width, break_long_words=False))


def slow_runs(text, template, threshold=licenses.THRESHOLD):
    """``(first, last): score`` of all runs of lines at or above the threshold."""
    import regex
    lines = [regex.sub(r"[^\p{L}\p{N}]+", " ", line.lower()).split() for line in text.split("\n")]
    theirs = regex.sub(r"[^\p{L}\p{N}]+", " ", template.lower()).split()
    theirs, out = set(itertools.pairwise(theirs)), {}
    for a in range(len(lines)):
        for b in range(a, len(lines)):
            mine = set(itertools.pairwise(itertools.chain(*lines[a:b + 1])))
            score = 2 * len(mine & theirs) / (len(mine) + len(theirs))
            if score >= threshold:
                out[a + 1, b + 1] = score
    return out


def test_wrapped_notices_and_licence_texts_inside_long_documents(spark):
    rng = random.Random(5)
    prose = ["\n".join(" ".join(f"w{rng.randrange(3000)}" for _ in range(12)) for _ in range(150))
             for _ in range(3)]
    names = ["MIT", "Apache-2.0", "GPL-3.0", "ISC", "CC0-1.0", "MIT-text", "BSD-3-Clause-text",
             "BSD-2-Clause-text", "ISC-text", "Unlicense-text"]
    both = {**licenses.TEMPLATES, **licenses.BODIES}
    texts = [f"{prose[0]}\n\n{words_wrapped(both[n])}\n\n{prose[1]}" for n in names]
    texts += [f"{prose[2]}\n{words_wrapped(both['GPL-3.0'])}\n{prose[1]}\n"
              f"{words_wrapped(both['GPL-3.0'], 60)}",  # twice
              f"{'a b ' * 3000}\n{words_wrapped(both['GPL-3.0'])}\n{'a b ' * 3000}",
              f"Copyright 2020 Some One\n\n{words_wrapped(both['MIT-text'], 78)}",  # a licence file
              prose[0]]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    runs = {}
    for r in licenses.scan_runs(table).collect():
        runs.setdefault((r["doc_id"], r["license"]), []).append((r["line"], round(r["score"], 9)))
    for i, name in enumerate(names):
        assert runs[i, name] == [(152, 1.0)]
    assert [s for _, s in sorted(runs[10, "GPL-3.0"])] == [1.0, 1.0]
    best = {r["doc_id"]: r for r in licenses.best_licenses(table).collect()}
    assert set(best) == set(range(13)) and best[12]["license"] == "MIT-text"
    assert best[11]["license"] == "GPL-3.0"


def test_runs_of_lines_equal_brute_force(spark):
    rng = random.Random(6)
    both = {**licenses.TEMPLATES, **licenses.BODIES}
    texts = []
    for i in range(12):
        lines = []
        for name in rng.sample(sorted(both), 2):
            words = both[name].split()
            lines += [" ".join(rng.choice(["w", "x", "the", ""]) for _ in range(rng.randrange(6)))
                      for _ in range(5)]
            lines += words_wrapped(" ".join(w for w in words if rng.random() < 0.95),
                                   rng.choice([25, 60, 2000])).split("\n")
        texts.append("\n".join(lines))
    runs = {}
    for r in licenses.scan_runs(spark.createDataFrame(
            list(enumerate(texts)), "doc_id long, text string")).collect():
        if r["line"]:
            runs.setdefault((r["doc_id"], r["license"]), set()).add(
                (r["line"], round(r["score"], 9)))
    for i, text in enumerate(texts):
        for name, template in both.items():
            every = slow_runs(text, template)
            own = {(a, round(s, 9)) for (a, b), s in every.items() if a == b}
            free = {(a, round(s, 9)) for (a, b), s in every.items()
                    if a < b and not any(a <= o <= b for o, _ in own)}
            whole = every.get((1, text.count("\n") + 1))
            got = runs.get((i, name), set())
            want = set() if whole else free
            if name in licenses.BODIES:
                assert own <= got
                got = got - own
            assert got <= want and bool(got) == bool(want)
            assert max(got, key=lambda r: r[1], default=(0, 0))[1] == max(
                want, key=lambda r: r[1], default=(0, 0))[1]


# ---- pieces

@pytest.fixture(scope="module")
def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_proto=tokenizer_bytes())


def odd_texts():
    rng = random.Random(1)
    signs = "abcdefghijklmnopqrstuvwxyzABC  .,;!?\n\t▁é0123456789<>()=-_'\"日\u0301😀"
    known = pieces.PieceModel(tokenizer_bytes()).pieces[259:]
    texts = ["", " ", "hello  world", "  a b ", "a\nb\t c", "▁x ▁", "<0x41></s><s><unk>",
             "\u200bx\u3000y\x00z", "a" * 500, " " * 99, "\r\n\r\n\t", "日本語 텍스트 العربية"]
    texts += ["".join(rng.choices(signs, k=rng.randint(1, 90))) for _ in range(1500)]
    return texts + ["".join(rng.choices(known, k=rng.randint(1, 12))).replace("▁", " ")
                    for _ in range(1500)]


def test_ids_and_text_equal_the_library(library):
    own = pieces.encoder(tokenizer_bytes())
    for text in odd_texts():
        ids = library.encode(text, add_eos=True)
        assert own.ids(text) == ids
        assert own.model.decode(ids) == library.decode(ids)


def test_encode_decode_query_rows(spark, library):
    texts = [None, *odd_texts()[:60], "long text, " * 30000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "x"), (3, "hello"), (3, "hello")]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn(
        "n_tokens", F.lit("clash"))
    got = Counter(map(tuple, pieces.encode_decode(table, tokenizer_bytes()).collect()))
    want = Counter()
    for key, text in rows:
        ids = library.encode(text or "", add_eos=True)
        want[(key, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
              hashlib.sha256(library.decode(ids).encode()).hexdigest())] += 1
    assert got == want
    assert pieces.encode_decode(table.limit(0), tokenizer_bytes()).collect() == []


def test_token_columns_go_round(spark):
    table = spark.createDataFrame([("a b\nc",), (None,), ("",)], "text string")
    both = pieces.decoded_text(pieces.token_ids(table, tokenizer_bytes()), tokenizer_bytes())
    assert [r["decoded"] for r in both.collect()] == ["a b\nc", "", ""]


def test_vector_and_scalar_paths_agree():
    own = pieces.encoder(tokenizer_bytes())
    for word in (" the", " thhehea", "  ing", "erereredthes", "x", " "):
        entry = ["", b""]
        own._learn([(word, entry)])
        assert [int(t) for t in entry[0].split()] == own._scalar(word)
    assert np.all(own.length[list(own.whole.values())] > 0)
