"""Phrase counts and scores against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import phrases

SCHEMA = "doc_id long, text string, lang string"


def frame(spark, rows):
    docs = [(i, text, lang) for i, (text, lang) in enumerate(rows)]
    return spark.createDataFrame(docs, SCHEMA).withColumns(
        {c: F.lit("clash") for c in ("n", "phrase", "words", "a", "rank", "w4")})


def brute(rows, least, top, percent=100):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = lang or "und"
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i:i + m])] += 1
    out = []
    for lang, found in counts.items():
        often = {p: a for p, a in found.items() if a >= least and len(p) > 1}
        inside = {}
        for p, a in often.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inside[p[i:i + m]] = max(inside.get(p[i:i + m], 0), a)
        ranked = []
        for p, a in often.items():
            if 100 * inside.get(p, 0) >= percent * a:
                continue
            score, _, k = min((1000 * a * totals[lang] // (found[p[:k]] * found[p[k:]]), k, k)
                              for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        out += [(lang, r + 1, p.decode(), -a, x, y, totals[lang], -score)
                for r, (score, a, p, x, y) in enumerate(sorted(ranked)[:top])]
    return sorted(out)


def made(seed=2):
    rng = random.Random(seed)
    words = ["der", "Die", "das", "Größe", "x", "ÄRA", "new", "YORK", "city", "\x00odd", "日本"]
    rows = []
    for _ in range(150):
        text = "".join(rng.choice(words) + rng.choice([" "] * 12 + ["\t", ". ", ",", "\r\n", " ; "])
                       for _ in range(rng.choice([1, 5, 80])))
        rows.append((text, rng.choice(["en", "de", None])))
    rows += [("New York city hall opens today", "en")] * 40
    return [*rows, (None, "en"), ("", None), (" .,\t", "de"), ("a a a a a a a a", "fr"),
            ("long " * 3000 + "tail", "en")]


def test_collocations_equal_plain_counting(spark):
    rows = made()
    docs = frame(spark, rows).repartition(3)
    got = phrases.collocations(docs, least=5, top=60, filter_bits=16)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 60)
    got = phrases.collocations(docs, least=12, top=500, absorb_percent=80, filter_bits=6)
    assert sorted(map(tuple, got.collect())) == brute(rows, 12, 500, 80)


def test_no_rows(spark):
    assert phrases.collocations(frame(spark, []), least=1).collect() == []


def packed(path):
    rest = 0
    for i in path[1:]:
        rest = rest << phrases.ID_BITS | i
    return rest


@pytest.mark.parametrize("length", [2, 3, 5])
def test_trie_bursts_and_spills_whole_subtrees(length):
    rng = random.Random(5)
    trie = phrases.HatTrie(length, levels=3, entries=500, container=8)
    want, got, burst = Counter(), Counter(), 0

    def take(keep):
        ids, counts = trie.spill(keep)
        paths = list(map(tuple, ids.tolist()))
        assert paths == sorted(paths) and len(set(paths)) == len(paths)
        assert not {path[0] for path in paths} & set(trie.root)  # no subtree is left in part
        got.update(dict(zip(paths, counts.tolist(), strict=True)))
        assert trie.held <= keep

    for _ in range(500):
        paths = [tuple(rng.choice([1, 1, 2, rng.randrange(1, 40)]) for _ in range(length))
                 for _ in range(10)]
        counts = [rng.randrange(1, 4) for _ in paths]
        for path, n in zip(paths, counts, strict=True):
            want[path] += n
        trie.add_all([p[0] for p in paths], [packed(p) for p in paths], counts)
        burst += type(trie.root[paths[0][0]]) is phrases._Node
        if trie.full:
            take(250)
    take(0)
    assert got == want and (burst > 0) == (length > 2)


@pytest.mark.parametrize("known", [1, 2, 3])
def test_task_with_small_bounds_counts_the_same(monkeypatch, known):
    monkeypatch.setattr(phrases, "TRIE_ENTRIES", 30)
    monkeypatch.setattr(phrases, "VOCABULARY", 6)
    monkeypatch.setattr(phrases, "TEXT_AT_ONCE", 16)
    everything = phrases.Bits(np.full(4, np.iinfo(np.uint64).max, np.uint64), 8)
    rng, held, total, want = random.Random(7), {}, Counter(), Counter()
    least, most = (known + 1, known + 1) if known < 3 else (4, 5)

    def count(batches):
        for batch in batches:
            for row in batch.to_pylist():
                more = [row["w5"]] if row.get("w5") else []
                total[tuple(row["phrase"].split() + more)] += row["n"]

    for _ in range(20):
        text = " ".join(rng.choice("abcdefghij") * rng.choice([1, 2]) for _ in range(60)) + ".x y z"
        parts = list(phrases.tokens(text.encode()))
        assert [w for p in parts for w in p] == text.replace(".", " . ").encode().split()
        for part in [*parts, [b"."]]:
            count(phrases._fed(held, {b"en": part}, [everything] * known))
        for piece in text.split("."):
            words = piece.encode().split()
            for i in range(len(words) - least + 1):
                want[tuple(words[i:i + most])] += 1
    count(held[b"en"].close())
    assert total == want
