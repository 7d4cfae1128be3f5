"""Phrase collocations: exact counts of word sequences by spilling HAT-tries, and their scores.

A sequence can only be frequent if its words, pairs and triples are, so there are four passes over
the texts: words; pairs of frequent words; triples of frequent pairs; sequences of four and five
words of frequent triples. What is frequent is known to the tasks as bitmaps of fixed size. A
stranger that shares a bit is counted and dropped by its exact count: bits save work only.

Within a task, words get ids and sequences are counted in a HAT-trie: a shallow trie by word id
whose leaves are hash containers; a container that grows beyond its limit bursts into a node with
containers one word further down. When the trie is full its largest subtrees are written out whole
as sorted runs. The runs of all tasks are dealt by the prefix (a whole short sequence, the first
four words of a long one) and merged there by Spark's sums, which spill.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import settle

MOST_WORDS = 5
#: Sequences a task holds, entries of a hash container, distinct words a task knows.
TRIE_ENTRIES = 700_000
CONTAINER_ENTRIES = 4_096
VOCABULARY = 400_000
#: Bits of a word id in a task; its ids stay below VOCABULARY + WORDS_AT_ONCE.
ID_BITS = 20
#: Bytes of text that are cut into words, and words that are counted, in one go.
TEXT_AT_ONCE = 1 << 22
WORDS_AT_ONCE = 1 << 18
#: log2 of the bits that tell frequent words and pairs (8 MB each).
FILTER_BITS = 26

#: Lower-case A-Z, one mark for everything that ends a piece, one for everything between words.
_PIECE = b"."
_TABLE = bytes.maketrans(bytes(range(65, 91)) + b",;:!?\n\v\f\r\t",
                         bytes(range(97, 123)) + _PIECE * 9 + b" ")
_GAP = re.compile(rb"[ .]")


def tokens(text: bytes) -> Iterator[list[bytes]]:
    """Words and piece marks of a text in stretches of about TEXT_AT_ONCE bytes."""
    text = text.translate(_TABLE)
    start = 0
    while start < len(text):
        end = start + TEXT_AT_ONCE
        gap = _GAP.search(text, end) if end < len(text) else None
        end = gap.start() if gap else len(text)
        yield text[start:end].replace(_PIECE, b" . ").split()
        start = end


class _Node(dict):
    """A trie node: word id to node or container; a container is a plain ``{rest: count}``."""


class HatTrie:
    """Counts of id sequences of one length: trie nodes above burstable hash containers.

    A sequence is its first id and the ``rest`` packed into an integer, ID_BITS each. Containers of
    the first ``levels - 1`` levels burst above ``container`` entries. :meth:`spill` takes the
    largest subtrees of the root out.
    """

    def __init__(self, length: int, levels: int = 2, entries: int = TRIE_ENTRIES,
                 container: int = CONTAINER_ENTRIES):
        self.length, self.levels = length, min(levels, length - 1)  # a rest has an id at least
        self.entries, self.container = entries, container
        self.root = _Node()
        self.sizes: Counter = Counter()  # sequences below each child of the root
        self.held = 0

    def add_all(self, firsts: list[int], rests: list[int], counts: list[int]) -> None:
        root, sizes, limit = self.root, self.sizes, self.container
        for first, rest, n in zip(firsts, rests, counts, strict=True):
            node, key, below = root, first, root.get(first)
            if below is None:
                below = root[first] = {}
            level = 1
            while type(below) is _Node:
                node, level = below, level + 1
                shift = ID_BITS * (self.length - level)
                key, rest = rest >> shift, rest & ((1 << shift) - 1)
                below = node.get(key)
                if below is None:
                    below = node[key] = {}
            if rest in below:
                below[rest] += n
                continue
            below[rest] = n
            sizes[first] += 1
            if len(below) > limit and level < self.levels:
                node[key] = self._burst(below, ID_BITS * (self.length - level - 1))
        self.held = sizes.total()

    @staticmethod
    def _burst(container: dict, shift: int) -> _Node:
        node, mask = _Node(), (1 << shift) - 1
        for rest, n in container.items():
            node.setdefault(rest >> shift, {})[rest & mask] = n
        return node

    @property
    def full(self) -> bool:
        return self.held > self.entries

    def spill(self, keep: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of whole subtrees as one sorted run each, in order of the first id; the
        largest subtrees go until at most ``keep`` sequences are held."""
        firsts: list[int] = []
        rests: list[int] = []
        counts: list[int] = []
        for key, size in self.sizes.most_common() if keep else list(self.sizes.items()):
            if self.held <= keep:
                break
            self._walk(self.root.pop(key), 0, self.length - 1, rests, counts)
            firsts += [key] * size
            self.held -= size
            del self.sizes[key]
        half = ID_BITS * (self.length // 2)
        low = (1 << half) - 1
        columns = [np.array(firsts, np.int64)]
        for part, width in ((np.fromiter((r >> half for r in rests), np.int64, len(rests)),
                             self.length - 1 - self.length // 2),
                            (np.fromiter((r & low for r in rests), np.int64, len(rests)),
                             self.length // 2)):
            columns += [part >> ID_BITS * i & (1 << ID_BITS) - 1 for i in range(width)][::-1]
        ids = np.stack(columns, axis=1)
        order = np.lexsort(ids.T[::-1])
        return ids[order], np.array(counts, np.int64)[order]

    def _walk(self, below: dict, above: int, left: int, rests: list, counts: list) -> None:
        if type(below) is _Node:
            for key, child in below.items():
                self._walk(child, above << ID_BITS | key, left - 1, rests, counts)
        else:
            high = above << ID_BITS * left
            rests.extend([high | rest for rest in below] if high else below)
            counts.extend(below.values())


def _mix(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A hash of two word hashes."""
    mixed = first * np.uint64(0x9E3779B97F4A7C15) ^ second
    mixed = (mixed ^ mixed >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ mixed >> np.uint64(32)


def _word_hash(lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang + b"\n" + word)


class Bits:
    """A bitmap over hashes; every hash that was put in answers yes."""

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.shift = words, np.uint64(64 - bits)

    def __contains__(self, value: int) -> bool:
        place = value >> int(self.shift)
        return bool(int(self.words[place >> 6]) >> (place & 63) & 1)

    def have(self, values: np.ndarray) -> np.ndarray:
        place = values >> self.shift
        return (self.words[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)) > 0


def _bitmap(frequent: DataFrame, bits: int) -> np.ndarray:
    """The bits of ``lang, phrase`` rows. At most 2 ** (bits - 6) rows, a
    constant, reach the driver whatever the table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = []
            for lang, phrase in zip(batch.column("lang").to_pylist(),
                                    batch.column("phrase").to_pylist(), strict=True):
                parts = [np.array([_word_hash(lang, w)], np.uint64) for w in phrase.split(b" ")]
                hashes.append(reduce(_mix, parts)[0])
            place = np.array(hashes, np.uint64) >> np.uint64(64 - bits)
            yield pa.RecordBatch.from_arrays([pa.array(place.astype(np.int64))], names=["place"])
    marks = (frequent.select("lang", "phrase").mapInArrow(run, "place long")
             .groupBy(F.shiftright("place", 6).alias("at"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")))
    found = marks.toArrow()
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return words


class _Ids(dict):
    """Ids of frequent words from 1 on, 0 for a rare word or a piece mark, with their hashes."""

    def __init__(self, lang: bytes, known: Bits):
        super().__init__({_PIECE: 0})
        self.lang, self.known = lang, known
        self.words, self.hashes = [b""], [0]

    def __missing__(self, word: bytes) -> int:
        hashed = _word_hash(self.lang, word)
        new = 0
        if hashed in self.known:
            new = len(self.words)
            self.words.append(word)
            self.hashes.append(hashed)
        self[word] = new
        return new


class _Language:
    """The stream of one language's words in a task, as ids; sequences go into a HAT-trie.

    ``known`` are the bits of the frequent words, pairs, triples, as far as they are counted. The
    sequences are one word longer, after triples two.
    """

    def __init__(self, lang: bytes, known: Sequence[Bits]):
        self.lang, self.known = lang, known
        self.width = len(known) + 1 if len(known) < 3 else MOST_WORDS
        self.ids = _Ids(lang, known[0])
        self.trie = HatTrie(self.width, entries=TRIE_ENTRIES)
        self.tail = np.zeros(0, np.int64)  # ids that still wait for the words behind them

    def feed(self, words: list[bytes]) -> Iterator[pa.RecordBatch]:
        new = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
        stream = np.concatenate([self.tail, new])
        cut = max(0, len(stream) - self.width + 1)
        self.tail = stream[cut:]
        if cut:
            self._count(stream, cut)
        if self.trie.full:
            yield from self.written(self.trie.entries // 2)

    def forget(self) -> Iterator[pa.RecordBatch]:
        """Write all sequences and start with new ids."""
        yield from self.written(0)
        waiting = [self.ids.words[i] if i else _PIECE for i in self.tail]
        self.ids = _Ids(self.lang, self.known[0])
        self.tail = np.fromiter(map(self.ids.__getitem__, waiting), np.int64, len(waiting))

    def close(self) -> Iterator[pa.RecordBatch]:
        yield from self.feed([_PIECE] * (self.width - 1))
        yield from self.written(0)

    def _count(self, stream: np.ndarray, starts: int) -> None:
        """Add the sequence at each of the first ``starts`` places. All of its words, pairs and
        triples are frequent; the fifth word is 0 where only four go together."""
        fine, hashes = stream > 0, np.array(self.ids.hashes, np.uint64)[stream]
        mixed = hashes
        for length, bits in enumerate(self.known[1:], 2):
            both = np.flatnonzero(fine[:-1] & fine[1:])
            mixed = _mix(mixed[:-1], hashes[length - 1:])
            fine = np.zeros(len(mixed), bool)
            fine[both] = bits.have(mixed[both])
        at = np.flatnonzero(fine[:starts] & fine[1:starts + 1])
        if not len(at):
            return
        rest = np.zeros(len(at), np.int64)
        for step in range(1, min(self.width, 4)):
            rest = rest << ID_BITS | stream[at + step]
        if self.width == MOST_WORDS:
            fifth = np.where(fine[at + 2], stream[at + 4], 0)
        else:
            fifth = np.zeros(len(at), np.int64)
        order = np.lexsort((fifth, rest, stream[at]))
        first, rest, fifth = stream[at][order], rest[order], fifth[order]
        new = np.ones(len(at), bool)
        new[1:] = ((first[1:] != first[:-1]) | (rest[1:] != rest[:-1])
                   | (fifth[1:] != fifth[:-1]))
        counts = np.diff(np.append(np.flatnonzero(new), len(at)))
        rests = rest[new].tolist()
        if self.width == MOST_WORDS:
            rests = [r << ID_BITS | f for r, f in zip(rests, fifth[new].tolist(), strict=True)]
        self.trie.add_all(first[new].tolist(), rests, counts.tolist())

    def written(self, keep: int) -> Iterator[pa.RecordBatch]:
        """``lang, phrase, n`` of the sorted runs of spilled subtrees; of long sequences
        ``phrase`` is four words and ``w5`` the next, or null."""
        names = pa.array(self.ids.words, pa.binary())
        ids, counts = self.trie.spill(keep)
        head = min(self.width, 4)
        for start in range(0, len(ids), 50_000):
            part = ids[start:start + 50_000]
            words = [names.take(pa.array(column, mask=column == 0)) for column in part.T]
            columns = [pa.array([self.lang] * len(part), pa.binary()),
                       pc.binary_join_element_wise(*words[:head], b" "), *words[head:],
                       pa.array(counts[start:start + 50_000])]
            rest = ["w5"] if self.width > head else []
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", *rest, "n"])


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[bytes, bytes]]:
    langs = batch.column("lang").cast(pa.binary()).to_pylist()
    for lang, text in zip(langs, batch.column("text").cast(pa.binary()), strict=True):
        yield lang, text.as_py()


def _word_counts(docs: DataFrame) -> DataFrame:
    """``lang, phrase, n`` of words, partly summed; a null phrase counts all of a language."""
    def rows(lang: bytes, counts: Counter) -> pa.RecordBatch:
        keys = [*counts, None]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(keys), pa.binary()), pa.array(keys, pa.binary()),
             pa.array([*counts.values(), counts.total()], pa.int64())],
            names=["lang", "phrase", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, Counter] = {}
        for batch in batches:
            for lang, text in _texts(batch):
                counts = held.setdefault(lang, Counter())
                for words in tokens(text):
                    counts.update(words)
                    counts.pop(_PIECE, None)
                    if len(counts) > VOCABULARY:
                        yield rows(lang, counts)
                        counts.clear()
            while sum(map(len, held.values())) > VOCABULARY:
                largest = max(held, key=lambda key: len(held[key]))
                yield rows(largest, held.pop(largest))
        for lang, counts in held.items():
            yield rows(lang, counts)
    return docs.mapInArrow(run, "lang binary, phrase binary, n long")


def _fed(held: dict[bytes, _Language], waiting: dict[bytes, list[bytes]],
         known: Sequence[Bits]) -> Iterator[pa.RecordBatch]:
    """Count the waiting words; all languages of a task share the bounds on what is held."""
    for lang, words in waiting.items():
        if lang not in held:
            held[lang] = _Language(lang, known)
        yield from held[lang].feed(words)
        while sum(x.trie.held for x in held.values()) > TRIE_ENTRIES:
            yield from max(held.values(), key=lambda x: x.trie.held).written(0)
        while sum(len(x.ids) for x in held.values()) > VOCABULARY + len(held):
            yield from max(held.values(), key=lambda x: len(x.ids)).forget()


def _sequence_counts(docs: DataFrame, known: Sequence[np.ndarray], bits: int) -> DataFrame:
    """Runs of the HAT-tries of all tasks: sequences of frequent words, pairs, triples."""
    sent = docs.sparkSession.sparkContext.broadcast(list(known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [Bits(x, bits) for x in sent.value]
        held: dict[bytes, _Language] = {}
        waiting: dict[bytes, list[bytes]] = {}
        n_waiting = 0
        for batch in batches:
            for lang, text in _texts(batch):
                for words in tokens(text):
                    waiting.setdefault(lang, []).extend(words)
                    n_waiting += len(words)
                    if n_waiting > WORDS_AT_ONCE:
                        yield from _fed(held, waiting, known)
                        waiting, n_waiting = {}, 0
                waiting.setdefault(lang, []).append(_PIECE)
        yield from _fed(held, waiting, known)
        for language in held.values():
            yield from language.close()
    rest = ", w5 binary" if len(known) == 3 else ""
    return docs.mapInArrow(run, f"lang binary, phrase binary{rest}, n long")


def frequent_phrases(docs: DataFrame, least: int, lang: str = "lang", text: str = "text",
                     filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """``lang, n`` and ``lang, phrase, words, f`` (bytes) of all phrases of 1 to 5 words that
    occur ``least`` times; both settled. Words are lower-cased in A-Z only."""
    docs = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))

    def summed(runs: DataFrame, *keys: str) -> DataFrame:
        return runs.groupBy("lang", *keys).agg(F.sum("n").alias("f"))

    singles = settle(summed(_word_counts(docs), "phrase")
                     .filter(F.col("phrase").isNull() | (F.col("f") >= least)), "words")
    totals = singles.filter("phrase is null").select("lang", F.col("f").alias("n"))
    singles = singles.filter("phrase is not null")
    tables, known = [singles.select("lang", "phrase", F.lit(1).alias("words"), "f")], []
    known.append(_bitmap(singles, filter_bits))
    for length in (2, 3):
        table = settle(summed(_sequence_counts(docs, known, filter_bits), "phrase")
                       .filter(F.col("f") >= least), f"phrases-{length}")
        tables.append(table.select("lang", "phrase", F.lit(length).alias("words"), "f"))
        known.append(_bitmap(table, filter_bits))
    # one shuffle by the prefix of four words: what shares it stays together for both lengths
    prefix = ["lang", "phrase"]
    runs = _sequence_counts(docs, known, filter_bits).repartition(*prefix)
    whole = runs.groupBy(*prefix, "w5").agg(F.sum("n").alias("n"))
    grown = whole.select(*prefix, "n", F.explode(F.array(
        F.struct(F.lit(4).alias("words"), F.col("phrase").alias("longer")),
        F.struct(F.lit(5).alias("words"),
                 F.concat("phrase", F.lit(b" "), "w5").alias("longer"))))
        .alias("p")).filter("p.longer is not null")
    tables.append(grown.groupBy(*prefix, "p.words", "p.longer").agg(F.sum("n").alias("f"))
                  .filter(F.col("f") >= least)
                  .select("lang", F.col("longer").alias("phrase"), "words", "f"))
    every = reduce(DataFrame.unionByName, tables)
    return totals, settle(every, "phrases")


def _slice(first: Column | int, n: Column | int) -> Column:
    """Words ``first`` (from 1) to ``first + n - 1`` of the array ``w``, joined."""
    return F.array_join(F.slice("w", first, n), " ").cast("binary")


def scored(totals: DataFrame, phrases: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, n, score`` of the phrases of two and more words.

    Of the cuts into two parts with counts ``l`` and ``r`` the one with the least
    ``floor(1000 * a * n / (l * r))`` counts, then the earliest. Decimals of 38 digits keep the
    products exact.
    """
    parts = phrases.select("lang", "phrase", "f")
    many = phrases.filter("words > 1").withColumn("w", F.split(F.col("phrase").cast("string"), " "))
    cuts = many.select(
        "lang", "phrase", "words", F.col("f").alias("a"), "w",
        F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
            "lang", "phrase", "words", "a", "k", _slice(1, F.col("k")).alias("left"),
            _slice(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    left = parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))

    def exact(name: str, digits: int = 18) -> Column:
        return F.col(name).cast(f"decimal({digits},0)")
    score = F.expr("(cast(a * 1000 as decimal(19,0)) * cast(n as decimal(18,0)))"
                   " div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    valued = (cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
              .join(totals, "lang").withColumn("score", score))
    best = valued.groupBy("lang", "phrase", "words", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "words", "a", "best.l", "best.r", "n", "best.score")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, absorb_percent: int = 100,
                 lang: str = "lang", text: str = "text",
                 filter_bits: int = FILTER_BITS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    Texts are cut at ``.,;:!?`` and line ends into pieces, these at spaces and tabs into words,
    with A-Z lower-cased; a null text is empty, a null language ``und``. Everything is counted per
    language: ``n`` all words, ``a`` the occurrences of a phrase of 2 to 5 words (at least
    ``least``), ``l`` and ``r`` those of the parts of its lowest-scoring cut. A phrase inside a
    longer candidate that occurs ``absorb_percent`` of its times or more is dropped, whether or
    not that one is itself. Order: score, then ``a`` descending, then the bytes of the phrase.
    Documents may repeat; other columns are left out. An empty table gives an empty result.
    """
    totals, phrases = frequent_phrases(docs, least, lang, text, filter_bits)
    long = phrases.filter("words > 2").withColumn("w", F.split(F.col("phrase").cast("string"), " "))
    spans = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("words") - 1),
        lambda size: F.transform(F.sequence(F.lit(1), F.col("words") - size + 1),
                                 lambda at: F.array_join(F.slice("w", at, size), " "))))
    holders = (long.select("lang", "f", F.explode(spans).alias("inner"))
               .groupBy("lang", F.col("inner").cast("binary").alias("phrase"))
               .agg(F.max("f").alias("longest")))
    open_ = (scored(totals, phrases).join(holders, ["lang", "phrase"], "left")
             .filter(F.coalesce(F.col("longest") * 100 < F.col("a") * absorb_percent,
                                F.lit(True))))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (open_.withColumn("rank", F.row_number().over(order).cast("long"))
            .filter(F.col("rank") <= top)
            .select(F.col("lang").cast("string").alias("lang"), "rank",
                    F.col("phrase").cast("string").alias("phrase"), "a", "l", "r", "n", "score"))
