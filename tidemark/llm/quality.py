"""Quality by attention-based multiple-instance learning.

A document is a bag of passages (128 words each). Every passage is encoded as the shape of its text:
shares of byte classes, of pairs of coarser classes, its length and how many of its words are
distinct. A small network reads the bag: each passage becomes a hidden vector, a gated attention
(tanh gate times sigmoid gate) learnt from document labels alone weighs the passages, and the
weighted sum is scored. Word identities are no features, so the model carries over to unseen words.

The network is fitted in one task on a bounded sample (:class:`Settings`); encoding and scoring
run over whole texts where they lie.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_fold, labelled, map_batches, utf8_values
from tidemark.session import settle

WORDS_PER_PASSAGE = 128
BYTES_AT_ONCE = 1 << 19


@dataclass(frozen=True)
class Settings:
    """Bounds and shape of the fit. The sample is drawn by hash of the key: the ``sample`` first
    labelled documents, each with at most ``passages`` passages drawn from its whole text (scoring
    reads all of them).
    """

    sample: int = 6000
    passages: int = 128
    hidden: int = 24
    attention: int = 12
    epochs: int = 40
    batch: int = 128
    rate: float = 0.003
    decay: float = 1e-3
    seed: int = 3


FINE, COARSE = 64, 16


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Byte to one of 64 fine and one of 16 coarse classes."""
    fine, coarse = np.full(256, 63, np.int64), np.full(256, 15, np.int64)
    groups = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ",
              b"\n", b"\t\r\x0b\x0c", b".", b",;:", b"!?", b"|", b"#$%&*@^~", b"\"'`()[]{}<>",
              b"-_/\\+="]
    for number, group in enumerate(groups):
        coarse[list(group)] = number
    coarse[0x80:0xC0], coarse[0xC0:0x100] = 13, 14
    fine[list(groups[0])], fine[list(groups[1])], fine[list(groups[2])] = 0, 1, 2
    for vowel in b"aeiou":
        fine[vowel] = 3
    for number, byte in enumerate(sorted(set(range(128)) - set(b"".join(groups[:3])))):
        if byte >= 32 or byte in b"\n\t\r":
            fine[byte] = 4 + number % 48
    fine[0x80:0xC0], fine[0xC0:0xE0], fine[0xE0:0x100] = 60, 61, 62
    return fine, coarse


FINE_CLASS, COARSE_CLASS = _classes()
SPACE = np.zeros(256, bool)
SPACE[list(b" \t\n\r\x0b\x0c")] = True
FEATURES = FINE + COARSE * COARSE + 3
_MIX = np.random.default_rng(1).integers(1, 2 ** 63, 256, np.uint64) | np.uint64(1)


def _parts(text: bytes) -> list[bytes]:
    """A very long text in parts that end at white space where there is any."""
    parts = []
    while len(text) > BYTES_AT_ONCE:
        cut = max(text.rfind(b" ", 0, BYTES_AT_ONCE), text.rfind(b"\n", 0, BYTES_AT_ONCE)) + 1
        cut = cut or BYTES_AT_ONCE
        parts.append(text[:cut])
        text = text[cut:]
    return [*parts, text]


def _encode_block(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of the passages of some texts, and the text each belongs to."""
    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    lengths = np.array([len(t) + 1 for t in texts])
    owner = np.repeat(np.arange(len(texts)), lengths)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    space = SPACE[joined]
    starts = ~space & np.concatenate([[True], space[:-1]])
    word = np.cumsum(starts)
    base = word[first] - starts[first]
    place = np.maximum(word - base[owner] - 1, 0) // WORDS_PER_PASSAGE
    last = place[first + lengths - 1] + 1
    offset = np.concatenate([[0], np.cumsum(last)[:-1]])
    passage = place + offset[owner]
    n = int(last.sum())
    size = np.bincount(passage, minlength=n).astype(np.float32)[:, None]
    fine = np.bincount(passage * FINE + FINE_CLASS[joined], minlength=n * FINE)
    coarse = COARSE_CLASS[joined]
    pairs = np.bincount(passage[1:] * 256 + coarse[:-1] * COARSE + coarse[1:], minlength=n * 256)
    # words: a wrapping sum of mixed bytes by position, to count the distinct ones of a passage
    at = np.flatnonzero(starts)
    words = np.zeros(n)
    distinct = np.zeros(n)
    if len(at):
        step = (np.arange(len(joined)) - at[np.maximum(word - 1, 0)]).astype(np.uint64)
        mixed = _MIX[joined] * (step * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1))
        mixed[space] = 0
        hashes = np.add.reduceat(mixed, at)
        home = passage[at].astype(np.uint64)
        keys = np.sort((hashes >> np.uint64(24)) | (home << np.uint64(40)))
        fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
        words = np.bincount(passage[at], minlength=n)
        distinct = np.bincount((keys[fresh] >> np.uint64(40)).astype(np.int64), minlength=n)
    x = np.concatenate([
        np.sqrt(fine.reshape(n, FINE) / size), np.sqrt(pairs.reshape(n, 256) / size),
        (distinct / np.maximum(words, 1))[:, None], np.log1p(words)[:, None] / 5,
        (size[:, 0] / np.maximum(words, 1))[:, None].clip(0, 64) / 16], axis=1)
    return x.astype(np.float32), np.repeat(np.arange(len(texts)), last)


def _groups(texts: list[bytes]):
    """Neighbouring texts of together at most ``BYTES_AT_ONCE`` bytes, or single longer ones."""
    group, held = [], 0
    for text in texts:
        if group and held + len(text) > BYTES_AT_ONCE:
            yield group
            group, held = [], 0
        group.append(text)
        held += len(text)
    if group:
        yield group


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`_encode_block` for any number of texts of any length; every text has a passage."""
    xs, owners, block, whose, held = [], [], [], [], 0

    def flush():
        x, owner = _encode_block(block)
        xs.append(x)
        owners.append(np.array(whose)[owner])
    for i, text in enumerate(texts):
        for part in _parts(text):
            if block and held + len(part) > BYTES_AT_ONCE:
                flush()
                block, whose, held = [], [], 0
            block.append(part)
            whose.append(i)
            held += len(part)
    if block:
        flush()
    if not xs:
        return np.zeros((0, FEATURES), np.float32), np.zeros(0, np.int64)
    return np.concatenate(xs), np.concatenate(owners)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionNetwork:
    """Parameters ``p`` of the network and its passes over bags laid end to end."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p

    @classmethod
    def fresh(cls, mean: np.ndarray, scale: np.ndarray, s: Settings) -> AttentionNetwork:
        rng = np.random.default_rng(s.seed)

        def matrix(rows: int, columns: int) -> np.ndarray:
            return (rng.normal(size=(rows, columns)) / np.sqrt(rows)).astype(np.float32)
        return cls({"mean": mean, "scale": scale, "W": matrix(len(mean), s.hidden),
                    "b": np.zeros(s.hidden, np.float32), "V": matrix(s.hidden, s.attention),
                    "U": matrix(s.hidden, s.attention), "w": matrix(s.attention, 1)[:, 0],
                    "c": matrix(s.hidden, 1)[:, 0], "d": np.zeros(1, np.float32)})

    def forward(self, x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        """``first`` holds the row at which each bag starts; no bag is empty."""
        p = self.p
        x = np.clip((x - p["mean"]) / p["scale"], -6, 6)
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * g) @ p["w"]
        sizes = np.diff(np.append(first, len(x)))
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), sizes))
        a = e / np.repeat(np.add.reduceat(e, first), sizes)
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "sizes": sizes,
                "y": _sigmoid(z @ p["c"] + p["d"])}

    def gradient(self, f: dict[str, np.ndarray], first: np.ndarray,
                 y: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        dy = (f["y"] - y) / len(y)
        dz = np.repeat(dy[:, None] * p["c"], f["sizes"], axis=0)
        da = (dz * f["h"]).sum(axis=1)
        de = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, first), f["sizes"]))
        dtg = de[:, None] * p["w"]
        dt, dg = dtg * f["g"] * (1 - f["t"] ** 2), dtg * f["t"] * f["g"] * (1 - f["g"])
        dh = f["a"][:, None] * dz + dt @ p["V"].T + dg @ p["U"].T
        dpre = dh * (1 - f["h"] ** 2)
        return {"W": f["x"].T @ dpre, "b": dpre.sum(axis=0), "V": f["h"].T @ dt,
                "U": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ dy,
                "d": dy.sum(keepdims=True)}

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """One score per text; passages are held for a few hundred KB of text at a time."""
        out = [np.zeros(0)]
        for group in _groups(texts):
            x, owner = encode(group)
            out.append(self.forward(x, np.searchsorted(owner, np.arange(len(group))))["y"])
        return np.concatenate(out)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.p)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> AttentionNetwork:
        with np.load(io.BytesIO(data)) as stored:
            return cls({k: stored[k] for k in stored.files})


def fit(bags: list[np.ndarray], y: np.ndarray, s: Settings) -> AttentionNetwork:
    """Adam on mini-batches of bags; deterministic for given rows in a given order."""
    if not bags or y.min() == y.max():  # one class, or none: a constant
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
        net = AttentionNetwork.fresh(np.zeros(FEATURES, np.float32),
                                     np.ones(FEATURES, np.float32), s)
        net.p["c"][:] = 0
        net.p["d"][:] = np.log(share / (1 - share))
        return net
    x = np.concatenate(bags)
    sizes = np.array([len(b) for b in bags])
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    net = AttentionNetwork.fresh(x.mean(axis=0), x.std(axis=0) + 0.02, s)
    share = y.mean()
    net.p["d"][:] = np.log(share / (1 - share))
    rng = np.random.default_rng(s.seed + 1)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()
              if k not in ("mean", "scale")}
    rounds = max(s.epochs, -(-600 // max(1, len(bags) // s.batch)))  # small samples: more epochs
    step = 0
    for _ in range(rounds):
        order = rng.permutation(len(bags))
        for at in range(0, len(bags), s.batch):
            chosen = order[at:at + s.batch]
            n = sizes[chosen]
            begin = np.concatenate([[0], np.cumsum(n)[:-1]])
            rows = np.repeat(first[chosen] - begin, n) + np.arange(n.sum())
            forward = net.forward(x[rows], begin)
            step += 1
            for k, grad in net.gradient(forward, begin, y[chosen]).items():
                m, v = moment[k]
                if k not in ("b", "d"):
                    grad = grad + s.decay * net.p[k]
                m += 0.1 * (grad - m)
                v += 0.001 * (grad ** 2 - v)
                net.p[k] -= s.rate * (m / (1 - 0.9 ** step)) / (
                    np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


def drawn(bag: np.ndarray, s: Settings) -> np.ndarray:
    """At most ``passages`` rows of a bag, spread at random over the whole of it, in order."""
    if len(bag) <= s.passages:
        return bag
    rng = np.random.default_rng([s.seed, len(bag)])
    return bag[np.sort(rng.choice(len(bag), s.passages, replace=False))]


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id",
          text: str = "text", settings: Settings = Settings()) -> bytes:
    """The fitted network as bytes; pass only rows that may be learnt from.

    Without labels, or with labels of one class, every score is that class's share (0.5 without).
    """
    # ``sample`` narrow rows bound this broadcast
    marks = settle(labelled(docs, labels, label, key)
                   .orderBy(F.xxhash64(key, F.lit(1)), key).limit(settings.sample), "sample")

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        data = [drawn(encode([text])[0], settings).astype(np.float16).tobytes()
                for text in utf8_values(batch.column(1))]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(data, pa.binary())],
            names=["id", "label", "x"])

    bags = map_batches(
        docs.select(F.col(key).cast("string").alias("id"), F.col(text).alias("text"), key)
        .join(F.broadcast(marks), key).select("id", "text", "label"),
        read, "id string, label int, x binary")

    def learn(batches):
        rows = sorted((r["id"], r["label"], r["x"]) for b in batches for r in b.to_pylist())
        data = [np.frombuffer(r[2], np.float16).reshape(-1, FEATURES).astype(np.float32)
                for r in rows]
        net = fit(data, np.array([r[1] for r in rows], np.float32), settings)
        yield pa.RecordBatch.from_arrays([pa.array([net.to_bytes()], pa.binary())],
                                         names=["model"])
    # one task on purpose: the sample is bounded by ``settings``
    return settle(bags, "bags").repartition(1).mapInArrow(learn, "model binary").first()["model"]


def score(docs: DataFrame, model: bytes, key: str = "doc_id", text: str = "text",
          carry: bool = False) -> DataFrame:
    """``key, score`` per row, or all columns and ``score`` with ``carry``; null text as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def quality(values: pd.Series) -> pd.Series:
        net = AttentionNetwork.from_bytes(shared.value)
        found = net.scores([(v or "").encode() for v in values])
        return pd.Series(found, dtype="float64")

    kept = [c for c in docs.columns if c != "score"] if carry else [key]
    return docs.withColumn("score", quality(F.col(text))).select(*kept, "score")


def quality_scores(docs: DataFrame, labels: DataFrame, carry: bool = False, folds: int = 3,
                   held_out: int = 1, threshold: float = 0.5) -> DataFrame:
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
