"""Quality classifier (operator 8): a factorisation machine.

Features of a document: its words hashed to ``BUCKETS`` (log counts, unit
length), structure statistics of the whole text (shares of character classes,
repetition of words, pairs and lines, lengths), and metadata (n_chars, where
the table has it). Score: bias, linear weights and the interactions of all
pairs of features through ``RANK`` factors, in linear time by
sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

It is fitted by AdaGrad on at most ``MAX_LABELLED`` labelled rows outside the
held-out fold (their features are what reaches the driver); the weights are a
fixed-size broadcast. Every document is scored in one pass without a shuffle.

Null or empty texts have zero features and get the score that the model gives
those. Without usable labels, or with one class only, the score is the share of
good labels (0.5 without any). Repeated rows each give a row. Other columns
pass through; one whose name equals an output's is replaced.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pmflow.llm.common import append_columns, column
from pmflow.llm.labels import MAX_LABELLED, fold, labelled

BUCKETS = 1 << 12
RANK = 8
EPOCHS = 6
BATCH = 64
RATE = 0.05
DECAY = 1e-4
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
#: Weight of the hashed words beside the statistics.
WORDS_WEIGHT = 0.5
CACHE_WORDS = 500_000

#: Character classes, by byte: 0 other, 1 lower, 2 upper, 3 digit, 4 space,
#: 5 newline, 6 sentence mark, 7 further punctuation, 8 beyond ASCII.
_CLASS = np.array([
    5 if c == 10 else 4 if c in (9, 11, 12, 13, 32) else 3 if 48 <= c <= 57 else 2 if 65 <= c <= 90 else
    1 if 97 <= c <= 122 else 8 if c >= 128 else 6 if chr(c) in ".,;:?'\"-()" else 7 if 33 <= c <= 126 else 0
    for c in range(256)], np.uint8)
_MARKS = np.frombuffer(b"!|$%&*#@_=+<>{}[]/\\~^`", np.uint8)
STATISTICS = 9 + len(_MARKS) + 18
FEATURES = BUCKETS + STATISTICS


class _Buckets(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = b = zlib.crc32(word.lower()) % BUCKETS
        return b


def features(text: str | None, n_chars, buckets: _Buckets) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of the non-zero features; the statistics come last."""
    raw = (text or "").encode()
    words = raw.split()
    stats = np.zeros(STATISTICS)
    if words:
        chars = np.frombuffer(raw, np.uint8)
        counts = np.bincount(chars, minlength=256)
        n, w = len(raw), len(words)
        stats[:9] = np.bincount(_CLASS, counts, minlength=9) / n
        stats[9:9 + len(_MARKS)] = np.minimum(counts[_MARKS] / w, 2.0)
        length = np.fromiter(map(len, words), np.int64, w)
        ids = np.fromiter([buckets[x] for x in words], np.int64, w)
        hashed = ids * 64 + np.minimum(length, 63)
        pairs = hashed[:-1] * 1_000_003 + hashed[1:] if w > 1 else hashed
        lines = [x for x in raw.split(b"\n") if x.strip()]
        top = np.bincount(ids, minlength=1)
        own = [len(np.unique(hashed)) / w, len(np.unique(pairs)) / len(pairs), len(set(lines)) / len(lines),
               float((hashed[1:] == hashed[:-1]).mean()) if w > 1 else 0.0, top.max() / w,
               length.mean() / 10, length.std() / 10, float((length > 20).mean()), float((length == 1).mean()),
               np.log1p(w) / 10, np.log1p(len(lines)) / 10, np.log1p(w / len(lines)) / 10, w ** -0.5,
               float((_CLASS[chars[:-1]] == 7)[_CLASS[chars[1:]] == 7].sum()) / w if n > 1 else 0.0,
               sum(1 for x in lines if x[-1:] in b".!?\"'") / len(lines),
               len(re.findall(rb"https?://|www\.|@\w", raw)) / w,
               np.log1p(max(n_chars, 0)) / 12 if n_chars is not None else 0.0,
               float(n_chars is not None)]
        stats[9 + len(_MARKS):] = own
        at, many = np.unique(ids, return_counts=True)
        value = np.log1p(many)
        value *= WORDS_WEIGHT / np.sqrt((value ** 2).sum())
    else:
        at, value = np.zeros(0, np.int64), np.zeros(0)
    there = np.flatnonzero(stats)
    return (np.concatenate([at, BUCKETS + there]).astype(np.int32),
            np.concatenate([value, stats[there]]).astype(np.float32))


class FactorisationMachine:
    def __init__(self, bias: float = 0.0, weights=None, factors=None, scale=None):
        self.bias = bias
        self.weights = np.zeros(FEATURES) if weights is None else weights
        self.factors = np.zeros((FEATURES, RANK)) if factors is None else factors
        self.scale = np.ones(FEATURES, np.float32) if scale is None else scale

    def margin(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Score before the logistic function, all rows side by side."""
        if not rows:
            return np.zeros(0)
        size = np.array([len(i) for i, _ in rows])
        i = np.concatenate([i for i, _ in rows])
        x = np.concatenate([v for _, v in rows]) * self.scale[i]
        doc = np.repeat(np.arange(len(rows)), size)
        linear = np.bincount(doc, self.weights[i] * x, minlength=len(rows))
        vx = self.factors[i] * x[:, None]
        total = np.stack([np.bincount(doc, vx[:, f], minlength=len(rows)) for f in range(RANK)], 1)
        squares = np.bincount(doc, (vx ** 2).sum(axis=1), minlength=len(rows))
        return self.bias + linear + 0.5 * ((total ** 2).sum(axis=1) - squares)

    def scores(self, rows) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -35, 35)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> FactorisationMachine:
        """AdaGrad on the logistic loss; both classes weigh alike."""
        rng = np.random.default_rng(7)
        total = np.zeros(FEATURES)
        for i, v in rows:
            total[i] += np.abs(v)
        seen = np.zeros(FEATURES, np.int64)
        for i, _ in rows:
            seen[i] += 1
        mean = total / np.maximum(seen, 1)
        self.scale[BUCKETS:] = np.where(seen[BUCKETS:] > 0, 0.5 / np.maximum(mean[BUCKETS:], 1e-3), 1.0)
        self.scale = np.minimum(self.scale, 20.0).astype(np.float32)
        self.factors = rng.normal(0, 0.02, (FEATURES, RANK))
        good = labels == 1
        weigh = np.where(good, 0.5 / good.mean(), 0.5 / (1 - good.mean()))
        gb, gw, gv = 1e-6, np.full(FEATURES, 1e-6), np.full((FEATURES, RANK), 1e-6)
        for _ in range(EPOCHS):
            order = rng.permutation(len(rows))
            for a in range(0, len(order), BATCH):
                pick = order[a:a + BATCH]
                part = [rows[k] for k in pick]
                error = (self.scores(part) - labels[pick]) * weigh[pick] / len(pick)
                i = np.concatenate([i for i, _ in part])
                x = np.concatenate([v for _, v in part]) * self.scale[i]
                doc = np.repeat(np.arange(len(part)), [len(i) for i, _ in part])
                vx = self.factors[i] * x[:, None]
                total = np.stack([np.bincount(doc, vx[:, f], minlength=len(part)) for f in range(RANK)], 1)
                own, place = np.unique(i, return_inverse=True)
                slope = error[doc] * x
                dw = np.bincount(place, slope) + DECAY * self.weights[own]
                inner = slope[:, None] * (total[doc] - vx)
                dv = np.stack([np.bincount(place, inner[:, f]) for f in range(RANK)], 1) + DECAY * self.factors[own]
                db = error.sum()
                gb += db ** 2
                gw[own] += dw ** 2
                gv[own] += dv ** 2
                self.bias -= RATE * db / np.sqrt(gb)
                self.weights[own] -= RATE * dw / np.sqrt(gw[own])
                self.factors[own] -= RATE * dv / np.sqrt(gv[own])
        return self


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          folds: int = FOLDS, held_out: int = HELD_OUT, at_most: int = MAX_LABELLED) -> FactorisationMachine:
    rows = labelled(_with_chars(docs, text), labels, label, folds, held_out, key, "_both", at_most)
    made = append_columns(rows, {"text": F.col("text")}, "i binary, x binary", _feature_bytes, ["text"])
    got = made.select("key", "label", "i", "x").collect()  # at_most rows of bounded size
    got.sort(key=lambda r: (str(r["key"]), bytes(r["i"]), bytes(r["x"])))
    y = np.array([r["label"] for r in got], np.float64)
    if not len(y) or y.min() == y.max():
        share = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
        return FactorisationMachine(float(np.log(share / (1 - share))))
    x = [(np.frombuffer(r["i"], np.int32), np.frombuffer(r["x"], np.float32)) for r in got]
    return FactorisationMachine().fit(x, y)


def _with_chars(docs: DataFrame, text: str) -> DataFrame:
    """The text behind its n_chars, one string: labelled() carries one column."""
    chars = column("n_chars").cast("long").cast("string") if "n_chars" in docs.columns else F.lit(None).cast("string")
    return docs.withColumn("_both", F.concat(F.coalesce(chars, F.lit("")), F.lit("\n"),
                                             F.coalesce(column(text).cast("string"), F.lit(""))))


def _split(both: str):
    chars, _, text = both.partition("\n")
    return text, int(chars) if chars else None


def _feature_bytes():
    buckets = _Buckets()

    def run(text):
        rows = [features(*_split(t), buckets) for t in text]
        return [[i.tobytes() for i, _ in rows], [x.tobytes() for _, x in rows]]
    return run


def score(docs: DataFrame, model: FactorisationMachine, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of good quality."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    chars = column("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")

    def make():
        buckets, fm = _Buckets(), shared.value

        def run(text, n_chars):
            out = []
            for a in range(0, len(text), 100):
                rows = [features(t, n, buckets) for t, n in zip(text[a:a + 100], n_chars[a:a + 100])]
                out += fm.scores(rows).tolist()
            return [out]
        return run
    return append_columns(docs, {"text": column(text).cast("string"), "n_chars": chars}, f"{out} double", make)


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score, held_out and predicted (1: good)."""
    scored = score(docs, train(docs, labels, key, text), text)
    return scored.withColumn("held_out", F.coalesce(fold(column(key), FOLDS) == HELD_OUT, F.lit(False))).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
