"""Toxicity (operator 7): weighted words in the states of their clauses.

Words map to classes: insult, threat, target, negation, reported speech, or
none. Insult stems (whole words, or what words begin with) and their weights
are learned from labelled rows; the other classes are short word lists. A
clause (up to a sentence or clause mark, or the end of a line) is run through
with a state of two flags and whether it has a target; it is not a composition
of transducers, and an insult without a target counts too: negation and reported speech open a
scope inside the clause, a target anywhere in it addresses it, and an insult
or threat word emits its weight in the state the others are in. So what counts
is the matched clause: "not an idiot" and "she said he is a clown" land in
other cells than "you idiot". The cells' weights are then fitted on labelled
rows, starting from and held near a prior that discounts negated and reported
clauses; a document's score is the logistic function of its cells' sums.

Stems are learned on four fifths of the sample, the cells' weights on the
rest; labels of the held-out fold are never used. The sample is bounded by
``MAX_LABELLED``, the learned grammar by ``MAX_STEMS``. Every document is
scored over its whole text in one pass without a shuffle.

Null and empty texts have no clause: they get the score of a document without
a match. Without usable labels no stem is known and the threat patterns alone
count. Repeated rows each give a row. Other columns pass through; one whose
name equals an output's is replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pmflow.llm.common import append_columns, bounded_batches, column, materialise
from pmflow.llm.labels import MAX_LABELLED, fold, labelled

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.5
MAX_STEMS = 5_000
MOST_ODDS = 7.0
#: Letters that a beginning has; whole words may have any number.
STEM_LETTERS = range(4, 8)
CACHE_WORDS = 500_000

TARGET = frozenset("""you your youre u he she they him her them his their this these those such people
    du dich dir ihr euch er sie ihn ihm diese dieser tu toi te vous il elle ils elles lui eux cette ce ces tú te ti usted
    ustedes él ella ellos ellas este esta estos estas""".split())
NEGATION = frozenset("""not no never none nobody isn't aren't wasn't don't doesn't didn't nicht kein keine keinen nie
    niemals pas jamais aucun aucune nunca ningún ninguna tampoco""".split())
REPORTED = frozenset("""said says say saying told tells claimed claims wrote writes quoted quotes reported allegedly
    called sagte sagt behauptet behauptete schrieb zitiert dit disait affirme écrit dijo dice dijeron afirma escribió
    """.split())
THREAT = frozenset("""kill hurt destroy murder beat shoot stab strangle töten umbringen verletzen vernichten tuer
    frapper détruire matar golpear destruir""".split())
#: State of a clause: negation scope, reported scope, target.
NONE, INSULT, THREAT_WORD, TARGET_WORD, NEGATION_WORD, REPORTED_WORD = range(6)
KINDS = 2  # insult, threat
CELLS = KINDS * 8
#: Words for which a negation's scope lasts.
NEGATION_SCOPE = 4

_STRIP = re.compile(r"^[\W\d_]+|[\W\d_]+$")
_PART = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
_MARK = re.compile(r"[.!?;:,…]['\")\]]*$")


def _prior() -> np.ndarray:
    """Weight of each cell before any label is seen."""
    w = np.zeros(CELLS)  # once for the sums, once for the sums per hundred words
    for kind in range(KINDS):
        for state in range(8):
            negated, reported, target = state & 1, state >> 1 & 1, state >> 2 & 1
            w[kind * 8 + state] = (1.0 if kind == 0 else 0.6) * (0.5 if negated else 1) * (
                0.6 if reported else 1) * (1.3 if target else 1)
    return np.tile(2 * w, 2)


class Grammar:
    """Learned stems with weights, and the cells' weights."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], bias: float = -3.0, cells=None):
        self.words, self.stems, self.bias = words, stems, bias
        self.cells = _prior() if cells is None else cells

    def insult(self, word: str) -> float:
        if (w := self.words.get(word)) is not None:
            return w
        for n in reversed(STEM_LETTERS):
            if len(word) >= n and (w := self.stems.get(word[:n])) is not None:
                return w
        return 0.0


class _Classes(dict):
    """Token (as it stands between white space) -> a list of (class, weight)
    of its words, and whether it ends a clause. Plain tokens map to None."""

    def __init__(self, grammar: Grammar):
        self.grammar = grammar

    def __missing__(self, token: str):
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = []
        for part in _PART.findall(token.lower()):
            weight = self.grammar.insult(part)
            kind = (INSULT if weight > 0 else THREAT_WORD if part in THREAT else NEGATION_WORD if part in NEGATION
                    else REPORTED_WORD if part in REPORTED else TARGET_WORD if part in TARGET else NONE)
            if kind != NONE:
                found.append((kind, weight if kind == INSULT else 1.0))
        end = bool(_MARK.search(token))
        out = (found, end) if found or end else None
        self[token] = out
        return out


def cells(text: str | None, classes: _Classes) -> np.ndarray | None:
    """Sums per cell over all clauses of the text; None: nothing matched."""
    out = None
    for line in (text or "").split("\n"):
        tokens = line.split()
        seen = [classes[t] for t in tokens]
        if not any(x is not None and any(k in (INSULT, THREAT_WORD) for k, _ in x[0]) for x in seen):
            continue
        out = np.zeros(CELLS) if out is None else out
        clause: list = []
        for x in [*seen, ([], True)]:
            if x is None:
                clause.append((NONE, 0.0))
                continue
            clause += x[0] or [(NONE, 0.0)]
            if x[1]:
                _run(clause, out)
                clause = []
    return out


def _run(clause: list, out: np.ndarray) -> None:
    """One clause, word by word."""
    target = any(k == TARGET_WORD for k, _ in clause)
    negated, reported = 0, False
    for kind, weight in clause:
        if kind == NEGATION_WORD:
            negated = NEGATION_SCOPE + 1
        elif kind == REPORTED_WORD:
            reported = True
        elif kind == INSULT or kind == THREAT_WORD and target:
            out[(kind == THREAT_WORD) * 8 + (negated > 0) + 2 * reported + 4 * target] += weight
        negated = max(0, negated - 1)


def _candidates(text: str) -> set[tuple[str, bool]]:
    """Whole words and beginnings of a text's words, each once."""
    out = set()
    for w in set(_PART.findall(text.lower())):
        out.add((w, True))
        for n in STEM_LETTERS:
            if len(w) > n:
                out.add((w[:n], False))
    return out


def _stem_counts(rows: DataFrame) -> DataFrame:
    """(stem, whole, toxic, clean): documents of either class with the stem."""
    def run(batches):
        toxic, clean = Counter(), Counter()
        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                (toxic if y == 1 else clean).update(_candidates(t or ""))
        # what no toxic document here holds may be toxic elsewhere: all go on
        keys = list(toxic.keys() | clean.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()),
             pa.array([toxic[k] for k in keys], pa.int64()), pa.array([clean[k] for k in keys], pa.int64())],
            ["stem", "whole", "toxic", "clean"])
    bounded_batches(rows.sparkSession)
    return rows.select("text", "label").mapInArrow(run, "stem string, whole boolean, toxic bigint, clean bigint") \
        .groupBy("stem", "whole").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          at_most: int = MAX_LABELLED) -> Grammar:
    rows = materialise(labelled(docs, labels, label, FOLDS, HELD_OUT, key, text, at_most), "labelled")
    part = fold(F.col("key"), 2 * FOLDS)  # of the folds that remain, one half of a fold fits the cells
    for_cells = part == FOLDS + 1
    stems = rows.where(~for_cells)
    n = dict(stems.groupBy("label").count().collect())
    n_toxic, n_clean = n.get(1, 0), sum(v for k, v in n.items() if k != 1)
    if not n_toxic or not n_clean:
        return Grammar({}, {})
    counts = materialise(_stem_counts(stems).where("toxic >= 2"), "stems")
    share = n_toxic / (n_toxic + n_clean)
    # a stem counts if its documents are toxic far beyond the share of toxic
    # ones: by chance none of the candidates should reach the margin
    margin = math.log(max(counts.count(), 1)) + 3.0
    rate = (F.col("toxic") + 0.01) / (F.col("toxic") + F.col("clean") + 0.02)
    gain = F.col("toxic") * F.log(rate / share) + F.col("clean") * F.log((1 - rate) / (1 - share))
    picked = counts.withColumn("gain", gain).withColumn("odds", F.log(
        ((F.col("toxic") + 0.5) / (n_toxic + 1)) / ((F.col("clean") + 0.5) / (n_clean + 1))))
    picked = picked.where((F.col("gain") > margin) & (F.col("odds") > 1.5)).orderBy(
        F.col("gain").desc(), "stem").limit(MAX_STEMS).collect()  # a bounded grammar
    kept = _plainest([(r["stem"], r["whole"], r["toxic"], r["odds"]) for r in picked])
    words = {s: min(odds, MOST_ODDS) / 3 for s, whole, _, odds in kept if whole}
    begins = {s: min(odds, MOST_ODDS) / 3 for s, whole, _, odds in kept if not whole}
    return _fit_cells(Grammar(words, begins), rows.where(for_cells))


def _plainest(picked: list[tuple]) -> list[tuple]:
    """Of stems that contain each other, (stem, whole, toxic, odds), the one
    that says it best: a beginning goes if a longer stem explains most of its
    documents with better odds, and what a kept beginning covers goes too."""
    picked = sorted(picked, key=lambda x: (len(x[0]), x[1], x[0]))
    by_stem: dict[str, list] = {}
    for x in picked:
        for n in STEM_LETTERS:
            if len(x[0]) > n or len(x[0]) == n and x[1]:
                by_stem.setdefault(x[0][:n], []).append(x)
    kept, begins = [], {}
    for x in picked:
        stem, whole, toxic, odds = x
        if not whole and any(y[2] >= 0.8 * toxic and y[3] > odds for y in by_stem.get(stem, ())):
            continue
        above = [begins[stem[:n]] for n in STEM_LETTERS if stem[:n] in begins and (len(stem) > n or whole)]
        if any(toxic < 0.8 * y[2] for y in above):
            continue
        kept.append(x)
        if not whole:
            begins[stem] = x
    return kept


def _fit_cells(grammar: Grammar, rows: DataFrame, rounds: int = 400, rate: float = 0.1, hold: float = 0.02) -> Grammar:
    """Logistic regression of the label on the cells, held near the prior."""
    made = append_columns(rows.select("key", "label", "text"), {"text": F.col("text")}, "x array<double>",
                          lambda: _input_lists(grammar), ["text"])
    got = sorted((str(r["key"]), r["label"], r["x"]) for r in made.collect())  # bounded by the sample
    y = np.array([1.0 if r[1] == 1 else 0.0 for r in got])
    if not len(y) or y.min() == y.max():
        return grammar
    x, prior = np.array([r[2] for r in got]), _prior()
    w, b = prior.copy(), -4.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w + b, -35, 35)))
        error = (p - y) / len(y)
        w = np.maximum(w - rate * (x.T @ error * 20 + hold * (w - prior)), 0)
        b -= rate * error.sum() * 20
    grammar.cells, grammar.bias = w, float(b)
    return grammar


def inputs(text: str | None, classes: _Classes) -> np.ndarray:
    """What the cells' weights apply to: the sums, and the sums per hundred
    words, both dampened."""
    c = cells(text, classes)
    if c is None:
        return np.zeros(2 * CELLS)
    return np.log1p(np.concatenate([c, 100 * c / max(len(text.split()), 1)]))


def _input_lists(grammar: Grammar):
    classes = _Classes(grammar)

    def run(text):
        return [[inputs(t, classes).tolist() for t in text]]
    return run


def score(docs: DataFrame, grammar: Grammar, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of toxicity."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)

    def make():
        g = shared.value
        classes = _Classes(g)

        def run(text):
            margin = np.array([g.bias + float(inputs(t, classes) @ g.cells) for t in text])
            return [(1 / (1 + np.exp(-np.clip(margin, -35, 35)))).tolist()]
        return run
    return append_columns(docs, {"text": column(text).cast("string")}, f"{out} double", make)


def judge(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score, held_out and predicted (1: toxic)."""
    scored = score(docs, learn(docs, labels, key, text), text)
    return scored.withColumn("held_out", F.coalesce(fold(column(key), FOLDS) == HELD_OUT, F.lit(False))).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
