"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pmflow.llm import spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, times=5):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= times * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, counts[w], len(near[w]), form[w], form[w] and counts[form[w]], root))
    return sorted(out, key=str)


def grouped(spark, counts):
    df = spark.createDataFrame(list(counts.items()) or [], "word string, n long")
    got = spelling.group_variants(df)
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def vocabulary(seed, letters, n, length):
    rng, words = random.Random(seed), set()
    while len(words) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(*length)))
        words.add(w)
        for _ in range(3):
            i = rng.randrange(len(w))
            words.add(rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:],
                                  w[:i] + rng.choice(letters) + w[i + 1:], w[:i] + w[i + 1:i + 2] + w[i:i + 1] + w[i + 2:]]))
    return {w: int(rng.paretovariate(.5)) + 5 for w in words if w}


@pytest.mark.parametrize("letters", [1 << 16, 40])
def test_against_brute_force(spark, monkeypatch, letters):
    """Also with blocks that are split into many chunks."""
    monkeypatch.setattr(spelling, "LETTERS", letters)
    monkeypatch.setattr(spelling, "SLAB", 7)
    counts = vocabulary(3, "abéÀ", 250, (2, 8))
    assert grouped(spark, counts) == brute(counts)


def test_chain_ties_and_nothing(spark):
    counts = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "zaaaaa": 25, "solitary": 9, "a" * 5000: 5,
              "a" * 4999: 100}
    assert grouped(spark, counts) == brute(counts)
    assert grouped(spark, {}) == []


def test_gram_distances_keep_every_edit():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.choice([5, 6]))) for _ in range(300)})
    less = np.where([len(w) == 6 for w in words], 0, -1)  # all longer words lack a letter of one class
    got = {(words[a], words[b]) for i, j in spelling.near_pairs(words, less, np.zeros(len(words)), False)
           for a, b in zip(i, j)}
    want = {(a, b) for x, a in enumerate(words) for b in words[x + 1:]
            if one_edit(a, b) and not (len(a) == len(b) == 6)}
    assert got == want


def counted(rows, every):
    out = Counter()
    for k, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if k is None else k}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


@pytest.mark.parametrize("every", [0, 2, 7])
def test_counts(spark, monkeypatch, every):
    monkeypatch.setattr(spelling, "HELD", 10)
    rng = random.Random(every)
    words = ["Éclair", "éclair", "LETTERS", "letters", "short", "x" * 400, "straße", "naïveté", "mañanas", "a1bcdefg"]
    rows = [(i if i % 9 else None, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for i in range(80)]
    rows += [(3, None), (4, ""), (5, "1234 !!"), (6, "letters " * 50_000)]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, word string, n int")
    got = {r["word"]: r["n"] for r in spelling.count_words(df, misspell_every=every).collect()}
    assert got == counted(rows, every)
    assert spelling.count_words(df.limit(0)).collect() == []
