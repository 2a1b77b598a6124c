"""FM-index and decontamination against brute force."""

import random
import re

import numpy as np

from pmflow.llm import decontaminate as D
from pmflow.llm.fm_index import FMIndex

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def test_index_against_scan():
    rng = random.Random(3)
    for _ in range(60):
        size = rng.choice([1, 2, 5, 40])
        runs = [[rng.randint(1, size) for _ in range(rng.randint(1, 30))] for _ in range(rng.randint(1, 8))]
        text = np.array([x for r in runs for x in r + [0]], np.int64)
        patterns = [[rng.randint(1, size + 1) for _ in range(rng.randint(1, 4))] for _ in range(10)]
        width = max(map(len, patterns))
        matrix = np.array([[0] * (width - len(p)) + p for p in patterns])
        index = FMIndex(text)
        rows, lo, hi = index.search(matrix, np.array([len(p) for p in patterns]))
        at, which = index.locate(lo, hi)
        got = {(int(rows[w]), int(a)) for a, w in zip(at, which)}
        assert got == {(i, k) for i, p in enumerate(patterns) for k in range(len(text) - len(p) + 1)
                       if text[k:k + len(p)].tolist() == p}


def words(text):
    return WORD.findall((text or "").encode().lower())


def brute(text, items, window=10):
    w = words(text)
    hit, found = [False] * len(w), set()
    for i, t in items:
        b = words(t)
        n = min(len(b), window)
        for k in range(len(b) - n + 1 if n else 0):
            for j in range(len(w) - n + 1):
                if w[j:j + n] == b[k:k + n]:
                    hit[j:j + n] = [True] * n
                    found.add("" if i is None else str(i))
    return len(w), sum(hit), sorted(found)


def test_against_brute_force(spark):
    rng = random.Random(8)
    letters = [f"v{i}" for i in range(30)] + ["Ñandú", "über"]
    items = [(i, " ".join(rng.choice(letters) for _ in range(rng.choice([3, 9, 10, 25, 40])))) for i in range(30)]
    items += [(30, None), (31, " .. "), (None, "alone here now"), (5, "second text of item five"), items[0]]
    docs = []
    for k in range(40):
        parts = [" ".join(rng.choice(letters + ["zz", "qq"]) for _ in range(rng.randint(0, 60)))]
        for _ in range(rng.randint(0, 3)):
            t = rng.choice(items)[1] or ""
            w = t.split()
            a = rng.randint(0, max(len(w) - 1, 0))
            parts += [" ".join(w[a:]).upper().replace("Ñ", "ñ").replace("Ú", "ú").replace("Ü", "ü"), "-- !"]
        docs.append((k, " ".join(parts)))
    docs += [(100, None), (101, ""), (102, "Alone, HERE; now!"), (None, items[3][1]), (0, docs[0][1])]
    df = spark.createDataFrame([(*d, "n", 3) for d in docs], "doc_id long, text string, N_HIT string, block int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = sorted((str(k), *brute(t, items)) for k, t in docs)
    # one block and shard; small shards; several blocks, each a pass over the documents
    for more in ({}, {"shard_bytes": 100}, {"block_windows": 40}):
        got = D.find_contamination(df, bench, **more)
        assert got.columns == ["doc_id", "block", "text", "n_words", "n_hit", "spans", "items"]
        rows = got.collect()
        assert sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["items"]) for r in rows) == expected
        assert all(sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"] for r in rows)
        assert sorted(str(r["text"]) for r in rows) == sorted(str(t) for _, t in docs)


def test_cut(spark):
    bench = spark.createDataFrame([(1, "one two three"), (2, "four")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Say One, two; THREE! or four. End"), (2, "four"), (3, "plain"), (4, None)],
                                 "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in D.find_contamination(docs, bench, clean=True).collect()}
    assert got == {1: "Say or End", 2: "", 3: "plain", 4: None}


def test_empty_tables(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in D.find_contamination(docs, bench).collect()] == [(2, 0, [])]
    assert D.find_contamination(docs.where("doc_id < 0"), bench).count() == 0
