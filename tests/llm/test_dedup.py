"""Near duplicates and components against brute force."""

import random
from collections import defaultdict

import numpy as np

from pmflow.llm import minhash
from pmflow.llm.components import components


def sets(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else frozenset()


def brute(rows):
    """{row place: (n, component, kept)}"""
    s = [sets(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            n = len(s[i] & s[j])
            if n and 100 * n >= 75 * len(s[i] | s[j]):
                up[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (k, _) in enumerate(rows):
        if k is not None:
            ids[root(i)].append(k)
    out = []
    for i, (k, _) in enumerate(rows):
        c = min(ids[root(i)], default=None) if s[i] else k
        out.append((str(k), len(s[i]), str(c), k == c))
    return sorted(out)


def check(spark, rows):
    df = spark.createDataFrame([(k, t, 7, "x") for k, t in rows],
                               "doc_id long, text string, node int, component_id string")
    got = sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in minhash.near_duplicates(df).collect())
    assert got == brute(rows)


def test_against_brute_force(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    rows, k = [], 100
    bases = [[rng.choice(words) for _ in range(rng.randint(1, 90))] for _ in range(25)]
    for base in bases:
        for _ in range(rng.randint(1, 9)):  # copies with a few words changed
            b = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                b[rng.randrange(len(b))] = rng.choice(words)
            rows.append((k := k - 1 if rng.random() < 0.3 and k > 90 else k + rng.randint(1, 3), " ".join(b)))
    # a chain: neighbours are linked, the ends are not
    chain = [f"c{i}" for i in range(60)]
    rows += [(1000 + i, " ".join(chain[i * 3:i * 3 + 40])) for i in range(6)]
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "one"), (2004, "ONE "), (None, "two words"),
             (None, "two words"), (None, None), (2005, "two  words"), (2006, "É é"), (2007, "é é")]
    rows += [rows[0], rows[0]]  # repeated rows
    check(spark, rows)


def test_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(df).count() == 0
    check(spark, [(1, None), (2, "")])


def test_estimate_is_corrected(spark):
    """The mean of many estimates is near the true similarity."""
    from pyspark.sql import functions as F
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(60):
        pool = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
        a, b = pool[:800], pool[200:]  # 600 of 1000
        rows.append(tuple(minhash.pack(minhash.signature(x)).tolist() for x in (a, b)))
    df = spark.createDataFrame(rows, "a array<long>, b array<long>")
    got = df.agg(F.avg(minhash.estimate(F.col("a"), F.col("b")))).first()[0]
    assert abs(got - 0.6) < 0.02


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(500, 500 + i) for i in range(1, 80)] + [(9, 9)]
    edges += [(rng.randint(1000, 1100), rng.randint(1000, 1100)) for _ in range(70)]
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges * 2, "a long, b long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}
    assert components(df.where("a < -1")).count() == 0
