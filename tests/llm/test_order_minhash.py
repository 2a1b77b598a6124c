"""Order MinHash against a plain version, and what it tells of edits."""

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from pmflow.llm import order_minhash as om

TOKEN = re.compile(om.TOKEN, re.ASCII)


def chained(*values):
    """The 64-bit hash of several numbers (value, bytes), each seeded by the one before."""
    seed = 42
    for v, size in values:
        seed = xxhash.xxh64((v % (1 << 64)).to_bytes(8, "little")[:size], seed=seed).intdigest()
    return seed


def brute(text, k=om.K, sketches=om.SKETCHES, chosen=om.CHOSEN):
    ids = [xxhash.xxh64(t.encode(), seed=42).intdigest() for t in TOKEN.findall(text or "")]
    if not ids:
        return ""
    seen, circle = Counter(), []
    for i in range(max(len(ids) - k + 1, 1)):
        kmer = chained(*[(x, 8) for x in ids[i:i + k]]) >> 32
        circle.append((chained((kmer, 8), (seen[kmer], 4)) >> 32 if seen[kmer] else kmer, i))
        seen[kmer] += 1
    circle.sort()
    out = []
    for j in range(sketches):
        point = j * ((1 << 32) // sketches)
        first = next((i for i, (h, _) in enumerate(circle) if h >= point), 0)
        picked = [circle[(first + d) % len(circle)] for d in range(min(chosen, len(circle)))]
        picked.sort(key=lambda x: x[1])
        out.append(f"{chained(*[(h, 8) for h, _ in picked]) & 0xFFFF:04x}")
    return "".join(out)


def like(a, b):
    if not a or not b:
        return float(a == b)
    return sum(a[i:i + 4] == b[i:i + 4] for i in range(0, len(a), 4)) / (len(a) // 4)


def prose(rng, n, words=500):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def texts():
    rng = random.Random(1)
    out = ["", None, " \n", "one", "two words", "a b c", "a b c d", "x " * 300, "漢字かな交じり文 and ไทย mixed",
           "émoji 😀 ñ\tÜ"]
    return out + [prose(rng, n, m) for n in (5, 40, 200, 2000) for m in (3, 50, 5000)] + [prose(rng, 60_000)]


@pytest.mark.parametrize("parameters", [{}, {"k": 1, "sketches": 16, "chosen": 3}])
def test_fingerprints_against_a_plain_version(spark, parameters):
    df = spark.createDataFrame(list(enumerate(texts())), "Fingerprint int, text string")
    df = df.withColumnRenamed("Fingerprint", "i").withColumn("hash", F.lit("x"))
    got = om.with_fingerprint(df, **parameters)
    assert got.columns == ["i", "text", "hash", "fingerprint"]
    for r in got.collect():
        assert r["fingerprint"] == brute(r["text"], **parameters), r["i"]


def test_order_and_repeats_show(spark):
    rng = random.Random(2)
    a, b = prose(rng, 400, 10**6), prose(rng, 400, 10**6)
    rows = [(a + " " + b, b + " " + a), (a, a), (a, b), (a + " " + a, a), (a, a + " new"), ("", ""), ("", a)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [r[0] for r in df.select(om.likeness(om.fingerprint(F.col("a")), om.fingerprint(F.col("b")))).collect()]
    assert got == [like(brute(x), brute(y)) for x, y in rows]
    assert got[1] == got[5] == 1 and got[6] == 0
    assert got[2] < 0.1 and got[4] > 0.9
    assert 0.2 < got[0] < 0.8  # the same k-mers in another order
    assert got[3] < 0.6  # occurrences are numbered


def expected(rows):
    """Every row's result; rows of one key stand by hash of text."""
    def order(r):
        k, t = r
        h = xxhash.xxh64((t or "").encode(), seed=42).intdigest()
        return (k is None, -(k or 0), h - (1 << 64) if h >> 63 else h)
    rows = sorted(rows, key=order)
    out = []
    for i, (k, t) in enumerate(rows):
        t, after = t or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(t) // 2
        new = t[:len(t) - half] + after[:half]
        own, other, nxt = brute(t), brute(new), brute(after)
        out.append((k, len(t), hashlib.sha256(new.encode()).hexdigest(), own, other, like(own, other), like(own, nxt)))
    return sorted(out, key=str)


def test_query(spark, tmp_path):
    from pmflow.llm.queries import op13_order_minhash
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randint(0, 80), 40)) for i in rng.sample(range(1000), 40)]
    rows += [(7, "twice"), (7, "twice"), (7, "twice"), (7, "other text"), (None, "no key"), (None, None), (8, ""),
             (9, None), (9, ""), (2000, "word " * 30_000), (5, "日本語の文章です")]
    for name, some in (("all", rows), ("one", rows[:1]), ("same", [(1, "a b c d e")] * 3), ("none", [])):
        path = f"{tmp_path}/{name}"
        spark.createDataFrame([(*r, "x", "y") for r in some], "doc_id long, text string, lang string, key string"
                              ).write.parquet(f"{path}/documents.parquet")
        got = sorted((tuple(r)[:7] for r in op13_order_minhash(spark, path).collect()), key=str)
        assert got == expected(some), name


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    plan = om.edited(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
