"""The Merkle manifest against a plain recursive one."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from pmflow.llm import merkle


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def grow(leaves):
    """Levels of the tree over some digests."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h(*now[i:i + 2]) for i in range(0, len(now), 2)])
    return levels


def way(levels, i):
    """(siblings, folding function) from the i-th leaf up."""
    out = []
    for now in levels[:-1]:
        out.append((now[i ^ 1] if i ^ 1 < len(now) else None, i & 1))
        i //= 2
    return out


def fold(leaf, steps):
    for sibling, left in steps:
        leaf = h(leaf) if sibling is None else h(sibling, leaf) if left else h(leaf, sibling)
    return leaf


def brute(rows):
    """rows: (key, part, text, changed text) -> sorted result rows."""
    parts = sorted({p for _, p, _, _ in rows}, key=lambda p: (p is not None, (p or "").encode()))
    own = {p: sorted(((k, h(t), c and h(c)) for k, q, t, c in rows if q == p),
                     key=lambda r: (r[0] is not None, r[0] or 0, r[1])) for p in parts}
    trees = {p: grow([r[1] for r in own[p]]) for p in parts}
    top = grow([trees[p][-1][0] for p in parts])
    out = []
    for t, p in enumerate(parts):
        for i, (k, leaf, changed) in enumerate(own[p]):
            steps = way(trees[p], i) + way(top, t)
            root = fold(changed or leaf, steps)
            out.append((k, p, leaf, trees[p][-1][0], top[-1][0], "".join(s for s, _ in steps if s), root,
                        root == top[-1][0]))
    return sorted(out, key=str)


def run(spark, rows, stride):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "key long, part string, text string, new string, at long, leaf string")
    got = merkle.verify(df, "key", "part", F.col("text"), F.col("new"), stride)
    assert got.columns == ["key", "part", "leaf", "subroot", "root", "proof", "folded", "verified"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("stride", [1, 3, 6])
def test_against_a_plain_tree(spark, stride, monkeypatch):
    monkeypatch.setattr(merkle, "SPREAD", 8)  # several copies of upper nodes
    rng = random.Random(stride)
    rows = [(i, "big", f"t{i}", None if rng.random() < .7 else f"u{i}") for i in rng.sample(range(500), 70)]
    rows += [(i, "é", f"t{i}", None) for i in range(5)] + [(1, "A", "one", None), (None, None, "", "x")]
    assert run(spark, rows, stride) == brute(rows)


def test_few_parts_ties_and_nothing(spark):
    assert run(spark, [], 2) == []
    assert run(spark, [(5, "a", "only", "other")], 2) == brute([(5, "a", "only", "other")])
    rows = [(3, "a", "same", None)] * 5 + [(3, "a", "other", "same"), (None, "a", "same", None)]  # one part, equal keys
    assert run(spark, rows, 2) == brute(rows)


def test_query(spark, tmp_path):
    from pmflow.llm.queries import op11_merkle_manifest
    rows = [(i, None if i % 11 == 0 else "téxt " * (i % 5), None if i % 6 == 0 else f"l{i % 3}",
             "src" if i % 4 else None, None if i % 5 == 0 else i) for i in range(60)]
    rows.append((60, "word " * 200_000, "l1", "s", 1))  # a very long text
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")

    def text(r, n):
        return "".join(map(field, (r[0], r[3], r[2], n, r[1])))
    want = brute([(r[0], r[2], text(r, r[4]), text(r, r[4] + 1) if r[4] is not None
                   and zlib.crc32(str(r[0]).encode()) % 7 == 0 else None) for r in rows])
    want = sorted((k, leaf, sub, root, hashlib.sha256(p.encode()).hexdigest(), folded, ok)
                  for k, _, leaf, sub, root, p, folded, ok in want)
    got = sorted(tuple(r) for r in op11_merkle_manifest(spark, str(tmp_path)).collect())
    assert got == want
    assert {g[-1] for g in got} == {True, False}


def test_a_leaf_that_is_forged_anywhere_is_found(spark):
    """Another sibling order or a moved leaf doesn't verify."""
    rows = [(i, "a", f"t{i}", f"t{(i + 1) % 9}") for i in range(9)]
    assert not any(r[-1] for r in run(spark, rows, 2))
