"""Token shards: the permutation, and the exact way back from files to ids."""

import hashlib

import numpy as np
import public_tokenizers as P

from pmflow.llm.shards import Permutation, read_record, write_shards
from pmflow.llm.tokenizer import tools

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


def test_permutation():
    for n in (1, 2, 3, 4, 5, 16, 17, 1000, 4096, 4097):
        p = Permutation(n)
        places = p.place(np.arange(n))
        assert sorted(places.tolist()) == list(range(n))
        assert (p.index(places) == np.arange(n)).all()
    a, b = Permutation(5000, 1).place(np.arange(5000)), Permutation(5000, 2).place(np.arange(5000))
    assert (a != b).mean() > 0.9 and (a == Permutation(5000, 1).place(np.arange(5000))).all()
    assert abs(np.corrcoef(a, np.arange(5000))[0, 1]) < 0.1


def test_round_trip(spark, tmp_path):
    texts = ["", None, "a b", "the quick brown fox " * 300, "dup", "dup", "x" * 700] + [f"text {i} " * i for i in range(60)]
    rows = [(i if i % 9 else None, t, "c") for i, t in enumerate(texts)] + [(4, "dup", "c")]
    src = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string, slot string").repartition(3).write.parquet(src)
    docs = spark.read.parquet(src)
    path = str(tmp_path / "out")
    got = write_shards(docs, path, RANKS, P.PATTERN, 50256, length=32, shard_sequences=20).collect()
    assert sorted(r["slot"] for r in got) == list(range(len(got)))
    split, ids = tools(RANKS, P.PATTERN)
    stretches, firsts = {}, {}
    for r in got:
        record = read_record(path, r["file"], r["position"], 32, 2)
        assert hashlib.sha256(record.tobytes()).hexdigest() == r["record_sha256"]
        assert sum(d["n"] for d in r["documents"]) == r["n_tokens"]
        assert (record[r["n_tokens"]:] == 50256).all()
        for d in r["documents"]:
            stretches.setdefault(d["doc_id"], []).append((d["start"], record[d["at"]:d["at"] + d["n"]].tolist()))
        firsts.setdefault(r["shard"], []).append(r["slot"] - r["position"])
    assert all(len(set(x)) == 1 for x in firsts.values())
    tokens = {}
    for k, t, _ in rows:
        own = np.frombuffer(b"".join(map(ids.__getitem__, split.split(t or ""))), "<u4").tolist() + [50256]
        tokens.setdefault(k, []).append(own)
    for k, lists in tokens.items():  # a repeated or null id: all its ids are there, stretch by stretch
        assert sum(len(x) for _, x in stretches[k]) == sum(map(len, lists))
        if len(lists) == 1:
            assert sum((x for _, x in sorted(stretches[k])), []) == lists[0]
    again = write_shards(docs, str(tmp_path / "again"), RANKS, P.PATTERN, 50256, length=32, shard_sequences=20).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_nothing(spark, tmp_path):
    src = str(tmp_path / "docs")
    spark.createDataFrame([], "doc_id long, text string").write.parquet(src)
    assert write_shards(spark.read.parquet(src), str(tmp_path / "out"), RANKS, P.PATTERN, 50256).count() == 0
