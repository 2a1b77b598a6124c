"""Byte-level BPE and token counts against the libraries they must equal."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pmflow.llm import bpe, token_counts, tokenizer
from pmflow.llm.bpe import PieceIds, Pretokens, Vocabulary, token_bytes

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")
TEXTS = [
    "", "  ", "Hello world", "it's we'll 'tis ''s", "a\n\n b\t\tc  ", "Ünïcödé ßtraße 漢字 ½ Ⅷ ² x", "\x1c\x1d a", "🙂🙂 ok",
    "x" * 300, " " * 500 + "y", "<|endoftext|> in <|endoftext|>text", "word " * 400, "ab1_c" * 90 + "\n" * 70,
]
LONG = ["lorem ipsum, dolor's " * 300, "z" * 5000, ("a" * 400 + " b ") * 9, " \n" * 1500 + "end", "tail's" * 700]


@pytest.fixture(scope="module")
def rank_library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_equal_the_libraries(rank_library):
    split = Pretokens(P.PATTERN)
    ranks, merges = PieceIds(Vocabulary.from_ranks(RANKS)), PieceIds(Vocabulary.from_merges(JSON))
    library = Tokenizer.from_file(JSON)
    library.encode_special_tokens = True
    rng = random.Random(5)
    letters = "abcthe '\n\t _.1²½\x1ćéñ漢字s's't\U0001F600"
    texts = TEXTS + LONG + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    for ids in (ranks, merges):
        ids.learn({p for t in texts for p in split.split(t)})
    for t in texts:
        got = [np.frombuffer(b"".join(map(ids.__getitem__, split.split(t))), "<u4").tolist() for ids in (ranks, merges)]
        assert got[0] == rank_library.encode_ordinary(t), repr(t)
        assert got[1] == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_encode_stitches_chunks(spark, rank_library):
    texts = TEXTS + LONG + [None, "Hello world"]
    rows = [(i if i % 7 else None, t, f"x{i}", i) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS string, place int")
    coded = tokenizer.decode(tokenizer.encode(df, RANKS, P.PATTERN, chunk_chars=200, overlap=40), RANKS, P.PATTERN)
    assert sorted(c.lower() for c in coded.columns) == ["decoded", "doc_id", "ids", "place"]
    got = {r["place"]: r for r in coded.withColumn("n", tokenizer.n_tokens()).withColumn(
        "sha", tokenizer.sha256("ids")).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = rank_library.encode_ordinary(t or "")
        assert np.frombuffer(bytes(got[i]["ids"]), "<u4").tolist() == ids, (i, t)
        assert bytes(got[i]["decoded"]) == (t or "").encode()
        assert got[i]["n"] == len(ids) and got[i]["doc_id"] == rows[i][0]
        assert got[i]["sha"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()


def test_encode_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert tokenizer.decode(tokenizer.encode(df, RANKS, P.PATTERN), RANKS, P.PATTERN).count() == 0


def test_counts_equal_the_library(spark):
    library = Tokenizer.from_file(JSON)
    texts = TEXTS + LONG + [None, "Hello world", "Hello world"]
    rows = [(i // 2 if i else None, t, 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    for head in (0, 20):
        got = token_counts.count_tokens(df, JSON, P.PATTERN, head_size=head)
        assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
        expected = sorted((str(k), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids))
                          for k, t, _ in rows)
        assert sorted((str(r[0]), r[1], r[2]) for r in got.collect()) == expected
    assert token_counts.count_tokens(df.where(F.lit(False)), JSON, P.PATTERN).count() == 0


def test_pieces_of_many_texts_are_looked_up_once():
    """op6: known pieces take one look-up; only texts with a new one are gone through again."""
    split, vocab = Pretokens(P.PATTERN), Vocabulary.from_ranks(RANKS)
    ids, alone = PieceIds(vocab), PieceIds(vocab)
    texts = [split.split(t) for t in TEXTS + LONG]
    want = [[alone[p] for p in t] for t in texts]
    assert ids.of(texts) == want and set(ids) == {p for t in texts for p in t}
    ids.learn = ids._add = lambda todo: [None for _ in todo if 1 / 0]  # nothing is left to compute
    assert ids.of(texts) == want and ids.of([]) == [] and ids.of([[]]) == [[]]


def test_only_unknown_pieces_are_gone_back_to():
    """op6: 413 CPU seconds a GB; a text with one new piece was looked up twice as a whole."""
    vocab, looked_up = Vocabulary.from_ranks(RANKS), []

    class Counted(PieceIds):
        def __getitem__(self, piece):
            looked_up.append(piece)
            return super().__getitem__(piece)

    ids, alone = Counted(vocab), PieceIds(vocab)
    ids.learn({" known", " words"})
    texts = [[" known", " words"] * 500 + [f" new{i}"] + [" known"] * 500 for i in range(40)]
    assert ids.of(iter(texts)) == [[alone[p] for p in t] for t in texts]
    assert sorted(looked_up) == sorted(f" new{i}" for i in range(40))


def test_many_unknown_pieces_and_a_full_cache(monkeypatch):
    """op6: pieces are computed some at a time; a cache that starts anew between them loses none."""
    monkeypatch.setattr(bpe, "MISSED", 50)
    monkeypatch.setattr(bpe, "CACHE_BYTES", 4000)
    vocab, rng = Vocabulary.from_ranks(RANKS), random.Random(3)
    ids, alone = PieceIds(vocab), PieceIds(vocab)
    texts = [[f" w{rng.randrange(300)}" for _ in range(rng.randrange(40))] for _ in range(200)]
    assert ids.of(texts) == [[alone[p] for p in t] for t in texts]


def test_pieces_merged_side_by_side_equal_those_merged_alone(monkeypatch):
    """op6: places of a merge's pieces lie side by side; lengths around the bounds, bytes of all kinds."""
    rng = random.Random(11)
    pieces = [bytes(rng.choice(b"aethins \xc3\xa9\x00\xff'") for _ in range(n)) for n in (*range(70), 200) for _ in range(3)]
    for vocab in (Vocabulary.from_ranks(RANKS), Vocabulary.from_merges(JSON)):
        want = [np.array(bpe._merge_long(p, vocab), "<u4").tobytes() for p in pieces]
        for rows in (1, 7, 4096):
            monkeypatch.setattr(bpe, "ROWS", rows)
            assert bpe.merge_pieces(pieces, vocab) == want
            assert bpe.merge_pieces([b""], vocab) == [b""] and bpe.merge_pieces([], vocab) == []
        packed = bpe._merge_rows(sorted(pieces, key=len)[:-3], vocab, np.int64)  # ranks beyond 32 bits with a place
        assert packed == [w for _, w in sorted(zip(pieces, want), key=lambda x: len(x[0]))[:-3]]


def test_a_worker_drops_what_another_operator_kept(spark):
    """pipeline: vocabulary and pieces don't stay beside the next stage's own."""
    from pmflow.llm.common import append_columns
    df = spark.range(200, numPartitions=8).selectExpr("id", "'some text ' || id AS text")
    assert tokenizer.encode(df, RANKS, P.PATTERN).selectExpr("sum(length(ids)) AS n").first()["n"] > 0
    held = append_columns(df, {"text": F.col("text")}, "held int", lambda: lambda text: [[len(tokenizer._TOOLS)] * len(text)])
    assert held.selectExpr("max(held) AS m").first()["m"] == 0


def test_a_worker_holds_a_vocabulary_as_flat_arrays():
    """pipeline: tokenise took more than an executor's memory; each of its workers held all pairs as Python objects."""
    import gc
    import tracemalloc
    tracemalloc.start()
    vocab = Vocabulary.from_ranks(RANKS)
    gc.collect()
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 12 << 20 and len(vocab.made) > 50_000


def test_a_batch_is_encoded_by_bounded_groups(rank_library, monkeypatch):
    """pipeline: the pieces of a whole batch took many times the room of its texts."""
    rng, at_a_time = random.Random(7), []
    look_up = PieceIds.of

    def of(self, texts):
        at_a_time.append(sum(len(p) for t in texts for p in t))
        return look_up(self, texts)
    monkeypatch.setattr(PieceIds, "of", of)
    texts = [None if i % 50 == 0 else " ".join(f"{rng.getrandbits(40):x}" for _ in range(600)) for i in range(200)]
    got = tokenizer._encode_all(texts, RANKS, P.PATTERN)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [rank_library.encode_ordinary(t or "") for t in texts]
    assert sum(at_a_time) == sum(len(t or "") for t in texts) and max(at_a_time) < 600_000
    assert tokenizer._encode_all([], RANKS, P.PATTERN) == []


def test_raw_bytes_of_both_kinds_of_vocabulary():
    """Decoding needs the tokens' bytes alone."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    raw = token_bytes(RANKS)
    assert all(raw[i] == t for t, i in ranks.items()) and len(raw) == max(ranks.values()) + 1
    library = Tokenizer.from_file(JSON)
    text = "Hello wörld, 漢字 🙂\n\n x"
    assert b"".join(map(token_bytes(JSON).__getitem__, library.encode(text, add_special_tokens=False).ids)) == text.encode()
