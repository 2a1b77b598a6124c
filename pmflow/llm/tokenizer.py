"""Byte-level BPE encoding and decoding (operator 2).

A text of up to ``chunk_chars`` characters is one chunk. A longer one is cut
into chunks of ``chunk_chars`` that run ``overlap`` characters into the next;
the chunks are spread over the cluster and pre-tokenised on their own. Where a
chunk and the next agree on a pre-token's start inside the overlap, both go on
alike, for a match depends on nothing before its start: there the chunks are
stitched, and each encodes the pieces between its two stitches. A text whose
chunks don't agree somewhere (one pre-token longer than the overlap) is
encoded in one go from that place on. Decoding joins the tokens' raw bytes.

Null text counts as empty: no ids, zero tokens, empty bytes. Repeated rows
each give a row. Other columns pass through; one whose name equals an output's
is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pmflow.llm.bpe import PieceIds, Pretokens, Vocabulary, token_bytes
from pmflow.llm.common import KEPT, append_columns, column, others

#: Characters of a chunk, and by how many it runs into the next.
CHUNK_CHARS = 32_768
OVERLAP = 1_024
#: Characters that a match looks ahead at most.
AHEAD = 3
#: Characters whose pieces a worker holds at a time (or one text's).
GROUP_CHARS = 1 << 19

#: Operator whose vocabulary and pieces a Python worker keeps.
KEEP = "tokenizer"
_TOOLS: dict[tuple[str, str], tuple[Pretokens, PieceIds]] = KEPT.setdefault(KEEP, {})


def tools(path: str, pattern: str) -> tuple[Pretokens, PieceIds]:
    """The splitter and the piece cache of this Python worker: those of one
    vocabulary, the last that was asked for."""
    if (path, pattern) not in _TOOLS:
        _TOOLS.clear()
        load = Vocabulary.from_merges if path.endswith(".json") else Vocabulary.from_ranks
        _TOOLS[path, pattern] = Pretokens(pattern), PieceIds(load(path))
    return _TOOLS[path, pattern]


def _encode_all(texts: list[str], path: str, pattern: str) -> list[bytes]:
    split, ids = tools(path, pattern)
    out: list[bytes] = []
    for group in _groups(texts):
        out += map(b"".join, ids.of([split.split(t) for t in group]))
    return out


def _groups(texts: list[str]) -> Iterator[list[str]]:
    """The texts in turn, in groups of about ``GROUP_CHARS``: a batch's pieces
    take many times the room of its texts."""
    group, held = [], 0
    for t in texts:
        group.append(t or "")
        held += len(group[-1])
        if held >= GROUP_CHARS:
            yield group
            group, held = [], 0
    yield group


def _encoder(path: str, pattern: str):
    return lambda: lambda text: [_encode_all(text, path, pattern)]


def encode(df: DataFrame, vocabulary: str, pattern: str, text: str = "text", ids: str = "ids",
           chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP, keep_text: bool = False) -> DataFrame:
    """``df`` with ``ids`` (binary: the token ids as little-endian unsigned
    32-bit integers). ``vocabulary`` is a .tiktoken or .json file that every
    executor can open, ``pattern`` the pre-token pattern."""
    t, length = F.coalesce(column(text), F.lit("")), F.char_length(F.coalesce(column(text), F.lit("")))
    drop = [] if keep_text else [text]
    short = append_columns(df.where(length <= chunk_chars), {"text": t}, f"{ids} binary",
                           _encoder(vocabulary, pattern), drop, KEEP)
    long = df.where(length > chunk_chars)
    # the rows' other columns travel with their first chunk
    keep = [c for c in others(df, [ids]) if keep_text or c != text]
    at = F.col("_chunk")
    chunks = long.select(
        F.monotonically_increasing_id().alias("_row"), t.alias("_whole"), length.alias("_length"),
        F.struct(F.lit(True).alias("_there"), *[column(c) for c in keep]).alias("_rest"))
    chunks = chunks.withColumn("_chunk", F.explode(
        F.sequence(F.lit(0), F.ceil(F.col("_length") / chunk_chars).cast("int") - 1)))
    chunks = chunks.select(
        "_row", "_chunk", "_length", F.when(at == 0, F.col("_rest")).alias("_rest"),
        F.substring("_whole", at * chunk_chars + 1, F.lit(chunk_chars + overlap)).alias("_part"))
    chunks = chunks.repartition("_row", "_chunk")
    chunks = append_columns(
        chunks, {"part": F.col("_part"), "chunk": at, "length": F.col("_length")},
        "_head array<bigint>, _tail array<bigint>", lambda: _borders(pattern, chunk_chars, overlap), keep_worker=KEEP)
    # stitch: the first start on which a chunk and its successor agree
    w = Window.partitionBy("_row").orderBy("_chunk")
    cut = F.array_min(F.array_intersect("_tail", F.lead("_head").over(w)))
    last = (at + 1) * chunk_chars >= F.col("_length")
    chunks = chunks.withColumn("_end", F.when(last, F.col("_length").cast("long")).otherwise(cut))
    chunks = chunks.withColumn("_start", F.when(at == 0, F.lit(0).cast("long")).otherwise(F.lag("_end").over(w)))
    chunks = chunks.withColumn("_known", F.min(F.col("_start").isNotNull()).over(
        w.rowsBetween(Window.unboundedPreceding, 0)) & F.col("_end").isNotNull())
    # chunks without a stitch pass their own stretch of text on, for the whole
    start = F.coalesce(F.when(F.min(F.col("_start").isNotNull()).over(
        w.rowsBetween(Window.unboundedPreceding, 0)), F.col("_start")), at * chunk_chars)
    end = F.when(F.col("_known"), F.col("_end")).otherwise(F.least((at + 1) * chunk_chars, F.col("_length")))
    # the slice lies inside the chunk: a stitch is at most `overlap` beyond its end
    chunks = chunks.withColumn("_piece", F.substring(
        "_part", (start - at * chunk_chars + 1).cast("int"), F.greatest(end - start, F.lit(0)).cast("int")))
    chunks = append_columns(
        chunks.select("_row", "_chunk", "_known", "_rest", "_piece"),
        {"text": F.when(F.col("_known"), F.col("_piece"))}, "_ids binary", _encoder(vocabulary, pattern),
        keep_worker=KEEP)
    docs = chunks.groupBy("_row").agg(
        F.first("_rest", ignorenulls=True).alias("_rest"),
        F.array_sort(F.collect_list(F.struct(
            "_chunk", "_ids", F.when(~F.col("_known"), F.col("_piece")).alias("_raw")))).alias("_parts"))
    docs = append_columns(
        docs.select("_rest", "_parts"), {"parts": F.col("_parts")}, "_ids binary",
        lambda: lambda parts: [_assemble(parts, vocabulary, pattern)], ["_parts"], KEEP)
    fields = [F.col("_rest").getField(c).alias(c) for c in keep]
    return short.select(*[column(c) for c in keep], column(ids)).unionByName(
        docs.select(*fields, F.col("_ids").alias(ids)))


def _borders(pattern: str, chunk_chars: int, overlap: int):
    """For each chunk: the pre-token starts, as offsets in the whole text, in
    its first ``overlap`` characters and in the stretch it shares with the
    next one. Near its cut end a chunk can't see far enough; those don't count."""
    split = Pretokens(pattern)

    def run(part, chunk, length):
        heads, tails = [], []
        for p, c, n in zip(part, chunk, length):
            at = split.starts(p)
            seen = at if c * chunk_chars + len(p) >= n else at[at + AHEAD <= len(p)][:-1]
            heads.append((at[at < overlap] + c * chunk_chars).tolist())
            tails.append((seen[seen >= chunk_chars] + c * chunk_chars).tolist())
        return [heads, tails]
    return run


def _assemble(parts, vocabulary: str, pattern: str) -> list[bytes]:
    out = []
    for chunks in parts:
        done, raw = [], []
        for c in chunks:
            if c["_raw"] is None:
                done.append(c["_ids"])
            else:  # from the first chunk without a stitch on, all are raw
                raw.append(c["_raw"])
        out.append(b"".join(done) + _encode_all(["".join(raw)], vocabulary, pattern)[0])
    return out


def decode(df: DataFrame, vocabulary: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out`` (binary: the tokens' raw bytes, joined)."""
    def make():
        raw = token_bytes(vocabulary)  # without the pairs and pieces that encoding takes

        def run(packed):
            return [pa.array([b"".join([raw[i] for i in np.frombuffer(p or b"", "<u4").tolist()])
                              for p in packed], pa.binary())]
        return run
    return append_columns(df, {"packed": column(ids)}, f"{out} binary", make, keep_worker=KEEP)


def n_tokens(ids: str = "ids") -> Column:
    return (F.octet_length(column(ids)) / 4).cast("long")


def sha256(binary: str) -> Column:
    return F.sha2(column(binary), 256)
