"""Token counts (operator 5): pieces are counted once per distinct pre-token
and joined to the documents' pre-token frequencies; no ids are made.

1. One pass over the texts counts the pre-tokens of the corpus; each distinct
   one is split into its pieces once, and the counts go to a table.
2. A second pass makes each document's frequencies. The ``head_size`` most
   frequent pre-tokens (a bounded broadcast) are summed on the spot, so that
   no hot key is ever shuffled; the rest are joined to the table by pre-token
   and summed by document. Both ways give the same number; the split only
   saves shuffling.

Strings that the tokenizer takes out of a text before it splits it count one
each. Null or empty text: zero. Repeated rows each give a row.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pmflow.llm.common import append_columns, bounded_batches, column, materialise
from pmflow.llm.tokenizer import KEEP, tools

#: Most frequent pre-tokens whose counts are broadcast (about 20 bytes each).
HEAD_SIZE = 1 << 17
#: Begins the join key of a document's own row. No UTF-8 text holds this byte.
OWN = b"\xff"
#: Distinct pre-tokens that a task gathers before it passes them on.
GATHER = 200_000


def _frequencies(text: str, split, special: dict[str, int]) -> tuple[Counter, int]:
    """Pre-tokens of a text, and how many special strings were taken out."""
    parts, taken = [text], 0
    for s in special:
        cut = [x for p in parts for x in p.split(s)]
        taken += len(cut) - len(parts)
        parts = cut
    freq: Counter = Counter()
    for p in parts:
        freq.update(split.split(p))
    return freq, taken


def piece_counts(texts: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Table (pretoken binary, n bigint, pieces int) of the distinct
    pre-tokens of the one string column of ``texts``: how often each occurs
    and how many tokens it gives."""
    def gather(batches):
        split, ids = tools(vocabulary, pattern)
        seen: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([p.encode() for p in seen], pa.binary()), pa.array(list(seen.values()), pa.int64())],
                ["pretoken", "n"])

        for b in batches:
            for t in b.column(0).to_pylist():
                freq, _ = _frequencies(t or "", split, ids.vocab.special)
                seen.update(freq)
                if len(seen) >= GATHER:
                    yield out()
                    seen = Counter()
        yield out()

    def make():
        ids = tools(vocabulary, pattern)[1]

        def run(pretoken):
            pieces = [p.decode() for p in pretoken]
            ids.learn(set(pieces))
            return [[len(ids[p]) // 4 for p in pieces]]
        return run

    bounded_batches(texts.sparkSession)
    seen = texts.mapInArrow(gather, "pretoken binary, n bigint").groupBy("pretoken").agg(F.sum("n").alias("n"))
    return append_columns(seen, {"pretoken": F.col("pretoken")}, "pieces int", make, keep_worker=KEEP)


def count_tokens(df: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text",
                 head_size: int = HEAD_SIZE) -> DataFrame:
    """One row per row of ``df``: ``key``, n_bytes (UTF-8) and n_tokens."""
    table = materialise(piece_counts(df.select(column(text).cast("string")), vocabulary, pattern), "pieces")
    # the frequency from which on at most head_size pre-tokens are as frequent:
    # by steps of an eighth of a doubling, a few hundred rows
    steps = table.groupBy(F.floor(F.log2("n") * 8).alias("step")).count().orderBy(F.col("step").desc()).collect()
    least, size = None, 0
    for step, count in steps:
        if size + count > head_size:
            break
        least, size = step, size + count
    frequent = table.where(F.floor(F.log2("n") * 8) >= least) if least is not None else table.where("false")
    head = {bytes(r[0]).decode(): r[1] for r in frequent.select("pretoken", "pieces").toLocalIterator()}
    shared = df.sparkSession.sparkContext.broadcast(head)
    given = df.select(column(key).alias("_key"), column(text).cast("string").alias("_text"))
    kind = given.schema["_key"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    arrow_key = to_arrow_type(kind)

    def run(batches):
        split, ids = tools(vocabulary, pattern)
        quick, part, at = shared.value, TaskContext.get().partitionId(), 0
        for b in batches:
            rows, keys, joins, freqs, sizes = [], [], [], [], []
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                row = part << 33 | at
                at += 1
                freq, total = _frequencies(t or "", split, ids.vocab.special)
                rest = []
                for p, n in freq.items():
                    c = quick.get(p)
                    if c is None:
                        rest.append((p.encode(), n))
                    else:
                        total += c * n
                rows += [row] * (1 + len(rest))
                keys += [k] + [None] * len(rest)
                joins.append(OWN + row.to_bytes(8, "big"))
                joins += [p for p, _ in rest]
                freqs.append(total)
                freqs += [n for _, n in rest]
                sizes += [len((t or "").encode())] + [None] * len(rest)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(keys, arrow_key), pa.array(joins, pa.binary()),
                 pa.array(freqs, pa.int64()), pa.array(sizes, pa.int64())],
                ["row", "key", "pretoken", "freq", "n_bytes"])

    bounded_batches(df.sparkSession)
    from pyspark.sql.types import BinaryType, LongType, StructField, StructType
    rows = given.mapInArrow(run, StructType([
        StructField("row", LongType()), StructField("key", kind), StructField("pretoken", BinaryType()),
        StructField("freq", LongType()), StructField("n_bytes", LongType())]))
    # a document's own row meets no pre-token: it keeps its sum as it is
    joined = rows.join(table.select("pretoken", "pieces"), "pretoken", "left")
    return joined.groupBy("row").agg(
        F.max("key").alias("_key"), F.max("n_bytes").alias("n_bytes"),
        F.sum(F.col("freq") * F.coalesce("pieces", F.lit(1))).alias("n_tokens"),
    ).select(F.col("_key").alias(key), "n_bytes", "n_tokens")
