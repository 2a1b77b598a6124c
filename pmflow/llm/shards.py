"""Token-id shards in training order (operator 6).

Each input partition's documents are encoded, each closed by an end token, and
packed into sequences of ``length`` tokens; a partition's last sequence is
filled up with end tokens. A sequence's index is its partition's base plus its
number in it; the bases come from an upper bound of the partition's tokens (a
token has one byte at least), so the texts are encoded only once. A keyed Feistel
permutation over the index domain, with cycle-walking where the domain is no
power of four, gives every sequence its place. Places are cut into ranges, one
per shard; a shard's task sorts its sequences by place and writes them as
records of fixed stride (2 or 4 bytes a token, little-endian) into one binary
file. Places that no sequence has are squeezed out: a sequence's global slot is
its shard's first slot, as the manifest has it, plus its position. So slot g is
found by one look at the manifest and one seek, and a reader resumes anywhere.

A task that runs again makes the same bytes: they are written beside and then
moved into place. The partitions of the input must be the same in both passes,
as those of a table's scan are; a task that finds others fails.

Null and empty texts are one end token. Repeated rows are encoded each. An empty
table gives no shard. Columns other than key and text are not looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pmflow.llm.common import bounded_batches, column, materialise
from pmflow.llm.tokenizer import tools

LENGTH = 1024
#: Sequences of a shard, on average.
SHARD_SEQUENCES = 4096
KEY = 0x5EED
ROUNDS = 4


class Permutation:
    """A keyed permutation of 0 .. n - 1: a balanced Feistel network over the
    next power of four, applied again until it lands below n."""

    def __init__(self, n: int, key: int = KEY):
        self.n, self.half = n, max(1, -(-max(n - 1, 1).bit_length() // 2))
        self.mask = np.uint64((1 << self.half) - 1)
        draw = hashlib.sha256(f"{key}:{n}".encode()).digest()
        self.keys = np.frombuffer(draw, "<u8")[:ROUNDS] | np.uint64(1)

    def _mix(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x + key) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ x >> np.uint64(32)) * (key | np.uint64(1))
        return (x ^ x >> np.uint64(29)) & self.mask

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        half = np.uint64(self.half)
        left, right = x >> half, x & self.mask
        if back:
            for k in self.keys[::-1]:
                left, right = right ^ self._mix(left, k), left
        else:
            for k in self.keys:
                left, right = right, left ^ self._mix(right, k)
        return left << half | right

    def _walk(self, x, back: bool) -> np.ndarray:
        x = self._once(np.asarray(x, np.uint64), back)
        while (out := x >= np.uint64(self.n)).any():
            x[out] = self._once(x[out], back)
        return x.astype(np.int64)

    def place(self, index) -> np.ndarray:
        return self._walk(index, False)

    def index(self, place) -> np.ndarray:
        return self._walk(place, True)


def _write(path: str, name: str, data: bytes) -> None:
    system, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        fs.LocalFileSystem(), path)
    system.create_dir(root, recursive=True)
    context = TaskContext.get()
    beside = f"{root}/_{name}-{context.taskAttemptId() if context else 0}"
    with system.open_output_stream(beside) as f:
        f.write(data)
    system.move(beside, f"{root}/{name}")


def read_record(path: str, name: str, position: int, length: int, width: int) -> np.ndarray:
    """One sequence of a shard."""
    system, root = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (
        fs.LocalFileSystem(), path)
    with system.open_input_file(f"{root}/{name}") as f:
        return np.frombuffer(f.read_at(length * width, position * length * width), f"<u{width}")


SEQUENCES = ("shard int, position bigint, file string, n_tokens int, record_sha256 string, "
             "documents array<struct<doc_id:bigint,start:bigint,at:int,n:int>>")


def write_shards(docs: DataFrame, path: str, vocabulary: str, pattern: str, end: int, key: str = "doc_id",
                 text: str = "text", length: int = LENGTH, shard_sequences: int = SHARD_SEQUENCES,
                 seed: int = KEY) -> DataFrame:
    """Write the shards of ``docs`` under ``path``. One row per sequence: its
    global slot, shard, position and file; n_tokens without the filling; the
    record's digest; and documents: for each stretch of a document its
    ``doc_id``, where it starts in the document's ids, where in the sequence,
    and how many ids it has (the end token among them)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    given = docs.select(column(key).cast("long").alias("key"), F.coalesce(column(text).cast("string"),
                                                                          F.lit("")).alias("text"))
    sizes = sorted(given.groupBy(F.spark_partition_id().alias("p")).agg(
        F.sum(F.octet_length("text")).alias("bytes"), F.count(F.lit(1)).alias("rows")).collect())
    base, total = {}, 0  # a few numbers per partition
    for p, size, rows in sizes:
        base[p] = (total, size, rows)
        total += (size + rows) // length + 1
    if not total:
        return spark.createDataFrame([], "slot bigint, " + SEQUENCES)
    shards = max(1, total // (shard_sequences * 2))  # about half of the places are taken
    permutation = Permutation(total, seed)
    width = 2 if end < 1 << 16 else 4
    kind, end_token = f"<u{width}", np.uint32(end).tobytes()

    def pack(batches):
        split, ids = tools(vocabulary, pattern)
        partition = TaskContext.get().partitionId()
        first, size, rows = base.get(partition, (0, 0, 0))
        held = np.zeros(0, kind)  # ids that don't fill a sequence yet
        spans: list[dict] = []
        made = 0

        def flush(count, used):
            nonlocal held, spans, made
            place = permutation.place(np.arange(first + made, first + made + count))
            shard = place.astype(object) * shards // total
            records = [held[i * length:(i + 1) * length].tobytes() for i in range(count)]
            listed: list[list] = [[] for _ in range(count + 1)]
            for s in spans:  # cut at the borders of sequences
                at, n, start = s["at"], s["n"], s["start"]
                while n:
                    here = min(n, length - at % length)
                    listed[min(at // length, count)].append(
                        {"doc_id": s["doc_id"], "start": start, "at": at % length, "n": here})
                    at, n, start = at + here, n - here, start + here
            held, made = held[count * length:], made + count
            spans = listed[count]
            return pa.RecordBatch.from_arrays(
                [pa.array([int(x) for x in shard], pa.int32()), pa.array(place, pa.int64()),
                 pa.array(records, pa.binary()), pa.array(used, pa.int32()), pa.array(listed[:count], span_type)],
                ["shard", "place", "record", "n_tokens", "documents"])

        for b in batches:
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            size -= pc.sum(pc.binary_length(b.column(1))).as_py() or 0
            rows -= len(keys)
            coded, at = [], len(held)
            for k, own in zip(keys, map(b"".join, ids.of(map(split.split, texts)))):
                coded += [own, end_token]
                n = len(own) // 4 + 1
                spans.append({"doc_id": k, "start": 0, "at": at, "n": n})
                at += n
            held = np.concatenate([held, np.frombuffer(b"".join(coded), "<u4").astype(kind)])
            if (count := len(held) // length):
                yield flush(count, [length] * count)
        if size or rows:
            raise RuntimeError(f"partition {partition} differs between the passes")
        if len(held):
            used = len(held)
            held = np.concatenate([held, np.full(length - used, end, kind)])
            yield flush(1, [used])

    span_type = pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("at", pa.int32()),
                                    ("n", pa.int32())]))
    spans_ddl = "array<struct<doc_id:bigint,start:bigint,at:int,n:int>>"
    packed = given.mapInArrow(pack, f"shard int, place bigint, record binary, n_tokens int, documents {spans_ddl}")

    def write(group: pa.Table) -> pa.Table:
        group = group.sort_by("place")
        shard = group.column("shard")[0].as_py()
        name = f"shard-{shard:06d}.bin"
        records = group.column("record").to_pylist()
        _write(path, name, b"".join(records))
        n = len(records)
        return pa.table({
            "shard": group.column("shard"), "position": pa.array(range(n), pa.int64()),
            "file": pa.array([name] * n, pa.string()), "n_tokens": group.column("n_tokens"),
            "record_sha256": pa.array([hashlib.sha256(r).hexdigest() for r in records], pa.string()),
            "documents": group.column("documents")})

    # a shard's range of places holds a bounded number of sequences
    written = materialise(packed.groupBy("shard").applyInArrow(write, SEQUENCES), "sequences")
    manifest = written.groupBy("shard", "file").agg(F.count(F.lit(1)).alias("sequences"))
    first, rows = 0, []
    for r in manifest.orderBy("shard").collect():  # a row per shard: the manifest
        rows.append((r["shard"], r["file"], first, r["sequences"]))
        first += r["sequences"]
    manifest = spark.createDataFrame(rows, "shard int, file string, first_slot bigint, sequences bigint")
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/_manifest")
    return written.join(manifest.select("shard", "first_slot"), "shard").select(
        (F.col("first_slot") + F.col("position")).alias("slot"), *written.columns)
