"""Benchmark decontamination (operator 4): an FM-index per shard of documents,
searched backward for every window of the benchmark.

A benchmark item's windows are its runs of ``window`` consecutive words; an
item with fewer words, but not none, is one window. Documents are gathered into
shards of bounded size inside a task; a shard's words become ids of the
benchmark's vocabulary, and the runs of such words that are long enough to
hold a window are indexed (a window can't lie anywhere else). All windows are
searched backward through wavelet ranks, the occurrences located by sampled
suffix positions, and their spans merged into what is to be removed.

The benchmark is worked off in blocks of at most ``block_windows`` distinct
windows, each broadcast with a pass over the documents; a benchmark of any size
takes more passes, not more memory. No document is shuffled.

Null or empty texts have no words: nothing is hit. Items without words have no
windows. A null item id is reported as the empty string. Repeated rows each
give a row; repeated items count once per id. Other columns pass through; one
whose name equals an output's is replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pmflow.llm.common import bounded_batches, column, lean_worker, materialise, others
from pmflow.llm.fm_index import FMIndex

WINDOW = 10
#: Distinct windows searched in one pass over the documents.
BLOCK_WINDOWS = 200_000
#: Bytes of text that are indexed at a time (one document at least).
SHARD_BYTES = 16 << 20

#: Bytes that belong to words, A-Z lower-cased; all others become spaces.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORDS).split()


def windows_of(bench: DataFrame, item: str = "item_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Rows (window binary: words joined by a space, items array<string>)."""
    def run(batches):
        for b in batches:
            ids, made = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = words(t)
                for k in range(max(len(w) - window + 1, min(len(w), 1))):
                    ids.append(i or "")
                    made.append(b" ".join(w[k:k + window]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(made, pa.binary())],
                                             ["item", "window"])

    bounded_batches(bench.sparkSession)
    given = bench.select(column(item).cast("string"), column(text).cast("string"))
    return given.mapInArrow(run, "item string, window binary").groupBy("window").agg(
        F.collect_set("item").alias("items"))


class _Block:
    """The windows of a block as word ids, and the items of each."""

    def __init__(self, rows):
        self.vocabulary: dict[bytes, int] = {}
        self.items = [sorted(i) for _, i in rows]
        ids = [[self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in bytes(x).split(b" ")]
               for x, _ in rows]
        self.lengths = np.array([len(x) for x in ids], np.int64)
        self.patterns = np.zeros((len(ids), int(self.lengths.max(initial=1))), np.int64)
        for row, x in zip(self.patterns, ids):
            row[len(row) - len(x):] = x
        self.shortest = int(self.lengths.min()) if rows else 1

    def ids(self, text: str | None) -> np.ndarray:
        """The text's words as ids; 0: not in the benchmark."""
        w, get = words(text), self.vocabulary.get
        return np.fromiter([get(x, 0) for x in w], np.int32, len(w))


def _search(block: _Block, texts: list[np.ndarray]):
    """Hit mask over all words of the shard, and (document, item) pairs."""
    bounds = np.cumsum([0] + [len(w) for w in texts])
    ids = np.concatenate([np.zeros(0, np.int32), *texts])
    total = len(ids)
    # runs of known words inside a document
    fresh = np.zeros(total + 1, bool)
    fresh[bounds] = True
    known = ids > 0
    start = known & (fresh[:-1] | ~np.concatenate([[False], known[:-1]]))
    end = known & (fresh[1:] | ~np.concatenate([known[1:], [False]]))
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    long = end - start >= block.shortest
    start, end = start[long], end[long]
    if not len(start):
        return np.zeros(total, bool), bounds, []
    # each run followed by a separator; `shift` leads from the packed place to the word's
    size = end - start
    at = np.cumsum(size + 1) - size - 1
    packed = np.zeros(int((size + 1).sum()), np.int64)
    inner = np.ones(len(packed), bool)
    inner[at + size] = False
    shift = np.repeat(start - at, size + 1)
    packed[inner] = ids[(np.arange(len(packed)) + shift)[inner]]
    index = FMIndex(packed)
    rows, lo, hi = index.search(block.patterns, block.lengths)
    place, which = index.locate(lo, hi)
    row, place = rows[which], place + shift[place]
    hit = np.zeros(total + 1, np.int32)
    np.add.at(hit, place, 1)
    np.subtract.at(hit, place + block.lengths[row], 1)
    doc = np.searchsorted(bounds, place, "right") - 1
    pairs = np.unique(np.stack([doc, row], 1), axis=0) if len(doc) else np.zeros((0, 2), np.int64)
    return np.cumsum(hit[:-1], out=hit[:-1]) > 0, bounds, pairs.tolist()


def _spans(mask: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return [{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)]


def cut(text: str, spans: list) -> str:
    """The text without the words of the spans, what stands between them, and
    the punctuation directly behind; a space stays where words were cut."""
    raw = text.encode()
    at = [m.span() for m in _WORD.finditer(raw.translate(_WORDS))]
    out, last = [], 0
    for s in spans:
        out.append(raw[last:at[s["start"]][0]].rstrip(b" "))
        last = at[s["end"] - 1][1]
        tail = re.compile(rb"[^\s0-9a-zA-Z\x80-\xff]*").match(raw, last)
        last = tail.end()
    out.append(raw[last:])
    return b"".join(out).decode().strip()


def find_contamination(docs: DataFrame, bench: DataFrame, text: str = "text", item: str = "item_id",
                       bench_text: str = "text", window: int = WINDOW, block_windows: int = BLOCK_WINDOWS,
                       shard_bytes: int = SHARD_BYTES, clean: bool = False) -> DataFrame:
    """``docs`` with n_words, n_hit, spans (array of start and end word, the
    merged removal spans) and items (array of item ids, sorted). With
    ``clean``, ``text`` has the spans cut out."""
    spark = docs.sparkSession
    table = materialise(windows_of(bench, item, bench_text, window), "windows")
    blocks = max(1, -(-table.count() // block_windows))
    table = table.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks)))
    found = docs
    for k in range(blocks):
        rows = [(bytes(r[0]), r[1]) for r in table.where(F.col("block") == k).select("window", "items").collect()]
        found = _one_block(found, spark.sparkContext.broadcast(_Block(rows)), text, shard_bytes, k > 0,
                           clean and k == blocks - 1)
        if k < blocks - 1:
            found = materialise(found, "block")
    return found


SCHEMA = "n_words bigint, n_hit bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>"


def _one_block(df: DataFrame, shared, text: str, shard_bytes: int, again: bool, clean: bool) -> DataFrame:
    from pyspark.sql import types as T

    bounded_batches(df.sparkSession)
    out = T.StructType.fromDDL(SCHEMA)
    keep = others(df, [f.name for f in out.fields] + [text])
    given = df.select(*[column(c) for c in keep], column(text).cast("string").alias(text),
                      *([column(f.name) for f in out.fields] if again else []))
    n, names = len(keep), [*keep, text, *[f.name for f in out.fields]]
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(out)

    def shard(batches):
        block = shared.value
        # a batch's texts are Python strings only while they are turned into ids
        mask, bounds, pairs = _search(block, [block.ids(t) for b in batches for t in b.column(n).to_pylist()])
        items: list[set] = [set() for _ in bounds[1:]]
        for d, row in pairs:
            items[d].update(block.items[row])
        at = 0
        for b in batches:
            cols: list[list] = [[], [], [], []]
            cuts = {}
            for k in range(b.num_rows):
                m = mask[bounds[at]:bounds[at + 1]]
                if again:
                    items[at].update(b.column(n + 4)[k].as_py())
                    m = m.copy()
                    for s in b.column(n + 3)[k].as_py():
                        m[s["start"]:s["end"]] = True
                spans = _spans(m)
                for col, v in zip(cols, (len(m), int(m.sum()), spans, sorted(items[at]))):
                    col.append(v)
                if clean and spans:
                    cuts[k] = cut(b.column(n)[k].as_py(), spans)
                at += 1
            text_column = pa.array([cuts.get(k, t) for k, t in enumerate(b.column(n).to_pylist())],
                                   pa.string()) if cuts else b.column(n)
            yield pa.RecordBatch.from_arrays(
                [b.column(i) for i in range(n)] + [text_column]
                + [pa.array(c, f.type) for c, f in zip(cols, arrow)], names=names)

    def run(batches):
        lean_worker()
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.column(n).nbytes
            if size >= shard_bytes:
                yield from shard(held)
                held, size = [], 0
        if held:
            yield from shard(held)
        del held
        lean_worker()

    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in given.schema.fields[:n + 1]] + out.fields)
    return given.mapInArrow(run, schema)
