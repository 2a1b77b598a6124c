"""MinHash near-duplicates (operator 1), with b-bit signatures.

A document's set is its distinct shingles of five words (A-Z lower-cased, words
between ASCII white space); with fewer words the whole sequence is the one
shingle, with none the set is empty. Two documents are linked if their sets'
intersection is at least 75 % of the union; a component is a set of documents
linked over any number of steps.

1. One pass over the texts makes each document's set, its 64-bit fingerprint,
   the minima under 128 hash functions, 32 band keys of four minima each, and
   the signature: the low ``BITS`` bits of the minima, packed bit plane by bit
   plane. Documents of equal sets are one class from here on, whatever their
   number; only a class's bands go on.
2. Candidates come from band buckets, without all pairs of a bucket. First each
   bucket's members are compared with one pivot, and the confirmed links joined
   to components. In a bucket that then still holds several, the members
   outside its largest component are compared with all members that are not in
   their own: chunk against chunk, each pair in the first bucket it shares,
   inside the task, which passes on no more than links.
3. A candidate's similarity is estimated by bit counts of the signatures,
   corrected for the chance that low bits collide; what is clearly below the
   threshold goes. The rest is confirmed on the full sets.
4. Components of the confirmed links by star steps.

At a similarity of 0.75 a pair misses all bands with a chance of 6e-6, and the
estimate's slack is over four standard deviations. Fingerprints and shingle
hashes have 64 bits.

Null, empty or blank texts have no set: zero shingles, a component of their
own. Rows with a null doc_id take part like others; a component's id is the
least doc_id in it, null if there is none. Repeated rows each give a row. Other
columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pmflow.llm.common import append_columns, column, materialise
from pmflow.llm.components import components

SHINGLE = 5
#: Linked from this share of the union on, in percent.
PERCENT = 75
BANDS, ROWS = 32, 4
#: Bits kept of each minimum.
BITS = 4
#: What an estimate may lie below the threshold: over four standard deviations.
SLACK = 0.2
#: Members of a bucket, outside its largest component and in all, that are
#: compared at a time; buckets of fewer members than SMALL share a task's group.
CHUNK_X, CHUNK_Y, SMALL = 256, 1024, 128
#: Words whose hashes a worker keeps.
CACHE_WORDS = 500_000

HASHES = BANDS * ROWS
_RNG = np.random.default_rng(20240501)
_MULTIPLY = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint64).astype(np.uint32)
_PLACES = _RNG.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_BAND_MULTIPLY = _RNG.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)


class _Words(dict):
    """Word -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ h >> np.uint64(29)) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ h >> np.uint64(32)


def shingle_set(text: str | None, words: _Words) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes. ASCII bytes only are lower-cased
    and split at; the words' places in a shingle count."""
    split = (text or "").encode().lower().split()
    if not split:
        return np.zeros(0, np.uint64)
    h = np.fromiter([words[w] for w in split], np.uint64, len(split))
    n = min(SHINGLE, len(h))
    parts = sum(h[i:len(h) - n + 1 + i] * _PLACES[i] for i in range(n))
    return np.unique(_mix(parts + np.uint64(n)))  # a short text's shingle is no five-word one


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minima under all hash functions."""
    h = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(h), 256):
        block = h[i:i + 256] * _MULTIPLY[:, None] + _ADD[:, None]
        np.minimum(least, block.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least.reshape(BANDS, ROWS).astype(np.uint64)
    return _mix((rows * _BAND_MULTIPLY).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
                ).view(np.int64)


def pack(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima: for each bit a plane of HASHES bits, as longs."""
    planes = [np.packbits(least >> np.uint32(b) & 1 == 1, bitorder="little") for b in range(BITS)]
    return np.concatenate(planes).view("<i8")


def estimate(a: Column, b: Column) -> Column:
    """Similarity of two signatures: the share of equal minima as the bit
    planes show it, less the 2**-BITS of unequal ones whose bits collide."""
    longs = HASHES // 64
    differ = F.lit(0)
    for w in range(longs):
        bits = None
        for plane in range(BITS):
            x = a[plane * longs + w].bitwiseXOR(b[plane * longs + w])
            bits = x if bits is None else bits.bitwiseOR(x)
        differ = differ + F.bit_count(bits)
    chance = 2.0 ** -BITS
    return ((F.lit(1.0) - differ / F.lit(float(HASHES))) - chance) / (1 - chance)


def _sets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n_shingles, node, bands, sig) of every row; node is null for an
    empty set."""
    def make():
        words = _Words()

        def run(text):
            n, node, bands, sigs = [], [], [], []
            for t in text:
                s = shingle_set(t, words)
                n.append(len(s))
                if len(s):
                    least = signature(s)
                    node.append(fingerprint(s))
                    bands.append(band_keys(least))
                    sigs.append(pack(least))
                else:
                    node.append(None)
                    bands.append(None)
                    sigs.append(None)
            return [n, node, bands, sigs]
        return run
    given = docs.select(column(key).alias("_key"), column(text).cast("string").alias("_text"))
    return append_columns(given, {"text": F.col("_text")},
                          "n_shingles bigint, node bigint, bands array<bigint>, sig array<bigint>", make, ["_text"])


def fingerprint(shingles: np.ndarray) -> int:
    """64 bits of the whole set, as a signed long."""
    h = xxhash.xxh3_64_intdigest(shingles.tobytes())
    return h - (1 << 64) if h >> 63 else h


def _confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are linked. ``a`` may be in many pairs:
    its text is not copied by the shuffle, only met in the join."""
    b = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    both = b.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")

    def make():
        words = _Words()
        held: tuple = (None, None)  # pairs come sorted by a: its set is made once

        def run(a, text_a, text_b):
            nonlocal held
            out = []
            for k, x, y in zip(a, text_a, text_b):
                if held[0] != k:
                    held = k, shingle_set(x, words)
                out.append(_linked(held[1], shingle_set(y, words)))
            return [out]
        return run
    return append_columns(both, {c: F.col(c) for c in ("a", "text_a", "text_b")}, "linked boolean", make,
                          ["text_a", "text_b"]).where("linked").select("a", "b")


def _texts(docs: DataFrame, key: str, text: str, nodes: DataFrame) -> DataFrame:
    """(node, text) of one document for each of ``nodes`` (node, key)."""
    def make():
        words = _Words()

        def run(text):
            return [[fingerprint(s) if len(s := shingle_set(t, words)) else None for t in text]]
        return run
    given = docs.select(column(key).alias("_key"), column(text).cast("string").alias("text"))
    wanted = nodes.select(F.col("key").alias("_wanted"), F.col("node").alias("_node"))
    met = given.join(wanted, F.col("_key").eqNullSafe(F.col("_wanted"))).select("text", "_node")
    # a repeated or null key may bring other texts along
    made = append_columns(met, {"text": F.col("text")}, "node bigint", make)
    return made.where("node = _node").groupBy("node").agg(F.any_value("text").alias("text"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``key``, n_shingles, component_id, kept."""
    rows = materialise(_sets(docs, key, text), "sets")
    classes = materialise(rows.where("node is not null").groupBy("node").agg(
        F.min("_key").alias("key"), F.any_value("sig").alias("sig"), F.any_value("bands").alias("bands")), "classes")
    members = classes.select("node", F.posexplode("bands").alias("band", "bucket"))
    shared = members.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high")
    # buckets of several classes only
    members = materialise(members.join(shared.select("bucket"), "bucket").distinct(), "members")
    found = materialise(components(_links(docs, key, text, classes, members)), "components")
    named = classes.select("node", "key").join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = materialise(named.groupBy("component").agg(F.min("key").alias("component_id")), "least")
    named = materialise(named.join(least, "component").select("node", "component_id"), "named")
    out = rows.select("_key", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("_key")).otherwise(F.col("component_id"))
    return out.select(F.col("_key").alias(key), "n_shingles", component.alias("component_id"),
                      F.col("_key").eqNullSafe(component).alias("kept"))


def _links(docs: DataFrame, key: str, text: str, classes: DataFrame, members: DataFrame) -> DataFrame:
    """Links (a, b) whose components are those of all confirmed links."""
    close = (PERCENT / 100) - SLACK
    sig = classes.select("node", "sig")

    def near(pairs):
        a, b = (sig.select(F.col("node").alias(c), F.col("sig").alias(f"sig_{c}")) for c in "ab")
        return pairs.join(a, "a").join(b, "b").where(
            estimate(F.col("sig_a"), F.col("sig_b")) >= close).select("a", "b")

    nodes = members.select("node").distinct().join(classes.select("node", "key"), "node")
    texts = materialise(_texts(docs, key, text, nodes), "texts")  # of every class that may be in a pair
    # a bucket's pivot is the least by a hash, so that buckets of the same documents have the same one
    pivot = materialise(members.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("node").alias("h"), "node")).alias("p"))
                        .select("bucket", F.col("p.node").alias("pivot")), "pivots")
    pairs = near(members.join(pivot, "bucket").where("node != pivot").select(
        F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct())
    first = materialise(_confirm(materialise(pairs, "candidates"), texts), "links")
    found = materialise(components(first), "found")
    # known links, as stars
    links = found.select(F.col("node").alias("a"), F.col("component").alias("b")).where("a != b")
    state = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    state = materialise(state, "state")
    # buckets that still hold several components: their largest one, and one of
    # each kind where several hold the same classes
    parts = state.groupBy("bucket", "component").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("print"))
    parts = parts.groupBy("bucket").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.sum("print").alias("print"),
                                        F.max(F.struct("n", "component")).alias("main"))
    open_ = materialise(parts.where("most < n").groupBy("n", "print").agg(F.min(F.struct(
        "bucket", "most", F.col("main.component").alias("main"))).alias("b")).select("n", "b.*"), "open")
    small = open_.where(F.col("n") <= SMALL).agg(F.sum("n")).first()[0] or 0
    cells = -(-small // CHUNK_Y) or 1
    chunks = open_.select("bucket", "main", "n", F.ceil((F.col("n") - F.col("most")) / CHUNK_X).alias("xs"),
                          F.ceil(F.col("n") / CHUNK_Y).alias("ys"))
    rows = state.join(chunks, "bucket")
    # by band: the open buckets of each class, so that a pair is compared in its first
    own = materialise(rows.groupBy("node").agg(F.map_from_entries(F.collect_list(F.struct("band", "bucket"))).alias("m"))
                      .select("node", F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.coalesce(
                          F.try_element_at("m", i), F.lit(0))).alias("own")), "own")
    payload = own.join(sig, "node").join(texts, "node")
    rows = rows.select("bucket", "band", "node", "component", "main", "n", "xs", "ys")
    x, y = F.pmod(F.xxhash64("node"), "xs"), F.pmod(F.xxhash64("node"), "ys")

    def dealt(side, here, there, at):
        """Rows with the group that compares them: a chunk meets each of the other side's."""
        side = side.withColumns({"here": here, "there": F.explode(F.sequence(F.lit(0), F.col(there) - 1))})
        cx, cy = ("here", "there") if at == "x" else ("there", "here")
        cell = F.when(F.col("n") > SMALL, F.xxhash64("bucket", cx, cy)).otherwise(
            F.pmod(F.xxhash64("bucket"), F.lit(cells)))
        return side.select(cell.alias("cell"), "bucket", "band", "node", "component").join(payload, "node")

    left, right = dealt(rows.where("component != main"), x, "ys", "x"), dealt(rows, y, "xs", "y")
    right = right.toDF(*[f"{c}_y" for c in right.columns])  # else both sides' columns are the same ones
    more = left.groupBy("cell").cogroup(right.groupBy("cell_y")).applyInArrow(_compare, "a bigint, b bigint")
    return links.union(materialise(more, "links"))


def _compare(left: pa.Table, right: pa.Table) -> pa.Table:
    """Links between the left rows' classes and the right rows', bucket by
    bucket; of two components no more than one in a group."""
    a, b, up = [], [], {}

    def root(c):
        while up.get(c, c) != c:
            c = up[c]
        return c
    sets: dict[int, np.ndarray] = {}
    words = _Words()  # of this group: a worker keeps nothing between tasks

    def of(side, k):
        node = side["node"][k]
        if node not in sets:
            sets[node] = shingle_set(side["text"][k].as_py(), words)
        return sets[node]

    def arrays(t: pa.Table) -> dict:
        t = t.combine_chunks()
        lists = {c: np.asarray(t.column(c).combine_chunks().flatten()).reshape(len(t), -1) for c in ("own", "sig")}
        return {c: t.column(c).to_numpy() for c in ("bucket", "band", "node", "component")} | lists | {
            "text": t.column("text")}
    if not len(left) or not len(right):
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    x, y = arrays(left), arrays(right.rename_columns([c.removesuffix("_y") for c in right.column_names]))
    order_x, order_y = np.argsort(x["bucket"], kind="stable"), np.argsort(y["bucket"], kind="stable")
    bx, by = x["bucket"][order_x], y["bucket"][order_y]
    longs, chance = HASHES // 64, 2.0 ** -BITS
    for bucket in np.unique(bx):
        i = order_x[np.searchsorted(bx, bucket):np.searchsorted(bx, bucket, "right")]
        j = order_y[np.searchsorted(by, bucket):np.searchsorted(by, bucket, "right")]
        for k in range(0, len(i), CHUNK_X):
            i_ = i[k:k + CHUNK_X]
            differ = np.zeros((len(i_), len(j)), np.int64)
            for w in range(longs):
                bits = np.zeros((len(i_), len(j)), np.int64)
                for plane in range(BITS):
                    bits |= x["sig"][i_, None, plane * longs + w] ^ y["sig"][None, j, plane * longs + w]
                differ += np.bitwise_count(bits.view(np.uint64))
            close = ((1 - differ / HASHES) - chance) / (1 - chance) >= PERCENT / 100 - SLACK
            close &= x["component"][i_, None] != y["component"][None, j]
            p, q = np.nonzero(close)
            same = (x["own"][i_[p]] == y["own"][j[q]]) & (x["own"][i_[p]] != 0)
            mine = same.argmax(axis=1) == x["band"][i_[p]]
            for r, t in zip(i_[p[mine]].tolist(), j[q[mine]].tolist()):
                cr, ct = root(x["component"][r]), root(y["component"][t])
                if cr != ct and _linked(of(x, r), of(y, t)):
                    up[cr] = ct
                    a.append(int(x["node"][r]))
                    b.append(int(y["node"][t]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _linked(s: np.ndarray, t: np.ndarray) -> bool:
    """Whether two full sets are linked."""
    if 100 * min(len(s), len(t)) < PERCENT * max(len(s), len(t)):
        return False
    at = np.searchsorted(s, t)
    common = int((s[np.minimum(at, len(s) - 1)] == t).sum())
    return 100 * common >= PERCENT * (len(s) + len(t) - common)
