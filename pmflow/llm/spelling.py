"""Spelling variants: the words of a corpus, which of them are one edit apart,
and the frequent form that a rare one goes by.

Pairs are found by blocked Gram matrices. A word's letters fall into ``GROUPS``
classes; how many of each it has is its block. One inserted, deleted or replaced
letter changes these numbers by one up, one down, or both, so near words meet in
the block that both have when the odd letter is left out: each word goes to its
own block and to one block less a letter per class, and no pair meets twice.
Within a block, the product of the letter-count matrix with itself gives all
squared distances between counts; pairs at most two apart (in a block there are
words of two adjacent lengths) are checked letter by letter.

Scale. Words are counted within a document, then within a task (``HELD`` words),
then by Spark. A block of more than ``LETTERS`` letters is split into chunks and
every pair of chunks is multiplied in a task of its own, so no task holds more
than two chunks; products are made ``SLAB`` rows at a time. No pair is dropped.

Defined cases: null texts have no words; a null key is the empty text; a word of
any length is a word; rows count as often as they come; an empty table has no
words. Columns that aren't named are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pmflow.llm.common import bounded_batches, column, lean_worker, materialise

#: Maximal runs of these letters are words; only A-Z are lower-cased.
LETTERS_OF_WORDS = r"[A-Za-zÀ-ÿ]"
#: Classes of letters (by code point) whose numbers are a word's block.
GROUPS = 5
#: Letters of one chunk of a block.
LETTERS = 1 << 16
#: Rows of a Gram matrix made at a time.
SLAB = 256
#: Words that a task counts before it hands them over.
HELD = 100_000


def misspelt(key: str, run: str, every: int) -> str:
    """``run``, or in about one of ``every`` cases the run without one letter:
    planted misspellings, the same in every run."""
    h = zlib.crc32(f"{key}:{run}".encode())
    if every and h % every == 0:
        at = h % len(run)
        return run[:at] + run[at + 1:]
    return run


def count_words(docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = 6, min_count: int = 5,
                misspell_every: int = 0) -> DataFrame:
    """(word, n) of the words of at least ``min_length`` letters that occur at
    least ``min_count`` times."""
    bounded_batches(docs.sparkSession)
    pattern = f"{LETTERS_OF_WORDS}{{{max(min_length, 1)},}}"  # a shorter run makes no word, misspelt or not

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_worker()
        find, held = re.compile(pattern).findall, Counter()

        def hand_over() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                             names=["word", "n"])
            held.clear()
            return out

        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not t:
                    continue
                runs = Counter(find(t.encode().lower().decode()))  # bytes lower A-Z alone
                for r, n in runs.items():
                    word = misspelt(k or "", r, misspell_every)
                    if len(word) >= min_length:
                        held[word] += n
                if len(held) >= HELD:
                    yield hand_over()
        if held:
            yield hand_over()

    given = docs.select(column(key).cast("string").alias("k"), column(text).cast("string").alias("t"))
    counted = given.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) -> (block, less, word, n): the word's own block (less -1) and
    those less a letter of class ``less``."""
    for b in batches:
        blocks, less, at = [], [], []
        for i, w in enumerate(b.column("word").to_pylist()):
            own = [0] * GROUPS
            for c in w:
                own[ord(c) % GROUPS] += 1
            blocks.append(",".join(map(str, own)))
            less.append(-1)
            at.append(i)
            for j in range(GROUPS):
                if own[j]:
                    own[j] -= 1
                    blocks.append(",".join(map(str, own)))
                    less.append(j)
                    at.append(i)
                    own[j] += 1
        take = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(blocks, pa.string()), pa.array(less, pa.int32()), b.column("word").take(take),
             b.column("n").take(take)], names=["block", "less", "word", "n"])


def _codes(words: list[str], width: int) -> np.ndarray:
    """Code points, a row per word, 0 beyond its end."""
    return np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width)


def _one_edit(codes: np.ndarray, lengths: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs are one edit apart; their lengths are equal or differ by one."""
    near = np.zeros(len(i), bool)
    step = max(1, (1 << 20) // codes.shape[1])
    for at in range(0, len(i), step):
        a, b = i[at:at + step], j[at:at + step]
        a, b = np.where(lengths[a] <= lengths[b], a, b), np.where(lengths[a] <= lengths[b], b, a)
        short, long = codes[a], codes[b]
        same = short == long
        replaced = (~same).sum(1) == 1
        # a word's head and tail, moved on by one, make up the whole of it
        n = lengths[a]
        head = np.where(same.all(1), codes.shape[1], same.argmin(1))
        moved = (short[:, :-1] == long[:, 1:])[:, ::-1]
        tail = np.where(moved.all(1), codes.shape[1] - 1, moved.argmin(1)) - (codes.shape[1] - 1 - n)
        inserted = np.minimum(head, n) + np.maximum(tail, 0) >= n
        near[at:at + step] = np.where(n == lengths[b], replaced, inserted)
    return near


def near_pairs(words: list[str], less: np.ndarray, chunk: np.ndarray, apart: bool) -> Iterator[tuple]:
    """Places (i, j) of the words of a block that are one edit apart, a slab at a
    time; two words that lack a letter of one class meet in their own block.
    ``apart``: pairs within a chunk are left out."""
    lengths = np.array([len(w) for w in words])
    codes = _codes(words, int(lengths.max()) + 1)
    row, where = np.nonzero(codes)
    letters, letter = np.unique(codes[row, where], return_inverse=True)
    counts = np.bincount(row * len(letters) + letter, minlength=len(words) * len(letters)).astype(float)
    counts = counts.reshape(len(words), len(letters))
    square, place = (counts * counts).sum(1), np.arange(len(words))
    for at in range(0, len(words), SLAB):
        some = slice(at, at + SLAB)
        distance = square[some, None] + square - 2 * (counts[some] @ counts.T)
        keep = (distance <= 2) & (distance > 0) & (place[some, None] < place)
        keep &= (less[some, None] != less) | (less < 0)
        if apart:
            keep &= chunk[some, None] != chunk
        i, j = np.nonzero(keep)
        i += at
        near = _one_edit(codes, lengths, i, j)
        yield i[near], j[near]


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block and pair of chunks -> (word, near, near_n), both ways."""
    def met(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if rows.num_rows < 2:
            return
        word, n = rows.column("word").combine_chunks(), rows.column("n").combine_chunks()
        apart = rows.column("a")[0].as_py() != rows.column("b")[0].as_py()
        for i, j in near_pairs(word.to_pylist(), rows.column("less").to_numpy(), rows.column("chunk").to_numpy(),
                               apart):
            one, two = pa.array(np.concatenate([i, j])), pa.array(np.concatenate([j, i]))
            yield pa.RecordBatch.from_arrays([word.take(one), word.take(two), n.take(two)],
                                             names=["word", "near", "near_n"])

    lean_worker()
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        keys = list(zip(*(b.column(c).to_pylist() for c in ("block", "a", "b"))))
        starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
        for start, end in zip(starts, [*starts[1:], len(keys)]):
            if keys[start] != last and held:
                yield from met(pa.Table.from_batches(held))
                held = []
            last = keys[start]
            held.append(b.slice(start, end - start))
    if held:
        yield from met(pa.Table.from_batches(held))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n), each word once -> (word, near, near_n): all pairs one edit
    apart, both ways."""
    rows = words.mapInArrow(_blocks, "block string, less int, word string, n bigint")
    large = rows.groupBy("block").agg(F.sum(F.length("word")).alias("letters")).where(F.col("letters") > LETTERS)
    # written, so that its size is known: a row per LETTERS letters at most
    large = materialise(large.select("block", F.ceil(F.col("letters") / LETTERS).cast("int").alias("chunks")), "large")
    rows = rows.join(large, "block", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    rows = rows.withColumn("chunk", F.pmod(F.hash("word"), "chunks"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda other: F.struct(
        F.least("chunk", other).alias("a"), F.greatest("chunk", other).alias("b")))
    rows = rows.select("block", "less", "word", "n", "chunk", F.inline(pairs))
    rows = rows.repartition("block", "a", "b").sortWithinPartitions("block", "a", "b")
    return rows.mapInArrow(_meet, "word string, near string, near_n bigint")


def group_variants(words: DataFrame, times: int = 5) -> DataFrame:
    """(word, n), each word once -> (word, n, n_near: words one edit apart, form:
    the most frequent of these, the first by code points among equals, if it is
    at least ``times`` as frequent; form_n; root: where the forms lead to)."""
    words = materialise(words, "words")
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                                 F.min(F.struct(-F.col("near_n"), F.col("near"))).alias("best"))
    near = near.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.col1")).alias("near_n"))
    ok = F.col("near_n") >= times * F.col("n")
    forms = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(ok, F.col("near")).alias("form"),
        F.when(ok, F.col("near_n")).alias("form_n"))
    forms = materialise(forms, "forms")
    # a form is more frequent than its word: the way ends after few steps, and each round doubles them
    way = forms.where("form is not null").select("word", F.col("form").alias("to"))
    while True:
        on = materialise(way.join(way.select(F.col("word").alias("to"), F.col("to").alias("far")), "to", "left"), "way")
        way = on.select("word", F.coalesce("far", "to").alias("to"))
        if on.where("far is not null").isEmpty():
            break
    return forms.join(way, "word", "left").select("word", "n", "n_near", "form", "form_n",
                                                  F.coalesce("to", "word").alias("root"))
