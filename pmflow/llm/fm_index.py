"""FM-index over a shard's word ids: suffix order, Burrows-Wheeler transform in a
wavelet matrix, backward search, and locating by sampled suffix positions. All
steps run over numpy arrays, many patterns or rows at a time.

The sequence consists of runs of symbols >= 1, each closed by the separator 0.
No pattern holds a 0, so nothing is found across runs. Separators sort by
position, so every suffix is told apart by the end of its run at the latest.
"""

from __future__ import annotations

import numpy as np

#: Every so many positions the suffix position is kept; run starts always are.
SAMPLE = 16


class BitRank:
    """Bits packed in 64-bit words, with the ones counted up to each word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.frombuffer(np.pad(packed, (0, -len(packed) % 8 + 8)).tobytes(), "<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first ``i`` bits."""
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask).astype(np.int64)

    def at(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    """A sequence of integers below 2**levels, bit plane by bit plane."""

    def __init__(self, x: np.ndarray, levels: int):
        self.levels, self.planes, self.zeros = levels, [], []
        for level in range(levels - 1, -1, -1):
            bit = (x >> level & 1).astype(bool)
            self.planes.append(BitRank(bit))
            self.zeros.append(int(len(x) - bit.sum()))
            x = np.concatenate([x[~bit], x[bit]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each ``c`` occurs among the first ``i`` symbols."""
        start = np.zeros(len(i), np.int64)
        for plane, zeros, level in zip(self.planes, self.zeros, range(self.levels - 1, -1, -1)):
            bit = c >> level & 1 == 1
            s1, i1 = plane.ones(start), plane.ones(i)
            start = np.where(bit, zeros + s1, start - s1)
            i = np.where(bit, zeros + i1, i - i1)
        return i - start

    def access(self, i: np.ndarray) -> np.ndarray:
        """The symbols at ``i``."""
        c = np.zeros(len(i), np.int64)
        for plane, zeros in zip(self.planes, self.zeros):
            bit, i1 = plane.at(i), plane.ones(i)
            c = c << 1 | bit
            i = np.where(bit, zeros + i1, i - i1)
        return c


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix array of runs closed by 0, by prefix doubling. A round doubles
    the compared length, so a run of n symbols takes log2(n) rounds at most."""
    n = len(text)
    ends = text == 0
    rank = text.astype(np.int64) + int(ends.sum())
    rank[ends] = np.arange(ends.sum())
    k = 1
    order = np.argsort(rank, kind="stable")
    key = rank
    while True:
        sorted_key = key[order]
        fresh = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        key = rank * (n + 1)
        key[:n - k] += rank[k:] + 1
        order = np.argsort(key)
        k *= 2


class FMIndex:
    def __init__(self, text: np.ndarray):
        """``text``: non-empty, symbols >= 1, each run closed by 0."""
        order = suffix_order(text)
        last = text[order - 1]  # order 0 wraps to the last symbol, a separator
        self.levels = max(1, int(text.max()).bit_length())
        self.bwt = WaveletMatrix(last.astype(np.int64), self.levels)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << self.levels))])
        starts = np.concatenate([[True], text[:-1] == 0])
        kept = starts | (np.arange(len(text)) % SAMPLE == 0)
        self.sampled = BitRank(kept[order])
        self.positions = order[kept[order]]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of all patterns (rows, padded on the left; symbols
        >= 1). Returns the rows that occur and their suffix ranges."""
        width = patterns.shape[1]
        rows = np.arange(len(patterns))
        rows = rows[(patterns.max(axis=1, initial=0) < 1 << self.levels) & (lengths > 0)]
        c = patterns[rows, width - 1]
        lo, hi = self.first[c], self.first[c + 1]
        found_rows, found_lo, found_hi = [], [], []
        for step in range(1, width + 1):
            alive = lo < hi
            rows, lo, hi = rows[alive], lo[alive], hi[alive]
            ended = lengths[rows] == step
            found_rows.append(rows[ended])
            found_lo.append(lo[ended])
            found_hi.append(hi[ended])
            rows, lo, hi = rows[~ended], lo[~ended], hi[~ended]
            if not len(rows):
                break
            c = patterns[rows, width - 1 - step]
            lo = self.first[c] + self.bwt.rank(c, lo)
            hi = self.first[c] + self.bwt.rank(c, hi)
        return np.concatenate(found_rows), np.concatenate(found_lo), np.concatenate(found_hi)

    def locate(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The text positions in each range, and which range each belongs to:
        from a row, step left until a sampled suffix is met."""
        size = hi - lo
        which = np.repeat(np.arange(len(lo)), size)
        row = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + lo[which]
        position = np.zeros(len(row), np.int64)
        todo, steps = np.arange(len(row)), 0
        while len(todo):
            r = row[todo]
            hit = self.sampled.at(r)
            position[todo[hit]] = self.positions[self.sampled.ones(r[hit])] + steps
            todo, r = todo[~hit], r[~hit]
            c = self.bwt.access(r)
            row[todo] = self.first[c] + self.bwt.rank(c, r)
            steps += 1
        return position, which
