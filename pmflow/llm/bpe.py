"""Byte-level BPE: vocabularies, pre-tokens and the merge loop."""

from __future__ import annotations

import base64
import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable

import numpy as np
import regex

#: Above every rank.
NEVER = (1 << 31) - 1
#: Multiplier that spreads pairs over a table's slots.
SPREAD, _64_BITS = 0x9E3779B97F4A7C15, (1 << 64) - 1
#: Bytes of a worker's piece cache, by ENTRY_BYTES a piece besides its characters
#: and ids; it starts anew when full.
CACHE_BYTES = 32 << 20
ENTRY_BYTES = 150


class Vocabulary:
    """Which pairs of tokens merge: ``keys`` (first id << 32 | second id) have
    ``ranks``, and ``made`` the id that each becomes; ``special`` holds strings
    that are taken out of a text before it is split, one id each. Workers hold
    the pairs as flat arrays only, no tokens."""

    def __init__(self, ids: dict[bytes, int], keys: np.ndarray, ranks: np.ndarray, made: np.ndarray,
                 special: dict[str, int]):
        self.special = special
        self.of_byte = np.array([ids[bytes([b])] for b in range(256)], np.int32)
        # by rank: the id that the pair becomes; the last stands for NEVER
        self.made = np.full(max(ranks.tolist(), default=0) + 2, -1, np.int32)
        # an open-addressing table of the pairs, looked up for many pairs at a time
        bits = max(10, (4 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slot_key = np.full(1 << bits, -1, np.int64)
        self.slot_rank = np.full(1 << bits, NEVER, np.int32)
        self.made[ranks] = made
        at, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.slot_key[at[todo]] == -1
            self.slot_key[at[todo[free]]] = keys[todo[free]]
            todo = todo[self.slot_key[at[todo]] != keys[todo]]
            at[todo] = (at[todo] + 1) & ((1 << bits) - 1)
        self.slot_rank[at] = ranks
        # the same arrays, read one number at a time
        self._keys, self._ranks, self._made = (memoryview(x) for x in (self.slot_key, self.slot_rank, self.made))
        self._shift, self._mask = 64 - bits, (1 << bits) - 1
        # the rank of each pair of bytes: (first << 8) | second
        self.of_bytes = self.look_up(np.repeat(self.of_byte, 256), np.tile(self.of_byte, 256))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(SPREAD) >> self.shift).astype(np.int64)

    @classmethod
    def from_ranks(cls, path: str) -> Vocabulary:
        """A .tiktoken file: a pair merges if its joined bytes have a rank, and
        a rank is the token's id."""
        ids = read_ranks(path)
        keys, ranks, get = array("q"), array("i"), ids.get
        for t, r in ids.items():
            for i in range(1, len(t)):
                if (x := get(t[:i])) is not None and (y := get(t[i:])) is not None:
                    keys.append(x << 32 | y)
                    ranks.append(r)
        packed = np.array(ranks, np.int32)
        return cls(ids, np.array(keys, np.int64), packed, packed, {})

    @classmethod
    def from_merges(cls, path: str) -> Vocabulary:
        """A .json file: the vocabulary and its list of merges, in rank order."""
        ids, data = read_json(path)
        raw = _symbol_bytes()
        to_bytes = lambda s: bytes(raw[c] for c in s)
        pairs = {}
        for i, m in enumerate(data["model"]["merges"]):
            x, y = map(to_bytes, m.split(" ") if isinstance(m, str) else m)
            pairs[ids[x] << 32 | ids[y]] = (i, ids[x + y])
        ranks, made = (np.array([p[k] for p in pairs.values()], np.int32) for k in (0, 1))
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        return cls(ids, np.array(list(pairs), np.int64), ranks, made, special)

    def pair(self, a: int, b: int) -> tuple[int, int] | None:
        """The rank of one pair and the id that it becomes; None if it doesn't merge."""
        key, keys = a << 32 | b, self._keys
        at = (key * SPREAD & _64_BITS) >> self._shift
        while (found := keys[at]) != key:
            if found == -1:
                return None
            at = (at + 1) & self._mask
        rank = self._ranks[at]
        return rank, self._made[rank]

    def look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair; NEVER where it doesn't merge."""
        key = a.astype(np.int64) << 32 | b
        at = self._slot(key)
        found = self.slot_key[at]
        out = np.where(found == key, self.slot_rank[at], NEVER).astype(np.int32)
        todo = np.flatnonzero((found != key) & (found != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.slot_key) - 1)
            found = self.slot_key[at[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.slot_rank[at[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        return out


def read_ranks(path: str) -> dict[bytes, int]:
    """The ids of a .tiktoken file's tokens."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}


def read_json(path: str) -> tuple[dict[bytes, int], dict]:
    """The ids of a .json file's tokens, and all that it holds."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    raw = _symbol_bytes()
    return {bytes(raw[c] for c in k): v for k, v in data["model"]["vocab"].items() if all(c in raw for c in k)}, data


def token_bytes(path: str) -> list[bytes]:
    """The raw bytes of each id of a vocabulary."""
    ids = read_json(path)[0] if path.endswith(".json") else read_ranks(path)
    out = [b""] * (max(ids.values()) + 1)
    for t, i in ids.items():
        out[i] = t
    return out


def _symbol_bytes() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level
    vocabularies: printable Latin-1 stands for itself, the other bytes follow
    from U+0100 on."""
    out, extra = {}, 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out[chr(b)] = b
        else:
            out[chr(256 + extra)] = b
            extra += 1
    return out


#: Pieces of more bytes are merged one by one, with a heap.
LONG = 64
#: Bits of a place in such a piece, the empty places at both its ends among them.
PLACE_BITS = 7
#: Pieces that are merged at a time.
ROWS = 4096
#: Unknown pieces that are computed together, repeats among them.
MISSED = 4 * ROWS


def merge_pieces(pieces: list[bytes], vocab: Vocabulary) -> list[bytes]:
    """The ids of each pre-token after all merges, packed little-endian: always
    the pair of lowest rank, leftmost first. Pieces of like length are merged
    side by side, one merge each in a round."""
    out: list[bytes] = [b""] * len(pieces)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    order = np.argsort(sizes, kind="stable")
    short = int(np.searchsorted(sizes[order], LONG, side="right"))
    for i in order[short:].tolist():
        out[i] = np.array(_merge_long(pieces[i], vocab), "<u4").tobytes()
    # ranks that leave no room for a place beside them need 64 bits
    kind = np.int32 if len(vocab.made) < 1 << 31 - PLACE_BITS else np.int64
    for start in range(0, short, ROWS):
        rows = order[start:min(start + ROWS, short)].tolist()
        for i, x in zip(rows, _merge_rows([pieces[i] for i in rows], vocab, kind)):
            out[i] = x
    return out


def _merge_rows(pieces: list[bytes], vocab: Vocabulary, kind: type) -> list[bytes]:
    """The merges of some pieces in ascending order of length. A place's row
    holds that place of all pieces, with an empty one (id -1) before and after
    the longest; a merge leaves the pair's right place empty, and ``after`` and
    ``before`` lead past empty places."""
    n, width = len(pieces), max(len(pieces[-1]), 1) + 2
    never = np.iinfo(kind).max
    raw = np.frombuffer(b"".join([x.ljust(width - 2, b"\0") for x in pieces]), np.uint8)
    raw = np.ascontiguousarray(raw.reshape(n, width - 2).T)
    sizes = np.fromiter(map(len, pieces), np.int64, n)
    ids = np.full((width, n), -1, np.int32)
    ids[1:-1] = vocab.of_byte[raw]
    ids[1:-1][np.arange(width - 2)[:, None] >= sizes] = -1

    def rated(rank, place):  # rank and place of a pair in one number: the least is the next to merge
        return np.where(rank == NEVER, never, rank.astype(kind) << PLACE_BITS | place.astype(kind))

    best = np.full(ids.shape, never, kind)
    places = np.arange(1, width - 2)[:, None]
    best[1:-2] = rated(vocab.of_bytes[raw[:-1].astype(np.int32) << 8 | raw[1:]], places)
    best[1:-2][places >= sizes] = never
    after = np.arange(n, (width + 1) * n)
    before = np.arange(-n, (width - 1) * n)
    flat_ids, flat_best, column = ids.reshape(-1), best.reshape(-1), np.arange(n)
    while True:
        least = best.min(axis=0)
        todo = np.flatnonzero(least != never)
        if not len(todo):
            break
        least = least[todo]
        at = (least & (1 << PLACE_BITS) - 1) * n + column[todo]
        gone = after[at]
        right, left = after[gone], before[at]
        flat_ids[at] = vocab.made[least >> PLACE_BITS]
        flat_ids[gone], flat_best[gone] = -1, never
        after[at], before[right] = right, at
        # an empty place pairs with nothing
        a, b = np.concatenate([left, at]), np.concatenate([at, right])
        flat_best[a] = rated(vocab.look_up(flat_ids[a], flat_ids[b]), a // n)
    ids = ids.T
    kept = ids >= 0
    packed = ids[kept].astype("<u4").tobytes()
    ends = (4 * np.cumsum(kept.sum(axis=1))).tolist()
    return [packed[x:y] for x, y in zip([0, *ends], ends)]


def _merge_long(piece: bytes, vocab: Vocabulary) -> list[int]:
    """One piece of any length: a heap over a linked list, O(n log n)."""
    n, get = len(piece), vocab.pair
    ids: list[int] = vocab.of_byte[np.frombuffer(piece, np.uint8)].tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int, int]] = []

    def push(i):
        if i >= 0 and (j := after[i]) < n and (m := get(ids[i], ids[j])):
            heapq.heappush(heap, (m[0], i, ids[i], ids[j], m[1]))

    for i in range(n - 1):
        push(i)
    while heap:
        _, i, a, b, made = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j >= n or ids[j] != b:  # one side has merged since
            continue
        ids[i], ids[j] = made, -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        push(i)
        push(before[i])
    return [x for x in ids if x >= 0]


class PieceIds(dict):
    """Pre-token -> its ids, packed; a worker computes each distinct pre-token
    once while the cache lasts."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.held = vocab, 0

    def learn(self, pieces: set[str]) -> None:
        """Compute the pieces that aren't known yet, side by side."""
        self._make_room()
        self._add([p for p in pieces if p not in self])

    def of(self, texts: Iterable[list[str]]) -> list[list[bytes]]:
        """The ids of each text's pre-tokens. Each is looked up once; only those
        not known yet are gone back to, some thousands at a time. Of texts that
        come one by one, the other strings aren't held."""
        out, get, gaps, missed = [], self.get, [], []
        for pieces in texts:
            found = list(map(get, pieces))
            out.append(found)
            if at := [i for i, x in enumerate(found) if x is None]:
                gaps.append((found, at))
                missed += [pieces[i] for i in at]
                if len(missed) >= MISSED:
                    self._fill(gaps, missed)
                    gaps, missed = [], []
        self._fill(gaps, missed)
        return out

    def _fill(self, gaps: list[tuple[list, list[int]]], missed: list[str]) -> None:
        self.learn(set(missed))
        made = map(self.__getitem__, missed)
        for found, at in gaps:
            for i, x in zip(at, made):
                found[i] = x

    def _make_room(self) -> None:
        if self.held > CACHE_BYTES:
            self.clear()
            self.held = 0

    def _add(self, todo: list[str]) -> None:
        made = merge_pieces([p.encode() for p in todo], self.vocab)
        self.update(zip(todo, made))
        self.held += ENTRY_BYTES * len(todo) + sum(map(len, todo)) + sum(map(len, made))

    def __missing__(self, piece: str) -> bytes:
        self.learn({piece})
        return self[piece]


def _odd_class() -> str:
    """Characters on which Python's \\w, \\d and \\s may differ from \\p{L},
    \\p{N} and White_Space: numbers that are no digits, code points that this
    Python's tables don't know, four separators, and all beyond U+FFFF."""
    odd = "".join(re.escape(chr(c)) for c in range(0x80, 0x10000)
                  if unicodedata.category(chr(c)) in ("No", "Nl", "Cn"))
    return "[\x1c-\x1f\U00010000-\U0010ffff" + odd + "]"


class Pretokens:
    """Splits a text by the public pattern. Nearly all texts take an equal
    pattern of the faster ``re`` module; a text with a character on which the
    two may differ takes the pattern itself."""

    def __init__(self, pattern: str):
        self.exact = regex.compile(pattern)
        self.odd = re.compile(_odd_class())
        quick = r"(?: ?[^\W\d_]+| ?\d+|'(?:[stmd]|re|ve|ll)| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+)"
        known = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.quick = re.compile(quick) if pattern == known else None

    def _of(self, text: str):
        if self.quick is None or self.odd.search(text):
            return self.exact
        return self.quick

    def split(self, text: str) -> list[str]:
        return self._of(text).findall(text)

    def starts(self, text: str) -> np.ndarray:
        """Offsets at which the pre-tokens start."""
        lengths = np.fromiter(map(len, self.split(text)), np.int64)
        return np.concatenate([[0], np.cumsum(lengths)])[:-1] if len(lengths) else lengths
