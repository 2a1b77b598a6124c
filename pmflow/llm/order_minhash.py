"""Order MinHash: fingerprints of documents that tell how many edits apart their
texts are, in built-in functions alone.

A text's k-mers are ``K`` consecutive tokens (what stands between white space;
in scripts without spaces every character), each with the number of its earlier
occurrences, so that repeats count. All are hashed onto a circle. From each of
``SKETCHES`` equally spaced points the next ``CHOSEN`` k-mers clockwise are taken:
the minimal ones under that point's order. Put back in text order they are a
tuple, whose hash is the sketch: it agrees with another text's where the same
k-mers were chosen *and* stand in the same order, so moving passages about shows,
which a set of k-mers doesn't tell. A fingerprint is the sketches, four hex digits
each; ``likeness`` is the share of equal ones.

A fingerprint costs one hash and two sorts of the text's k-mers inside its row:
no row is exploded and nothing is shuffled for it.

Defined cases: a null text is empty; a text without tokens has the empty
fingerprint, which is like itself alone (1.0, else 0.0); fewer than K tokens are
one k-mer; fewer than ``CHOSEN`` k-mers are all chosen. Columns of any name pass
through ``with_fingerprint``, but one named like its result is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pmflow.llm.common import column, place

#: Tokens of a k-mer.
K = 3
#: K-mers of a tuple.
CHOSEN = 2
#: Tuples of a fingerprint, a power of two.
SKETCHES = 128
#: Scripts written without spaces (Thai to Lao, Myanmar, Khmer, Kana, Han): their characters are tokens.
_ALONE = "".join(f"\\u{a:04X}-\\u{b:04X}" for a, b in (
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x9FFF)))
#: Tokens, as a pattern that finds them.
TOKEN = rf"[^\s{_ALONE}]+|[{_ALONE}]"

#: A hash (32 bits) and a position (31 bits) in one number sort as one.
_POSITION = 31
_POSITIONS = (1 << _POSITION) - 1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _pack(hashed: Column, position: Column) -> Column:
    return F.shiftleft(F.shiftrightunsigned(hashed, 32), _POSITION).bitwiseOR(position.cast("bigint"))


def _starts(a: Column, shift: int) -> Column:
    """Places in a sorted array where the bits above ``shift`` change."""
    return F.filter(F.sequence(F.lit(0), F.size(a) - 1), lambda i: (i == 0) | (
        F.get(a, i).bitwiseXOR(F.get(a, i - 1)) >= F.lit(1 << shift)))


def _numbered(kmers: Column) -> Column:
    """Sorted (k-mer, position)s -> sorted (hash of k-mer and occurrence, position)s.
    A first occurrence keeps the k-mer's hash, so without repeats all is done."""
    def runs(starts: Column) -> Column:
        return F.flatten(F.transform(starts, lambda first, r: F.transform(
            F.sequence(first, F.coalesce(F.get(starts, r + 1), F.size(kmers)) - 1), lambda i: F.when(
                i == first, F.get(kmers, i)).otherwise(_pack(
                    F.xxhash64(F.shiftright(F.get(kmers, i), _POSITION), i - first),
                    F.get(kmers, i).bitwiseAND(F.lit(_POSITIONS)))))))
    return _let(_starts(kmers, _POSITION), lambda starts: F.when(F.size(starts) == F.size(kmers), kmers).otherwise(
        F.sort_array(runs(starts))))


def _sketches(circle: Column, sketches: int, chosen: int) -> Column:
    """Sorted (hash, position)s -> the hex digits of the tuples from every point."""
    n = F.size(circle)
    shift = 63 - (sketches.bit_length() - 1)

    def arc(i: Column) -> Column:
        return F.shiftright(F.get(circle, i), shift).cast("int")

    def tuple_from(first: Column) -> Column:
        by_position = F.sort_array(F.transform(F.sequence(F.lit(0), F.least(F.lit(chosen), n) - 1), lambda d: _let(
            F.get(circle, (first + d) % n), lambda x: F.shiftleft(x.bitwiseAND(F.lit(_POSITIONS)), 32).bitwiseOR(
                F.shiftright(x, _POSITION)))))
        hashes = F.transform(by_position, lambda x: x.bitwiseAND(F.lit((1 << 32) - 1)))
        return F.lpad(F.hex(F.xxhash64(hashes).bitwiseAND(F.lit(0xFFFF))), 4, "0")

    def around(firsts: Column) -> Column:
        # points behind the last k-mer go on with the first one
        after = F.array_repeat(tuple_from(F.lit(0)), sketches - 1 - arc(n - 1))
        return F.concat(F.flatten(F.transform(firsts, lambda first, r: F.array_repeat(
            tuple_from(first), arc(first) - F.when(r == 0, -1).otherwise(arc(F.get(firsts, r - 1)))))), after)
    return F.lower(F.array_join(_let(_starts(circle, shift), around), ""))


def _tokens(text: Column) -> Column:
    """What ``TOKEN`` finds: split at white space, which is several times faster,
    after the characters that are tokens of their own have got some."""
    apart = F.when(text.rlike(f"[{_ALONE}]"), F.regexp_replace(text, f"[{_ALONE}]", " $0 ")).otherwise(text)
    return F.array_remove(F.split(apart, r"\s+"), "")


def fingerprint(text: Column, k: int = K, sketches: int = SKETCHES, chosen: int = CHOSEN) -> Column:
    """The fingerprint of a text: ``sketches`` times four hex digits."""
    def of(ids: Column) -> Column:
        kmers = F.sort_array(F.transform(F.sequence(F.lit(0), F.greatest(F.size(ids) - k, F.lit(0))), lambda i: _pack(
            F.xxhash64(*[F.get(ids, i + j) for j in range(k)]), i)))
        circle = _let(kmers, _numbered)
        return F.when(F.size(ids) == 0, "").otherwise(_let(circle, lambda c: _sketches(c, sketches, chosen)))
    tokens = _tokens(F.coalesce(text.cast("string"), F.lit("")))
    return _let(F.transform(tokens, lambda t: F.xxhash64(t)), of)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal sketches of two fingerprints of the same parameters."""
    def sketches(x: Column) -> Column:
        return F.regexp_extract_all(x, F.lit(".{4}"), F.lit(0))
    equal = F.size(F.filter(F.zip_with(sketches(a), sketches(b), lambda x, y: x == y), lambda same: same))
    most = F.greatest(F.length(a), F.length(b)) / 4
    return F.when(most == 0, 1.0).otherwise(equal / most)


def with_fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint", **parameters: int) -> DataFrame:
    """``df`` with the fingerprint of a text column."""
    return df.withColumn(out, fingerprint(column(text), **parameters))


def edited(docs: DataFrame, key: str = "doc_id", text: str = "text", **parameters: int) -> DataFrame:
    """Every row's text, its text after a large edit, and the fingerprints of
    both and of the next row's: (key, text, edited, fingerprint,
    edited_fingerprint, next_key, next_fingerprint).

    The edit puts the beginning of the next row's text, by descending key (nulls
    last; equal keys by hash of text; after the last the first), in place of the
    last half. Equal rows follow each other; they are taken as one with a count,
    so that a text is shuffled once, with its fingerprint, and the next one's
    beginning, as much as is wanted, is sent to the row before it."""
    given = docs.select(column(key).alias("key"), F.coalesce(column(text).cast("string"), F.lit("")).alias("text"))
    given = given.withColumns({"id": F.coalesce(F.concat(F.lit("k"), F.col("key").cast("string")), F.lit("")),
                               "hash": F.xxhash64("text")})
    order = given.groupBy("id", "hash").agg(F.first("key").alias("key"), F.count(F.lit(1)).alias("times"),
                                            F.first(F.char_length("text")).alias("n_chars"))
    order = place(order, [F.desc_nulls_last("key"), F.asc("id"), F.asc("hash")], "fingerprint-order")
    n = max(order.count(), 1)
    before = order.select(F.col("id").alias("to_id"), F.col("hash").alias("to_hash"), "times",
                          F.floor(F.col("n_chars") / 2).cast("int").alias("half"), ((F.col("at") + 1) % n).alias("at"))
    sends = order.select("id", "hash", "at").join(before, "at").drop("at")

    prints = F.unhex(fingerprint(F.col("text"), **parameters))
    texts = given.groupBy("id", "hash").agg(F.first("key").alias("key"), F.first("text").alias("text"),
                                            F.first(prints).alias("print"))
    # both uses of the texts take all their columns, so that they are shuffled (and printed) once
    sent = texts.join(sends, ["id", "hash"]).select(
        F.col("to_id").alias("id"), F.col("to_hash").alias("hash"), "times", "half",
        F.left("text", F.col("half")).alias("head"), F.col("print").alias("next_print"), F.col("key").alias("next_key"))
    both = texts.join(sent, ["id", "hash"])
    # of equal rows all but the last are followed by an equal one
    nexts = F.array(F.struct("head", "next_print", "next_key", F.lit(1).cast("bigint").alias("rows")),
                    F.struct(F.left("text", F.col("half")).alias("head"), F.col("print").alias("next_print"),
                             F.col("key").alias("next_key"), (F.col("times") - 1).alias("rows")))
    both = both.select("key", "text", "print", F.left("text", F.char_length("text") - F.col("half")).alias("stays"),
                       F.inline(F.filter(nexts, lambda x: x["rows"] > 0)))
    both = both.select("key", "text", "print", "next_key", "next_print", "rows",
                       F.concat("stays", "head").alias("edited"))
    out = both.select("key", "text", "edited", F.lower(F.hex("print")).alias("fingerprint"),
                      fingerprint(F.col("edited"), **parameters).alias("edited_fingerprint"), "next_key",
                      F.lower(F.hex("next_print")).alias("next_fingerprint"), "rows")
    return out.withColumn("_", F.explode(F.sequence(F.lit(1).cast("bigint"), "rows"))).drop("_", "rows")
