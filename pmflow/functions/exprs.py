"""Scalar Column functions (F3-F27). All built-in expressions: no Python per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pmflow.functions.taxonomy import unicode_trim

# Fixed values shared with the reference's numeric semantics.
AMOUNT_SCALE = 1_000_000                              # 6 implied decimals
DECIMAL96_MAX = "79228162514264337593543950335"       # 2^96 - 1, largest parseable amount
USDC_ASSET = "0"                                      # asset id that stands for USDC
AMOUNT_TYPE = "decimal(38,6)"

_AMOUNT_RE = r"^[+-]?[0-9]+(\.[0-9]+)?$"
# RFC3339 (offset or Z, optional fraction, T/t/space separator) or naive 'YYYY-MM-DDTHH:MM:SS[Z]'
_RFC3339_RE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})$"
_NAIVE_RE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}$"
ADDRESS_RE = r"^0x[a-fA-F0-9]{40}$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def amount_text(c: Column | str) -> Column:
    """amount column of any type -> text, NULL -> '0'."""
    return F.coalesce(col(c).cast("string"), F.lit("0"))


def parse_amount(c: Column | str) -> Column:
    """F3 (unscaled): amount text -> DECIMAL(38,6), NULL if not a number or beyond 2^96-1."""
    t = unicode_trim(col(c))
    d = F.when(t.rlike(_AMOUNT_RE), t.try_cast(AMOUNT_TYPE))
    # text shorter than 29 chars has at most 28 digits, below 2^96-1: skip the
    # (BigDecimal) bound comparison for every realistic amount
    in_range = (F.length(t) < 29) | (F.abs(d) <= F.lit(DECIMAL96_MAX).cast("decimal(38,0)"))
    return F.when(in_range, d)


def scaled_double(d: Column) -> Column:
    """Raw integer amount (DECIMAL) -> token units as DOUBLE (divide by 10^6)."""
    return d.cast("double") / F.lit(float(AMOUNT_SCALE))


#: Decimal places of an exact ratio at most, and digits that are divided at a time:
#: a remainder below 2^96 times 10^9 still fits 38 digits.
RATIO_PLACES = 28
_BLOCK = 9
_WIDE = "decimal(38,0)"


def exact_ratio(numer: Column, denom: Column) -> Column:
    """numer / denom of integers up to 2^96-1 as plain decimal text without
    trailing zeros: as many places (28 at most) as leave the digits, read as one
    number, within 96 bits; what is beyond is rounded half to even. NULL for a
    NULL or a zero denominator.

    Long division by blocks of nine digits: each step's products stay within
    DECIMAL(38), so all of it is column arithmetic."""
    n, d = F.abs(numer.cast(_WIDE)), F.nullif(F.abs(denom.cast(_WIDE)), F.lit(0).cast(_WIDE))

    def divided(a: Column) -> tuple[Column, Column]:
        rest = a % d
        return ((a - rest) / d).cast(_WIDE), rest.cast(_WIDE)

    whole, rest = divided(n)
    blocks = []
    for _ in range(4):
        q, rest = divided((rest * F.lit(10 ** _BLOCK).cast("decimal(10,0)")).cast(_WIDE))
        blocks.append(F.lpad(q.cast("string"), _BLOCK, "0"))
    # each part once: the projections above refer to it several times
    parts = F.struct(whole.alias("whole"), F.concat(*blocks).alias("digits"), (rest != 0).alias("more"))

    def rounded(p: Column, places: Column) -> Column:
        """The digits as one number, with some of them behind the point."""
        head = F.concat(p["whole"].cast("string"), F.substring(p["digits"], F.lit(1), places)).cast(_WIDE)
        tail, half = F.substring(p["digits"], places + 1, F.lit(36)), F.rpad(F.lit("5"), 36 - places, F.lit("0"))
        up = (tail > half) | ((tail == half) & (p["more"] | (head % 2 == 1)))
        return (head + up.cast("int")).cast(_WIDE)

    def text(p: Column) -> Column:
        most = F.least(F.lit(RATIO_PLACES), F.lit(29) - F.length(p["whole"].cast("string")))
        places = F.when(rounded(p, most) <= F.lit(DECIMAL96_MAX).cast(_WIDE), most).otherwise(most - 1)

        def pointed(x: Column) -> Column:
            digits = F.lpad(x["number"].cast("string"), 40, "0")
            at = 40 - x["places"]
            out = F.concat(F.substring(digits, F.lit(1), at), F.lit("."), F.substring(digits, at + 1, F.lit(40)))
            return F.regexp_replace(F.regexp_replace(out, r"^0+(?=\d)|0+$", ""), r"\.$", "")
        return F.get(F.transform(F.array(places), lambda k: pointed(
            F.named_struct(F.lit("number"), rounded(p, k), F.lit("places"), k))), F.lit(0))

    out = F.get(F.transform(F.array(parts), text), F.lit(0))
    negative = (F.signum(numer) * F.signum(denom) < 0) & (out != "0")
    return F.when(d.isNotNull() & n.isNotNull(), F.when(negative, F.concat(F.lit("-"), out)).otherwise(out))


#: Numbers up to here are divided as longs, if the whole part stays below
#: ``_NARROW_WHOLE``: a remainder times 10^6 then fits a long, and so do 18 decimals.
_NARROW = 10 ** 12
_NARROW_WHOLE = 10 ** 9
_NARROW_BLOCK = 6


def with_exact_ratio(df: DataFrame, numer: str, denom: str, out: str) -> DataFrame:
    """``df`` with ``out``: ``exact_ratio`` of two of its columns. Numbers up to
    10^12 are divided as longs, one projection per step, so that each quotient
    and remainder is computed once; all others take ``exact_ratio`` itself."""
    def div(a, b):
        return F.call_function("div", a, b)

    def long(x: str) -> Column:
        c = F.col(x).cast(_WIDE).try_cast("bigint")
        return F.when(c.between(-_NARROW, _NARROW), c)

    t = df.withColumns({"_n": long(numer), "_d": F.nullif(long(denom), F.lit(0).cast("bigint"))})
    t = t.withColumns({"_minus": (F.col("_n") < 0) != (F.col("_d") < 0), "_n": F.abs("_n"), "_d": F.abs("_d")})
    t = t.withColumns({"_whole": div(F.col("_n"), F.col("_d")), "_r0": F.col("_n") % F.col("_d")})
    t = t.withColumn("_whole", F.when(F.col("_whole") < _NARROW_WHOLE, F.col("_whole")))
    shift = F.lit(10 ** _NARROW_BLOCK).cast("bigint")
    for k in range(6):
        t = t.withColumn("_a", F.col(f"_r{k}") * shift)
        t = t.withColumns({f"_q{k}": div(F.col("_a"), F.col("_d")), f"_r{k + 1}": F.col("_a") % F.col("_d")})
    # 36 decimals as two longs; as many places stay as make 29 digits, or one less
    digits = [F.col(f"_q{k}") * F.lit(10 ** (12 - 6 * (k % 3))).cast("bigint") for k in range(6)]
    t = t.withColumns({"_x": digits[0] + digits[1] + digits[2], "_y": digits[3] + digits[4] + digits[5],
                       "_most": F.lit(29) - F.length(F.col("_whole").cast("string"))})
    tens = F.array(*[F.lit(10 ** k).cast("bigint") for k in range(19)])

    def rounded(t: DataFrame, places: Column, suffix: str) -> DataFrame:
        w, x, y, tail, pw = (f"_{c}{suffix}" for c in "wxytp")
        t = t.withColumn(pw, F.get(tens, F.lit(36) - places))
        t = t.withColumns({y: div(F.col("_y"), F.col(pw)), tail: (F.col("_y") % F.col(pw)) * 2})
        up = (F.col(tail) > F.col(pw)) | ((F.col(tail) == F.col(pw)) & ((F.col("_r6") > 0) | (F.col(y) % 2 == 1)))
        t = t.withColumn(y, F.col(y) + up.cast("bigint"))
        t = t.withColumn(x, F.col("_x") + (F.col(y) == F.get(tens, places - 18)).cast("bigint"))
        full = F.col(x) == F.lit(10 ** 18).cast("bigint")
        t = t.withColumns({w: (F.col("_whole") + full.cast("bigint")).cast("string"), f"_f{suffix}": F.concat(
            F.lpad(F.when(full, F.lit(0).cast("bigint")).otherwise(F.col(x)).cast("string"), 18, "0"),
            F.lpad(F.when(F.col(y) == F.get(tens, places - 18), F.lit(0).cast("bigint")).otherwise(F.col(y))
                   .cast("string"), places - 18, F.lit("0")))})
        return t

    t = rounded(t, F.col("_most"), "1")
    number = F.concat("_w1", "_f1")
    over = (F.length(number) > 29) | (number > DECIMAL96_MAX)
    t = t.withColumn("_places", F.when(over, F.col("_most") - 1).otherwise(F.col("_most")))
    t = rounded(t, F.col("_places"), "2")
    t = t.withColumn("_f2", F.rtrim(F.col("_f2"), F.lit("0")))
    text = F.when(F.col("_f2") == "", F.col("_w2")).otherwise(F.concat("_w2", F.lit("."), "_f2"))
    t = t.withColumn("_text", text)
    t = t.withColumn("_text", F.when(F.col("_minus") & (F.col("_text") != "0"),
                                     F.concat(F.lit("-"), "_text")).otherwise(F.col("_text")))
    return t.select(*df.columns, F.coalesce("_text", exact_ratio(F.col(numer), F.col(denom))).alias(out))


def iso_to_unix(c: Column | str, allow_naive: bool = True) -> Column:
    """ISO/RFC3339 text -> unix seconds (fraction floored); NULL when not parseable.

    One guard regex on the trimmed text, then Spark's own timestamp parser
    (upper-cased so 't'/'z' read as 'T'/'Z'; no zone = UTC session zone).
    """
    t = unicode_trim(col(c))
    pattern = _RFC3339_RE if not allow_naive else \
        r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?([Zz]|[+-][0-9]{2}:[0-9]{2})" \
        r"|T[0-9]{2}:[0-9]{2}:[0-9]{2})$"
    return F.when(t.rlike(pattern), F.unix_seconds(F.try_to_timestamp(F.upper(t))))


def iso_to_timestamp(c: Column | str) -> Column:
    """RFC3339 text (with a zone) -> TIMESTAMP with its fraction, to the
    microsecond; NULL when not parseable."""
    # trimmed once: a text that fails the guard becomes NULL before it is parsed;
    # digits beyond microseconds are cut by the parser
    t = F.regexp_extract(F.upper(unicode_trim(col(c))), _RFC3339_RE, 0)
    return F.try_to_timestamp(F.nullif(t, F.lit("")))


def unix_to_iso(c: Column | str) -> Column:
    """unix seconds -> 'YYYY-MM-DDTHH:MM:SS+00:00'."""
    return F.date_format(F.timestamp_seconds(col(c)), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def unix_to_date(c: Column | str) -> Column:
    """unix seconds -> UTC date."""
    return F.to_date(F.timestamp_seconds(col(c)))


def nonempty(c: Column | str) -> Column:
    """NULL and '' both fail (no trimming)."""
    return F.coalesce(col(c), F.lit("")) != ""


def loose_address(c: Column | str) -> Column:
    """Starts with 0x and has length 42 after trim."""
    t = F.trim(col(c))
    return t.startswith("0x") & (F.length(t) == 42)


def strict_address(c: Column | str) -> Column:
    """P10: ^0x[a-fA-F0-9]{40}$ (table CHECK)."""
    return F.coalesce(col(c).rlike(ADDRESS_RE), F.lit(False))


def hex_to_long(c: Column | str) -> Column:
    """'0x..' hex text, zero-padded or not -> LONG; NULL when malformed or
    wider than 63 bits."""
    # each step is referred to once; conv makes NULL of no digits
    digits = F.regexp_extract(F.lower(F.trim(col(c))), r"^(?:0x)?0*([0-9a-f]{1,16})$", 1)
    return F.conv(digits, 16, 10).try_cast("bigint")


def topic_to_address(c: Column | str) -> Column:
    """32-byte topic word -> '0x' + last 40 hex chars lowercased; '' if shorter."""
    t = F.trim(F.coalesce(col(c), F.lit("")))
    body = F.when(t.startswith("0x") | t.startswith("0X"), F.substr(t, F.lit(3))).otherwise(t)
    return F.when(F.length(body) >= 40, F.concat(F.lit("0x"), F.lower(F.right(body, F.lit(40))))).otherwise(F.lit(""))


def basename(c: Column | str) -> Column:
    """last path segment."""
    return F.element_at(F.split(col(c), "/"), -1)


def strip_sidecar_prefix(c: Column | str) -> Column:
    """'dir/._name.parquet' -> 'dir/name.parquet' (only in the basename)."""
    return F.regexp_replace(col(c), r"(^|/)\._([^/]+)$", "$1$2")


def is_sidecar(c: Column | str) -> Column:
    """Basename starts with '._' and key ends with '.parquet'."""
    return basename(c).startswith("._") & col(c).endswith(".parquet")


def first_nonempty(*cols: Column | str) -> Column:
    """first value that is neither NULL nor ''."""
    return F.coalesce(*[F.nullif(col(c), F.lit("")) for c in cols])


def cursor_key(c: Column | str) -> Column:
    """cursor text is 'last_completed_file=<key>' on some line, or a bare key."""
    t = F.trim(col(c))
    k = F.regexp_extract(t, r"(?m)^last_completed_file=(.*)$", 1)
    return F.when(k != "", F.trim(k)).otherwise(F.when(t != "", t))
