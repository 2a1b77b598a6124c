"""Exact ratios against integer arithmetic."""

import random

from pyspark.sql import functions as F

from pmflow.functions.exprs import exact_ratio, with_exact_ratio

MOST = 2 ** 96 - 1


def ratio(n, d):
    """The ratio with as many places as fit 96 bits, half to even, as text."""
    if not d:
        return None
    sign = "-" if n * d < 0 else ""
    n, d = abs(n), abs(d)
    for places in range(28, -1, -1):
        q, r = divmod(n * 10 ** places, d)
        q += 2 * r > d or (2 * r == d and q % 2 == 1)
        if q <= MOST:
            text = str(q).rjust(places + 1, "0")
            text = f"{text[:len(text) - places]}.{text[len(text) - places:]}".rstrip("0").rstrip(".")
            return text if text == "0" else sign + text


def test_against_integers(spark):
    rng = random.Random(1)
    pairs = [(1, 3), (2, 3), (1, 4), (0, 7), (5, 0), (-1, 3), (1, -8), (-7, -2), (MOST, 1), (1, MOST), (MOST, MOST),
             (MOST, 3), (MOST - 1, 2), (10, 1), (7922816251426433759, 10 ** 18), (8, 1), (80000, 3), (79228, 7),
             (1, 2 * 10 ** 28), (3, 2 * 10 ** 28), (5, 2 * 10 ** 28), (10 ** 28, 3), (9, 10 ** 28 - 1), (1, 10 ** 28 + 1)]
    for _ in range(400):
        pairs.append((rng.getrandbits(rng.randint(1, 96)), rng.getrandbits(rng.randint(1, 96)) or 1))
        pairs.append((rng.randrange(10 ** 12), rng.randrange(1, 10 ** 9)))
    df = spark.createDataFrame([(str(a), str(b)) for a, b in pairs] + [(None, "1"), ("1", None)], "a string, b string")
    got = df.select(exact_ratio(F.col("a").cast("decimal(38,0)"), F.col("b").cast("decimal(38,0)")).alias("r"))
    assert [r[0] for r in got.collect()] == [ratio(a, b) for a, b in pairs] + [None, None]


def test_narrow_and_wide_numbers_give_the_same_text(spark):
    """numbers up to 10^12 are divided as longs, others by exact_ratio itself."""
    rng = random.Random(2)
    most = 10 ** 12
    pairs = [(0, 7), (-1, 3), (1, -8), (-7, -2), (most, 1), (1, most), (most, most), (most + 1, 3), (most, 3), (-most, 7),
             (80000, 3), (79228, 7), (792281625142, 100000000000), (999999999999, 1000), (999999999999, 999), (5, 0),
             (2, 3), (8, 1), (10 ** 9 - 1, 1), (10 ** 9, 1), (1, 2 ** 36), (3, 2 ** 39), (99999999999, 10 ** 11),
             (7922816251, 10 ** 9), (7922816252, 10 ** 9), (10 ** 12 - 1, 10 ** 12), (MOST, 3)]
    for _ in range(1500):
        pairs.append((rng.randrange(10 ** rng.randint(1, 12)), rng.randrange(1, 10 ** rng.randint(1, 12) + 1)))
        pairs.append((rng.randrange(10 ** rng.randint(1, 12)), 2 ** rng.randint(0, 39)))
    df = spark.createDataFrame([(i, str(a), str(b)) for i, (a, b) in enumerate(pairs)] + [(-1, None, "1"), (-2, "1", None)],
                               "i int, a string, b string")
    df = df.select("i", *[F.col(c).cast("decimal(38,0)").alias(c) for c in "ab"])
    made = with_exact_ratio(df, "a", "b", "r")
    assert made.columns == ["i", "a", "b", "r"]
    assert dict(made.select("i", "r").collect()) == {i: ratio(a, b) for i, (a, b) in enumerate(pairs)} | {-1: None, -2: None}
