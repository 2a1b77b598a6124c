"""Scalar functions: the reference's own vectors and hand-made edge rows."""

from pyspark.sql import functions as F

from pmflow.functions import exprs as E
from pmflow.functions.taxonomy import normalize_key, topic_of


def one(spark, expr, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v")).alias("r")).first()[0]


def test_topic_reference_vectors(spark):
    assert one(spark, topic_of, "US-current-affairs") == "politics"
    assert one(spark, topic_of, "Tech") == "tech"


def test_topic_traps(spark):
    cases = {"Inflation": "sports", "Coinbase": "sports", "us_elections": "politics", "us election": "elections",
             "Middle East": "geopolitics", " Crypto_Prices ": "crypto", "Pop_Culture": "pop-culture",
             "Senator race": "geopolitics", "federal reserve": "finance", "AI": "ai", "culture": "culture",
             "Hurricane season": "weather", "mentions": "mentions", "trump": "politics", "iranian oil": "iran"}
    for cat, topic in cases.items():
        assert one(spark, topic_of, cat) == topic, cat
    for blank in (None, "", "\t", "  "):
        assert one(spark, topic_of, blank) == "other"


def test_normalize_key(spark):
    assert one(spark, normalize_key, "  Big_Tech  Stocks\t") == "big-tech--stocks"
    assert one(spark, normalize_key, " US  Election ") == "us--election"


def test_parse_amount(spark):
    assert float(one(spark, E.parse_amount, "5000000")) == 5000000.0
    assert float(one(spark, E.parse_amount, " 12 ")) == 12.0
    assert one(spark, E.parse_amount, "abc") is None
    assert one(spark, E.parse_amount, "1e5") is None
    assert one(spark, E.parse_amount, "79228162514264337593543950335") is not None
    assert one(spark, E.parse_amount, "79228162514264337593543950336") is None


def test_iso_to_unix(spark):
    assert one(spark, E.iso_to_unix, "2024-01-02T03:04:05.9+02:00") == 1704157445
    assert one(spark, E.iso_to_unix, "2024-01-02T03:04:05") == 1704164645
    assert one(spark, E.iso_to_unix, "2024-01-02T03:04:05Z") == 1704164645
    assert one(spark, E.iso_to_unix, "2024") is None
    assert one(spark, lambda c: E.iso_to_unix(c, allow_naive=False), "2024-01-02T03:04:05") is None


def test_unix_to_iso(spark):
    assert one(spark, E.unix_to_iso, 1704164645, "bigint") == "2024-01-02T03:04:05+00:00"


def test_topic_to_address(spark):
    word = "0x" + "0" * 24 + "AbCdEf0123456789abcdef0123456789ABCDEF01"
    assert one(spark, E.topic_to_address, word) == "0xabcdef0123456789abcdef0123456789abcdef01"
    assert one(spark, E.topic_to_address, "0x1234") == ""


def test_hex_to_long(spark):
    assert one(spark, E.hex_to_long, "0x1f") == 31
    assert one(spark, E.hex_to_long, "0xzz") is None
    assert one(spark, E.hex_to_long, "0x" + "f" * 17) is None


def test_sidecar_vectors(spark):
    assert one(spark, E.is_sidecar, "exchange/markets/._markets_40000_50000.parquet") is True
    assert one(spark, E.is_sidecar, "exchange/markets/markets_40000_50000.parquet") is False
    assert one(spark, E.strip_sidecar_prefix, "exchange/blocks/._blocks_10000000_10100000.parquet") == \
        "exchange/blocks/blocks_10000000_10100000.parquet"
    assert one(spark, E.strip_sidecar_prefix, "exchange/trades/._trades_0_10000.parquet") == \
        "exchange/trades/trades_0_10000.parquet"
    assert one(spark, E.strip_sidecar_prefix, "exchange/blocks/blocks_1_2.parquet") == \
        "exchange/blocks/blocks_1_2.parquet"


def test_cursor_key(spark):
    assert one(spark, E.cursor_key, "x=1\nlast_completed_file=exchange/trades/b.parquet\n") == \
        "exchange/trades/b.parquet"
    assert one(spark, E.cursor_key, "exchange/trades/a.parquet") == "exchange/trades/a.parquet"
