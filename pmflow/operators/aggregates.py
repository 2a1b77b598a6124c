"""Maker volume rollups (D14 wallet_topic_volume, D15 global_daily, X4).

Plan shape of ``wallet_topic_volume``:

    facts (pruned to ts_unix, maker, market_id, usd_amount; P7 filter pushed to the scan)
      --left join--> topics
      --groupBy(wallet, topic, age band), a sum and a count             partial+final hash agg
      --explode the periods of the aggregated rows' bands, repartition(wallet, period)
      --groupBy(wallet, topic, period)                                  no further exchange
      --window sum over (wallet, period)-->  share_of_wallet            no further exchange

Sums are exact DECIMAL (order independent, so reruns and the SQL oracle agree
bit for bit) and are cast to DOUBLE once at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pmflow.functions.exprs import unix_to_date

DAY = 86400
SUM_TYPE = "decimal(38,6)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column | str) -> Column:
    """ASCII-only lowercase (non-ASCII letters untouched)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.translate(c, _UPPER, _LOWER)


def market_topics(markets: DataFrame) -> DataFrame:
    """market_id -> topic; a NULL topic reads as 'other' (J3)."""
    return markets.select("market_id", F.coalesce(F.col("topic_primary"), F.lit("other")).alias("topic"))


def maker_filter(facts: DataFrame) -> DataFrame:
    """Ts > 0, lowercased maker non-empty, market non-empty.

    The filter is stated on the raw columns (lowercasing keeps a non-empty
    maker non-empty), so it reaches the Parquet scan of a fact table as
    pushed filters and row-group skipping on ts_unix.
    """
    f = facts.filter((F.col("ts_unix") > 0) & F.col("maker").isNotNull() & (F.col("maker") != "")
                     & F.col("market_id").isNotNull() & (F.col("market_id") != ""))
    return f.select("ts_unix", ascii_lower(F.col("maker")).alias("wallet"), "market_id",
                    F.coalesce(F.col("usd_amount"), F.lit(0.0)).alias("usd_amount"))


def _maker_rows(facts: DataFrame, markets: DataFrame) -> DataFrame:
    """P7 + J3: the rows that count, with their topic or 'other'."""
    j = maker_filter(facts).join(market_topics(markets), "market_id", "left")
    return j.withColumn("topic", F.coalesce(F.col("topic"), F.lit("other")))


def wallet_topic_volume(facts: DataFrame, markets: DataFrame, *, as_of: int,
                        periods: Sequence[int] = (7, 30, 90)) -> DataFrame:
    """Maker USD volume, trade count and share of wallet per (wallet, topic, period).

    A row counts in every trailing period whose cutoff ``as_of - N days`` it
    reaches (inclusive; no upper bound, so future rows count everywhere).
    """
    rows = _maker_rows(facts, markets)
    # A row's age band, the narrowest period that it lies in, so that a row
    # adds to one sum; the bands are summed up to periods afterwards
    spans = sorted(set(periods))
    band = F.lit(len(spans))
    for i in reversed(range(len(spans))):
        band = F.when(F.col("ts_unix") >= as_of - spans[i] * DAY, i).otherwise(band)
    bands = rows.groupBy("wallet", "topic", band.alias("band")).agg(
        F.sum(F.col("usd_amount").cast(SUM_TYPE)).alias("vol"), F.count(F.lit(1)).alias("n"))
    names = F.array(*[F.lit(f"{d}d") for d in spans], F.lit("all"))
    wide = bands.select("wallet", "topic", "vol", "n", F.explode(
        F.slice(names, F.col("band") + 1, len(spans) + 1)).alias("period"))
    # dealt out by what the window needs, which serves the sums as well
    agg = wide.repartition("wallet", "period").groupBy("wallet", "topic", "period").agg(
        F.sum("vol").cast(SUM_TYPE).alias("vol"), F.sum("n").alias("trade_count"))
    total = F.sum("vol").over(Window.partitionBy("wallet", "period"))
    return agg.select(
        F.col("wallet").alias("proxy_address"),
        F.col("topic").alias("topic_primary"),
        "period",
        F.col("vol").cast("double").alias("volume_usd"),
        "trade_count",
        F.when(total > 0, F.col("vol").cast("double") / total.cast("double")).alias("share_of_wallet"))


def global_daily(facts: DataFrame, markets: DataFrame, *, unique_wallets: str = "none") -> DataFrame:
    """D15 (+X4): per (UTC date, topic) maker volume and trade count.

    ``unique_wallets``: 'none' (NULL, as the reference writes), 'exact'
    (distinct lowercased makers; Spark's distinct aggregation shuffles on
    (date, topic, wallet) first, so a hot day is spread by wallet), or
    'approx' (HyperLogLog++ sketch, mergeable and fixed-size per group).
    """
    rows = _maker_rows(facts, markets).withColumn("stat_date", unix_to_date("ts_unix"))
    aggs = [F.sum(F.col("usd_amount").cast(SUM_TYPE)).cast("double").alias("volume_usd"),
            F.count(F.lit(1)).alias("trade_count")]
    if unique_wallets == "exact":
        aggs.append(F.countDistinct("wallet").cast("bigint").alias("unique_wallets"))
    elif unique_wallets == "approx":
        aggs.append(F.approx_count_distinct("wallet").cast("bigint").alias("unique_wallets"))
    elif unique_wallets == "none":
        aggs.append(F.lit(None).cast("bigint").alias("unique_wallets"))
    else:
        raise ValueError(f"unique_wallets must be none|exact|approx, got {unique_wallets!r}")
    return (rows.groupBy("stat_date", F.col("topic").alias("topic_primary")).agg(*aggs)
            .select("stat_date", "topic_primary", "volume_usd", "trade_count", "unique_wallets"))
