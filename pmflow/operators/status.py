"""Inspection queries: table counts, recent trades, FK check, status."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pmflow.sources.files import listing_status


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One (table_name, n) row per table; each count is a partial+final
    aggregate, the union is of one-row results."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def recent_trades(facts: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most recent trades; every column breaks ties so the pick
    is deterministic. The limit is the feature (a top-k inspection query)."""
    order = [F.col("ts_unix").desc()] + [F.col(c).desc() for c in facts.columns if c != "ts_unix"]
    return facts.orderBy(*order).limit(n)


def fk_violations(facts: DataFrame, markets: DataFrame) -> DataFrame:
    """Facts whose market_id is not in the market dimension, counted per market."""
    bad = facts.join(markets.select("market_id"), "market_id", "left_anti")
    return bad.groupBy("market_id").agg(F.count(F.lit(1)).alias("n"))


def status_report(listing: DataFrame, manifest: DataFrame | None, tables: dict[str, DataFrame]) -> DataFrame:
    """(section, name, value) rows: file counts and pending data files per
    directory of the raw store, then row counts of the tables."""
    files = listing_status(listing, manifest)
    file_rows = files.select(
        F.lit("files").alias("section"),
        F.explode(F.array(
            F.struct(F.concat(F.col("dir"), F.lit(":data_files")).alias("name"), F.col("data_files").alias("value")),
            F.struct(F.concat(F.col("dir"), F.lit(":sidecars")).alias("name"), F.col("sidecars").alias("value")),
            F.struct(F.concat(F.col("dir"), F.lit(":pending")).alias("name"), F.col("pending").alias("value")),
        )).alias("kv")).select("section", "kv.name", "kv.value")
    counts = table_counts(tables).select(F.lit("tables").alias("section"), F.col("table_name").alias("name"),
                                         F.col("n").alias("value"))
    return file_rows.unionByName(counts)
