"""Fixture views: reshape the driver's TPC-H-like tables into the raw inputs
the pipeline expects (markets, blocks, trades, JSON documents, activity
events, chain logs, file listings, landed HTTP responses).

Each view is one list of select expressions plus a FROM clause whose text is
valid in both Spark SQL and DuckDB, so the Spark job and the DuckDB oracle read
the same rows. In Spark the views are built with the DataFrame API
(``selectExpr``), so Catalyst prunes and pushes filters into the parquet scans.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed clock of the fixtures: last order date, 2001-08-01T00:00:00Z.
AS_OF = 996624000

MARKETS = [
    "CAST(p_partkey AS STRING) AS market_id",
    "CAST(p_partkey*2+1 AS STRING) AS token1",
    "CASE WHEN p_partkey % 50 = 7 THEN '' ELSE CAST(p_partkey*2+2 AS STRING) END AS token2",
    "CASE CAST(p_partkey % 12 AS INT) WHEN 0 THEN 'NBA Finals' WHEN 1 THEN 'US-current-affairs' "
    "WHEN 2 THEN 'Tech' WHEN 3 THEN ' Crypto_Prices ' WHEN 4 THEN 'us election' WHEN 5 THEN 'Middle East' "
    "WHEN 6 THEN 'Fed rates' WHEN 7 THEN 'Pop_Culture' WHEN 8 THEN 'Hurricane season' WHEN 9 THEN 'AI' "
    "WHEN 10 THEN '' ELSE NULL END AS category_raw",
]

BLOCKS = [
    "o_orderkey AS block_number",
    "replace(substr(CAST(o_orderdate AS STRING),1,19),' ','T') || 'Z' AS timestamp",
]
BLOCKS_WHERE = "o_orderkey % 97 <> 0"

TRADES = [
    "l_orderkey AS block_number",
    "CAST(l_linenumber AS BIGINT) AS log_index",
    "'0x' || lpad(CAST(l_orderkey AS STRING),64,'0') AS transaction_hash",
    "'0x' || lpad(CAST(l_orderkey*10+l_linenumber AS STRING),64,'0') AS order_hash",
    "CASE WHEN l_linenumber=7 THEN '' ELSE (CASE WHEN l_linenumber % 2 = 0 THEN '0xA' ELSE '0xa' END) "
    "|| lpad(CAST(o_custkey AS STRING),39,'0') END AS maker",
    "'0xB' || lpad(CAST(l_suppkey AS STRING),39,'0') AS taker",
    "CASE WHEN l_linenumber % 2 = 0 THEN '0' ELSE CAST(l_partkey*2+1+l_suppkey%2 AS STRING) END AS maker_asset_id",
    "CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_partkey*2+1+l_suppkey%2 AS STRING) ELSE '0' END AS taker_asset_id",
    "CAST(CAST(CASE WHEN l_linenumber % 2 = 0 THEN round(l_extendedprice*1000000) ELSE l_quantity*1000000 END "
    "AS BIGINT) AS STRING) AS maker_amount",
    "CAST(CAST(CASE WHEN l_linenumber % 2 = 0 THEN l_quantity*1000000 ELSE round(l_extendedprice*1000000) END "
    "AS BIGINT) AS STRING) AS taker_amount",
]

MARKETS_JSON = [
    "'{\"id\":' || CASE WHEN p_partkey % 40 = 3 THEN CAST(p_partkey AS STRING) "
    "ELSE '\"' || CAST(p_partkey AS STRING) || '\"' END "
    "|| ',\"question\":\"' || p_name || '\",\"slug\":\"' || replace(p_name,' ','-') || '\",\"outcomes\":' "
    "|| CASE WHEN p_partkey % 2 = 0 THEN '[\"Yes\",\"No\"]' "
    "ELSE '\"[' || chr(92) || '\"Yes' || chr(92) || '\",' || chr(92) || '\"No' || chr(92) || '\"]\"' END "
    "|| ',\"clobTokenIds\":[\"' || CAST(p_partkey*2+1 AS STRING) || '\",\"' || CAST(p_partkey*2+2 AS STRING) || '\"]' "
    "|| CASE WHEN p_partkey % 3 = 0 THEN ',\"negRiskOther\":true' ELSE '' END "
    "|| ',\"volume\":\"' || CAST(p_size AS STRING) || '.25\",\"createdAt\":\"2024-01-01T00:00:00Z\","
    "\"events\":[{\"ticker\":\"' || p_brand || '\"}]}' AS doc",
]

ACTIVITIES = [
    "'0x' || lpad(CAST(user_id AS STRING),40,'0') AS proxy",
    "'{\"type\":\"' || CASE WHEN event_type='purchase' THEN 'trade' WHEN event_type='click' THEN 'redeem' "
    "ELSE event_type END "
    "|| '\",\"timestamp\":\"' || CASE WHEN event_id % 3 = 0 THEN CAST(1704067200 + event_id AS STRING) "
    "ELSE '2024-01-' || lpad(CAST(event_id % 28 + 1 AS STRING),2,'0') || 'T00:00:00Z' END "
    "|| '\"' || CASE WHEN event_id % 5 = 0 THEN '' ELSE ',\"transactionHash\":\"0x' "
    "|| lpad(CAST(event_id % 500 AS STRING),64,'0') || '\"' END "
    "|| CASE WHEN event_id % 2 = 0 THEN ',\"usdcSize\":' || CAST(event_id AS STRING) || '.5' "
    "ELSE ',\"size\":\"' || CAST(event_id AS STRING) || '\"' END "
    "|| ',\"blockNumber\":' || CAST(event_id AS STRING) || '}' AS event",
    "event_id AS event_seq",
]

LOGS = [
    "'0x' || lower(hex(l_orderkey)) AS blocknumber",
    "'0x' || lower(hex(CAST(l_linenumber AS BIGINT))) AS logindex",
    "'0x' || lpad(CAST(l_orderkey AS STRING),64,'0') AS transactionhash",
    "'0x' || lpad(lower(hex(l_suppkey)),64,'0') AS topic2",
    "'0x' || lpad('',64,'0') || lpad(lower(hex(l_partkey*2+1)),64,'0') "
    "|| lpad(lower(hex(CAST(round(l_extendedprice*1000000) AS BIGINT))),64,'0') "
    "|| lpad(lower(hex(CAST(l_quantity*1000000 AS BIGINT))),64,'0') || lpad('0',64,'0') AS data",
]

# File listing of the raw store, one trade file per order key (10-block chunks,
# unpadded numbers so lexicographic order differs from numeric), a sidecar
# copy ('._' prefix) for 1 in 13, and an orphan sidecar for 1 in 29.
FILES = [
    "CASE WHEN o_orderkey % 29 = 0 THEN 'exchange/trades/._trades_' ELSE 'exchange/trades/trades_' END "
    "|| CAST(o_orderkey*10 AS STRING) || '_' || CAST(o_orderkey*10+9 AS STRING) || '.parquet' AS key",
    "CAST(round(o_totalprice) AS BIGINT) AS size",
]
SIDECARS = [
    "'exchange/trades/._trades_' || CAST(o_orderkey*10 AS STRING) || '_' || CAST(o_orderkey*10+9 AS STRING) "
    "|| '.parquet' AS key",
    "CAST(4096 AS BIGINT) AS size",
]
SIDECARS_WHERE = "o_orderkey % 13 = 0 AND o_orderkey % 29 <> 0"

# Landed enrichment responses (one per market of 1 in 3 parts): 200 with a
# category, 200 with an unusable body, 429, 500, and request errors.
ENRICH_RESPONSES = [
    "CAST(p_partkey AS STRING) AS market_id",
    "CASE WHEN p_partkey % 7 = 0 THEN CAST(NULL AS INT) WHEN p_partkey % 11 = 0 THEN 429 "
    "WHEN p_partkey % 13 = 0 THEN 500 ELSE 200 END AS http_status",
    "CASE WHEN p_partkey % 17 = 0 THEN 'not json' ELSE '{\"category\":\"' || p_type || '\"}' END AS body",
    "CASE WHEN p_partkey % 7 = 0 THEN 'connect timeout' ELSE CAST(NULL AS STRING) END AS error",
]
ENRICH_RESPONSES_WHERE = "p_partkey % 3 = 0"

# Raw markets parquet with aliased columns (slug empty for 1 in 5 so the
# market_slug alias is used; neg_risk NULL for 1 in 4).
MARKETS_PARQUET = [
    "CAST(p_partkey AS STRING) AS market_id",
    "'0x' || lpad(CAST(p_partkey AS STRING),64,'0') AS condition_id",
    "CASE WHEN p_partkey % 5 = 0 THEN '' ELSE lower(replace(p_name,' ','-')) END AS slug",
    "replace(p_name,' ','_') AS market_slug",
    "p_name AS title",
    "'[\"Yes\",\"No\"]' AS outcomes",
    "'[\"' || CAST(p_partkey*2+1 AS STRING) || '\",\"' || CAST(p_partkey*2+2 AS STRING) || '\"]' AS clob_token_ids",
    "CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_partkey % 3 = 0 END AS neg_risk",
    "CAST(p_size AS STRING) || '.5' AS volume",
    "'2024-02-' || lpad(CAST(p_partkey % 28 + 1 AS STRING),2,'0') || 'T12:00:00Z' AS created_at",
]

# Enrichment state of the market dimension: 1 in 5 fetched, 1 in 5 failed
# earlier with 0..3 attempts at various ages (unix seconds).
ENRICH_STATE = [
    "CAST(p_partkey AS STRING) AS market_id",
    "p_type AS category_seed",
    "CASE WHEN p_partkey % 5 = 0 THEN 990000000 END AS fetched_unix",
    "CASE WHEN p_partkey % 5 = 1 THEN 996624000 - (p_partkey % 9) * 1000 END AS failed_unix",
    "CAST(CASE WHEN p_partkey % 5 = 1 THEN p_partkey % 4 ELSE 0 END AS INT) AS attempts",
    "CASE WHEN p_partkey % 5 = 1 THEN 'http status 500 Internal Server Error' END AS last_error",
]

# Landed wallet API responses keyed by the maker addresses of fx_trades.
WALLET_STATS = [
    "'0xa' || lpad(CAST(c_custkey AS STRING),39,'0') AS proxy_address",
    "CASE WHEN c_custkey % 9 = 0 THEN 'not json' "
    "ELSE '{\"volume\":' || CAST(CAST(round(c_acctbal*100) AS BIGINT) AS STRING) || '}' END AS body",
]
WALLET_PNL = [
    "'0xa' || lpad(CAST(c_custkey AS STRING),39,'0') AS proxy_address",
    "'[{\"t\":1,\"p\":' || CAST(c_nationkey AS STRING) || '}]' AS body",
]
WALLET_PNL_WHERE = "c_custkey % 4 <> 0"
WALLET_PROFILE = [
    "'0xa' || lpad(CAST(c_custkey AS STRING),39,'0') AS proxy_address",
    "'{\"name\":\"' || c_name || '\",\"segment\":\"' || c_mktsegment || '\"}' AS body",
]

FIXTURE_COLUMNS = {
    "fx_markets": (MARKETS, "part", None),
    "fx_blocks": (BLOCKS, "orders", BLOCKS_WHERE),
    "fx_trades": (TRADES, "lineitem JOIN orders ON l_orderkey=o_orderkey", None),
    "fx_markets_json": (MARKETS_JSON, "part", None),
    "fx_activities": (ACTIVITIES, "events", None),
    "fx_logs": (LOGS, "lineitem", None),
    "fx_files": (FILES, "orders", None),
    "fx_sidecars": (SIDECARS, "orders", SIDECARS_WHERE),
    "fx_enrich_responses": (ENRICH_RESPONSES, "part", ENRICH_RESPONSES_WHERE),
    "fx_markets_parquet": (MARKETS_PARQUET, "part", None),
    "fx_enrich_state": (ENRICH_STATE, "part", None),
    "fx_wallet_stats": (WALLET_STATS, "customer", None),
    "fx_wallet_pnl": (WALLET_PNL, "customer", WALLET_PNL_WHERE),
    "fx_wallet_profile": (WALLET_PROFILE, "customer", None),
}


# Raw views with per-row parsing downstream (trades, logs, activity bodies,
# blocks, market documents): landed as multi-file parquet once per session.
# Each with the key by which its source rows are dealt out to the files.
LANDED = {"fx_trades": "l_orderkey", "fx_logs": "l_orderkey", "fx_activities": "event_id", "fx_blocks": "o_orderkey",
          "fx_markets_json": "p_partkey"}
#: Views of long, mostly padded text.
WIDE = {"fx_trades", "fx_logs"}
_LANDED_PATHS: dict[tuple, str] = {}


def fixture_sql(name: str) -> str:
    cols, frm, where = FIXTURE_COLUMNS[name]
    sql = "SELECT " + ",\n ".join(cols) + "\nFROM " + frm
    if where:
        sql += "\nWHERE " + where
    return sql


def with_ctes(body: str, *names: str) -> str:
    """Prefix an oracle query with the fixture views it uses, as CTEs."""
    ctes = ",\n".join(f"{n} AS (\n{fixture_sql(n)}\n)" for n in names)
    return f"WITH {ctes}\n{body}" if names else body


class Tables:
    """Lazy access to the driver tables and the fixture views of one sf dir."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    def fixture(self, name: str) -> DataFrame:
        cols, frm, where = FIXTURE_COLUMNS[name]
        src = self.table("lineitem" if name == "fx_trades" else frm)
        if name in LANDED:
            src = src.hint("rebalance", LANDED[name])
        if name == "fx_trades":
            o = self.table("orders")
            src = src.join(o, src.l_orderkey == o.o_orderkey, "inner")
        if where:
            src = src.filter(F.expr(where))
        out = src.selectExpr(*cols)
        if name in LANDED:
            return self._landed(name, out)
        return out

    def _landed(self, name: str, view: DataFrame) -> DataFrame:
        """Raw inputs arrive as many files in a landing folder. The driver's
        parquet files are a single row group (one scan task), so the raw views
        are landed once per session as multi-file parquet under the shared
        checkpoint folder and read back: scans, pushed-down filters and the
        per-row parsing then run in parallel, as they do on landed data.

        What is dealt out are the tables' narrow rows, by key; the wide text
        rows are made where they are written, and neither shuffled nor sorted.
        The files' number goes by the size of the data."""
        from pmflow.session import checkpoint_root
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        path = _LANDED_PATHS.get(key)
        if path is None:
            path = f"{checkpoint_root(self.spark)}/landing/{uuid.uuid4().hex[:12]}/{name}"
            out = view.write.mode("overwrite")
            (out.option("compression", "zstd") if name in WIDE else out).parquet(path)
            _LANDED_PATHS[key] = path
        return self.spark.read.parquet(path)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("fx_"):
            return self.fixture(name)
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)
