"""Registered queries (Spark) and their DuckDB oracle SQL.

Each query reads the driver tables of ``sf_dir`` through the fixture views
(``pmflow.sources.fixtures``) and runs the library job over whole tables.
Column names and types are chosen so both engines produce comparable values:
dates and timestamps are emitted as text, sums as DOUBLE from exact decimals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pmflow.functions.taxonomy import normalize_key, topic_case_sql, topic_of
from pmflow.operators import aggregates as agg
from pmflow.operators import markets as mk
from pmflow.operators import trades as tr
from pmflow.sources.fixtures import AS_OF, Tables, with_ctes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# ----------------------------------------------------------------- shared inputs

def _dim(t: Tables) -> DataFrame:
    return mk.dim_from_categories(t.fx_markets)


def _inputs(spark: SparkSession, sf_dir: str):
    t = Tables(spark, sf_dir)
    return t, tr.block_times(t.fx_blocks), tr.token_map(t.fx_markets)


def facts_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, bt, tm = _inputs(spark, sf_dir)
    facts, _ = tr.build_fact_trades(t.fx_trades, bt, tm)
    return facts


# Oracle building blocks (DuckDB). The fixture views come in as CTEs.
def _topic_sql(col: str) -> str:
    return topic_case_sql(f"regexp_replace(lower(trim({col}, ' \t\n\r')), '[\\s_]', '-', 'g')")


_TOPIC_SQL = _topic_sql("category_raw")
_ORACLE_DIM = f"""dim AS (
  SELECT market_id, token1, token2, category_raw,
    CASE WHEN category_raw IS NULL OR trim(category_raw, ' \t\n\r') = '' THEN 'other' ELSE {_TOPIC_SQL} END
      AS topic_primary
  FROM fx_markets)"""
_ORACLE_BT = """bt AS (
  SELECT block_number, max(CAST(epoch(strptime(timestamp, '%Y-%m-%dT%H:%M:%SZ')) AS BIGINT)) AS ts_unix
  FROM fx_blocks GROUP BY block_number)"""
_ORACLE_TM = """tok AS (
  SELECT market_id, token1 AS asset_id, 'token1' AS side FROM fx_markets WHERE token1 <> '' AND token2 <> ''
  UNION ALL
  SELECT market_id, token2 AS asset_id, 'token2' AS side FROM fx_markets WHERE token1 <> '' AND token2 <> ''),
tm AS (
  SELECT asset_id, market_id, side FROM (
    SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY market_id DESC, side DESC) AS rn FROM tok)
  WHERE rn = 1)"""
_ORACLE_CLASSIFY = """ct AS (
  SELECT tr.*, bt.ts_unix AS bts,
    CASE WHEN maker_asset_id <> '0' THEN maker_asset_id ELSE taker_asset_id END AS asset_id
  FROM fx_trades tr LEFT JOIN bt USING (block_number)),
cm AS (
  SELECT ct.*, tm.market_id, tm.side,
    TRY_CAST(maker_amount AS DECIMAL(38,6)) AS ma, TRY_CAST(taker_amount AS DECIMAL(38,6)) AS ta
  FROM ct LEFT JOIN tm USING (asset_id)),
cd AS (
  SELECT *, CASE WHEN taker_asset_id = '0' THEN ma ELSE ta END AS denom,
    CASE WHEN taker_asset_id = '0' THEN ta ELSE ma END AS numer FROM cm),
classified AS (
  SELECT *,
    CASE WHEN bts IS NULL OR bts <= 0 THEN 'no_block'
      WHEN maker = '' OR taker = '' OR transaction_hash = '' THEN 'empty_field'
      WHEN ma IS NULL OR ta IS NULL THEN 'bad_amount'
      WHEN market_id IS NULL THEN 'no_market'
      WHEN denom = 0 THEN 'zero_denominator'
      WHEN CAST(numer AS DOUBLE) / CAST(denom AS DOUBLE) <= 0 THEN 'non_positive_price' END AS reject_reason
  FROM cd),
facts AS (
  SELECT bts AS ts_unix, market_id, maker, taker,
    CASE WHEN maker_asset_id = '0' AND taker_asset_id = '0' THEN 'USDC' ELSE side END AS nonusdc_side,
    CASE WHEN taker_asset_id = '0' THEN 'SELL' ELSE 'BUY' END AS maker_direction,
    CASE WHEN taker_asset_id = '0' THEN 'BUY' ELSE 'SELL' END AS taker_direction,
    CAST(numer AS DOUBLE) / CAST(denom AS DOUBLE) AS price,
    CAST(CASE WHEN taker_asset_id = '0' THEN ta ELSE ma END AS DOUBLE) / 1000000.0 AS usd_amount,
    CAST(CASE WHEN taker_asset_id = '0' THEN ma ELSE ta END AS DOUBLE) / 1000000.0 AS token_amount,
    transaction_hash, order_hash, log_index
  FROM classified WHERE reject_reason IS NULL)"""


def _facts_ctes(*extra: str) -> list[str]:
    return [_ORACLE_BT, _ORACLE_TM, _ORACLE_CLASSIFY, *extra]


def oracle(body: str, fixtures: tuple[str, ...], ctes: list[str]) -> str:
    """Compose oracle SQL: fixture views, then named CTEs, then the body."""
    base = with_ctes("SELECT 1", *fixtures)
    head = base[: -len("SELECT 1")].rstrip()
    if ctes:
        head = head + ",\n" + ",\n".join(ctes) if fixtures else "WITH " + ",\n".join(ctes)
    return head + "\n" + body


_FX_TRADES = ("fx_markets", "fx_blocks", "fx_trades")

# ----------------------------------------------------------------- taxonomy


@query("normalize_key", oracle(
    "SELECT market_id, category_raw, "
    "regexp_replace(lower(trim(category_raw, ' \t\n\r')), '[\\s_]', '-', 'g') AS normalized_key FROM fx_markets",
    ("fx_markets",), []))
def q_normalize_key(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.fx_markets.select("market_id", "category_raw",
                               normalize_key(F.col("category_raw")).alias("normalized_key"))


@query("topic_rollup", oracle(
    "SELECT market_id, category_raw, topic_primary FROM dim", ("fx_markets",), [_ORACLE_DIM]))
def q_topic_rollup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return t.fx_markets.select("market_id", "category_raw", topic_of(F.col("category_raw")).alias("topic_primary"))


# ----------------------------------------------------------------- lookups


@query("block_times", oracle("SELECT block_number, ts_unix FROM bt", ("fx_blocks",), [_ORACLE_BT]))
def q_block_times(spark, sf_dir):
    return tr.block_times(Tables(spark, sf_dir).fx_blocks)


@query("token_map", oracle("SELECT asset_id, market_id, side FROM tm", ("fx_markets",), [_ORACLE_TM]))
def q_token_map(spark, sf_dir):
    return tr.token_map(Tables(spark, sf_dir).fx_markets)


# ----------------------------------------------------------------- trade facts


@query("fact_trades", oracle("SELECT * FROM facts", _FX_TRADES, _facts_ctes()))
def q_fact_trades(spark, sf_dir):
    return facts_of(spark, sf_dir)


@query("fact_trades_rejects", oracle(
    "SELECT reject_reason, count(*) AS n FROM classified WHERE reject_reason IS NOT NULL GROUP BY reject_reason",
    _FX_TRADES, _facts_ctes()))
def q_fact_trades_rejects(spark, sf_dir):
    t, bt, tm = _inputs(spark, sf_dir)
    _, rejects = tr.build_fact_trades(t.fx_trades, bt, tm)
    return tr.reject_counts(rejects)


@query("fact_trades_dedup", oracle(
    """SELECT ts_unix, market_id, maker, taker, nonusdc_side, maker_direction, taker_direction, price,
      usd_amount, token_amount, transaction_hash, order_hash, log_index FROM (
      SELECT *, row_number() OVER (PARTITION BY transaction_hash, log_index ORDER BY ts_unix, market_id, maker,
        taker, nonusdc_side, maker_direction, taker_direction, price, usd_amount, token_amount, order_hash) AS rn
      FROM facts) WHERE rn = 1""", _FX_TRADES, _facts_ctes()))
def q_fact_trades_dedup(spark, sf_dir):
    return tr.dedupe_facts(facts_of(spark, sf_dir))


# ----------------------------------------------------------------- rollups

_ORACLE_MAKER_ROWS = """mrows AS (
  SELECT f.ts_unix, lower(f.maker) AS wallet, f.market_id, f.usd_amount,
    coalesce(d.topic_primary, 'other') AS topic
  FROM facts f LEFT JOIN dim d USING (market_id)
  WHERE f.ts_unix > 0 AND f.maker <> '' AND f.market_id <> '')"""


def _wallet_topic_sql() -> str:
    p = [("all", None), ("7d", AS_OF - 7 * 86400), ("30d", AS_OF - 30 * 86400), ("90d", AS_OF - 90 * 86400)]
    union = "\n  UNION ALL\n  ".join(
        f"SELECT wallet, topic, usd_amount, '{name}' AS period FROM mrows"
        + ("" if cut is None else f" WHERE ts_unix >= {cut}") for name, cut in p)
    return f"""per AS (
  {union}),
g AS (
  SELECT wallet, period, topic, sum(CAST(usd_amount AS DECIMAL(38,6))) AS vol, count(*) AS trade_count
  FROM per GROUP BY wallet, period, topic)"""


@query("wallet_topic_volume", oracle(
    """SELECT wallet AS proxy_address, topic AS topic_primary, period, CAST(vol AS DOUBLE) AS volume_usd,
      trade_count,
      CASE WHEN sum(vol) OVER (PARTITION BY wallet, period) > 0
        THEN CAST(vol AS DOUBLE) / CAST(sum(vol) OVER (PARTITION BY wallet, period) AS DOUBLE) END
        AS share_of_wallet
    FROM g""", ("fx_markets", "fx_blocks", "fx_trades"),
    _facts_ctes(_ORACLE_DIM, _ORACLE_MAKER_ROWS, _wallet_topic_sql())))
def q_wallet_topic_volume(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return agg.wallet_topic_volume(facts_of(spark, sf_dir), _dim(t), as_of=AS_OF)


def _global_daily_sql(unique: str) -> str:
    return f"""SELECT CAST(CAST(epoch_ms(ts_unix * 1000) AS DATE) AS VARCHAR) AS stat_date,
      topic AS topic_primary, CAST(sum(CAST(usd_amount AS DECIMAL(38,6))) AS DOUBLE) AS volume_usd,
      count(*) AS trade_count, {unique} AS unique_wallets
    FROM mrows GROUP BY 1, 2"""


@query("global_daily", oracle(_global_daily_sql("CAST(NULL AS BIGINT)"), _FX_TRADES,
                              _facts_ctes(_ORACLE_DIM, _ORACLE_MAKER_ROWS)))
def q_global_daily(spark, sf_dir):
    t = Tables(spark, sf_dir)
    g = agg.global_daily(facts_of(spark, sf_dir), _dim(t))
    return g.withColumn("stat_date", F.col("stat_date").cast("string"))


@query("global_daily_unique", oracle(_global_daily_sql("count(DISTINCT wallet)"), _FX_TRADES,
                                     _facts_ctes(_ORACLE_DIM, _ORACLE_MAKER_ROWS)))
def q_global_daily_unique(spark, sf_dir):
    t = Tables(spark, sf_dir)
    g = agg.global_daily(facts_of(spark, sf_dir), _dim(t), unique_wallets="exact")
    return g.withColumn("stat_date", F.col("stat_date").cast("string"))


# ----------------------------------------------------------------- helpers for text output

def ts_text(c) -> "F.Column":
    """TIMESTAMP -> 'YYYY-MM-DD HH:MM:SS' (both engines print it the same)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _duck_ts(unix_sql: str) -> str:
    return f"strftime(epoch_ms(CAST({unix_sql} AS BIGINT) * 1000), '%Y-%m-%d %H:%M:%S')"


_TOTAL_ORDER_SQL = ("block_number, log_index, transaction_hash, order_hash, maker, taker, maker_asset_id, "
                    "taker_asset_id, maker_amount, taker_amount")

# ----------------------------------------------------------------- staged / keyed facts

from pmflow.operators import wallets as wl  # noqa: E402
from pmflow.operators import activities as act  # noqa: E402
from pmflow.operators import enrich as en  # noqa: E402


@query("staging_orders", oracle(
    f"""SELECT timestamp_i64, maker, maker_asset_id, maker_amount_filled, taker, taker_asset_id,
      taker_amount_filled, transaction_hash FROM (
      SELECT *, row_number() OVER (PARTITION BY transaction_hash, maker, taker, timestamp_i64, maker_asset_id,
        taker_asset_id ORDER BY {_TOTAL_ORDER_SQL}) AS rn
      FROM (SELECT tr.*, coalesce(bt.ts_unix, 0) AS timestamp_i64, maker_amount AS maker_amount_filled,
              taker_amount AS taker_amount_filled
            FROM fx_trades tr LEFT JOIN bt USING (block_number)
            WHERE maker <> '' AND taker <> '' AND transaction_hash <> '') s) WHERE rn = 1""",
    ("fx_blocks", "fx_trades"), [_ORACLE_BT]))
def q_staging_orders(spark, sf_dir):
    t, bt, _ = _inputs(spark, sf_dir)
    return tr.build_staging(t.fx_trades, bt).select(*tr.STAGING_COLUMNS)


_KEYED_OUT = ("ts_unix, market_id, maker, taker, nonusdc_side, maker_direction, taker_direction, price_text, "
              "usd_amount, token_amount, transaction_hash, source")


def _keyed_exact_sql() -> str:
    """Exact texts over kc: amounts with six places; the price by long division in
    whole numbers, to as many places as leave 96 bits, half to even."""
    out = """kw AS (
  SELECT *, CAST(denom AS HUGEINT) AS d, CAST(numer AS HUGEINT) // CAST(denom AS HUGEINT) AS i,
    ((CAST(numer AS HUGEINT) % CAST(denom AS HUGEINT)) * 100000000000000) // CAST(denom AS HUGEINT) AS f1,
    ((CAST(numer AS HUGEINT) % CAST(denom AS HUGEINT)) * 100000000000000) % CAST(denom AS HUGEINT) AS r1
  FROM kc WHERE denom <> 0),
kp AS (SELECT *, least(28, 29 - length(CAST(i AS VARCHAR))) AS most FROM kw)"""
    for name, src, places in (("kx", "kp", "most"), ("ky", "kx", "most - 1")):
        scaled = f"(r1 * {_pow(f'({places}) - 14')})"
        m = f"i * {_pow(places)} + f1 * {_pow(f'({places}) - 14')} + {scaled} // d"
        out += f""",
{name}0 AS (SELECT *, {m} AS m_{name}, {scaled} % d AS r_{name} FROM {src}),
{name} AS (SELECT * REPLACE (m_{name} + CASE WHEN 2 * r_{name} > d OR (2 * r_{name} = d AND m_{name} % 2 = 1)
    THEN 1 ELSE 0 END AS m_{name}) FROM {name}0)"""
    out += """,
kz AS (
  SELECT *, CASE WHEN m_kx <= 79228162514264337593543950335 THEN m_kx ELSE m_ky END AS m,
    CASE WHEN m_kx <= 79228162514264337593543950335 THEN most ELSE most - 1 END AS places FROM ky)"""
    return out


def _pow(places: str) -> str:
    """10 to a whole power as HUGEINT (a DOUBLE power would round)."""
    return f"CAST('1' || repeat('0', CAST({places} AS INT)) AS HUGEINT)"


def _six(raw: str) -> str:
    return (f"CAST(CAST({raw} AS HUGEINT) // 1000000 AS VARCHAR) || '.' || "
            f"lpad(CAST(CAST({raw} AS HUGEINT) % 1000000 AS VARCHAR), 6, '0')")


def _keyed_sql(src: str) -> str:
    """Keyed derivation + (tx, maker, taker, ts) first-wins over a staged CTE ``src``
    with columns ts_unix, maker, taker, transaction_hash, asset ids, amounts and the order columns."""
    return f"""km AS (
  SELECT k.*, tm.market_id, tm.side, TRY_CAST(maker_amount AS DECIMAL(38,6)) AS ma,
    TRY_CAST(taker_amount AS DECIMAL(38,6)) AS ta
  FROM (SELECT *, CASE WHEN maker_asset_id <> '0' THEN maker_asset_id ELSE taker_asset_id END AS asset_id
        FROM {src}) k JOIN tm USING (asset_id)),
kc AS (
  SELECT *, CASE WHEN taker_asset_id = '0' THEN ma ELSE ta END AS denom,
    CASE WHEN taker_asset_id = '0' THEN ta ELSE ma END AS numer
  FROM km WHERE ma IS NOT NULL AND ta IS NOT NULL),
{_keyed_exact_sql()},
kf AS (
  SELECT ts_unix, market_id, maker, taker,
    CASE WHEN maker_asset_id = '0' AND taker_asset_id = '0' THEN 'USDC' ELSE side END AS nonusdc_side,
    CASE WHEN taker_asset_id = '0' THEN 'SELL' ELSE 'BUY' END AS maker_direction,
    CASE WHEN taker_asset_id = '0' THEN 'BUY' ELSE 'SELL' END AS taker_direction,
    rtrim(rtrim(CAST(m // {_pow('places')} AS VARCHAR) || '.'
      || lpad(CAST(m % {_pow('places')} AS VARCHAR), CAST(places AS INT), '0'), '0'), '.') AS price_text,
    {_six("CASE WHEN taker_asset_id = '0' THEN ta ELSE ma END")} AS usd_amount,
    {_six("CASE WHEN taker_asset_id = '0' THEN ma ELSE ta END")} AS token_amount,
    transaction_hash, 'batch_pipeline' AS source, {_TOTAL_ORDER_SQL.replace('maker, taker, ', '')
                                                         .replace('transaction_hash, ', '')
                                                         .replace('maker_asset_id, taker_asset_id, ', '')}
    , maker_asset_id, taker_asset_id
  FROM kz),
keyed AS (
  SELECT {_KEYED_OUT} FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_hash, maker, taker, ts_unix
      ORDER BY {_TOTAL_ORDER_SQL}) AS rn FROM kf) WHERE rn = 1)"""


def _keyed_out(keyed: DataFrame) -> DataFrame:
    """Exact values as text: both engines print them alike."""
    return keyed.drop("price").withColumns({c: F.col(c).cast("decimal(38,6)").cast("string")
                                            for c in ("usd_amount", "token_amount")})


@query("fact_trades_keyed", oracle(
    f"SELECT {_KEYED_OUT} FROM keyed", _FX_TRADES,
    [_ORACLE_BT, _ORACLE_TM, """direct AS (
  SELECT tr.*, bt.ts_unix FROM fx_trades tr JOIN bt USING (block_number)
  WHERE bt.ts_unix > 0 AND maker <> '' AND taker <> '' AND transaction_hash <> '')""", _keyed_sql("direct")]))
def q_fact_trades_keyed(spark, sf_dir):
    t, bt, tm = _inputs(spark, sf_dir)
    return _keyed_out(tr.build_fact_trades_direct(t.fx_trades, bt, tm, path=scratch_path(spark, "keyed")))


@query("fact_trades_staged", oracle(
    f"SELECT {_KEYED_OUT} FROM keyed", _FX_TRADES,
    [_ORACLE_BT, _ORACLE_TM, f"""staged AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT s.*, row_number() OVER (PARTITION BY transaction_hash, maker, taker, ts_unix, maker_asset_id,
      taker_asset_id ORDER BY {_TOTAL_ORDER_SQL}) AS rn
    FROM (SELECT tr.*, coalesce(bt.ts_unix, 0) AS ts_unix FROM fx_trades tr LEFT JOIN bt USING (block_number)
          WHERE maker <> '' AND taker <> '' AND transaction_hash <> '') s) WHERE rn = 1)""",
     _keyed_sql("staged")]))
def q_fact_trades_staged(spark, sf_dir):
    """D4 then D5: the staged path (unresolved block time kept as 0)."""
    t, bt, tm = _inputs(spark, sf_dir)
    staged = tr.build_staging(t.fx_trades, bt, path=scratch_path(spark, "staging"))
    return _keyed_out(tr.build_fact_trades_keyed(staged, tm, path=scratch_path(spark, "keyed")))


# ----------------------------------------------------------------- wallets

_ORACLE_WALLETS = """wa AS (
  SELECT lower(maker) AS a, ts_unix FROM facts WHERE ts_unix > 0 AND maker <> ''
  UNION ALL SELECT lower(taker) AS a, ts_unix FROM facts WHERE ts_unix > 0 AND taker <> ''),
wl AS (
  SELECT a AS proxy_address, min(ts_unix) AS f, max(ts_unix) AS l FROM wa
  WHERE regexp_full_match(a, '0x[a-fA-F0-9]{40}') GROUP BY a)"""
_WALLET_OUT = (f"SELECT proxy_address, {_duck_ts('f')} AS first_seen_at, {_duck_ts('l')} AS last_seen_at FROM wl")
WALLET_SPLIT = 852076800  # 1997-01-01: facts before it are the stored wallets, the rest arrive


def _wallets_text(w):
    return w.select("proxy_address", ts_text("first_seen_at").alias("first_seen_at"),
                    ts_text("last_seen_at").alias("last_seen_at"))


def wallets_from(facts):
    w, _ = wl.merge_wallets(None, wl.wallet_activity(facts))
    return w


def wallets_of(spark, sf_dir):
    return wallets_from(facts_of(spark, sf_dir))


@query("wallet_first_last", oracle(_WALLET_OUT, _FX_TRADES, _facts_ctes(_ORACLE_WALLETS)))
def q_wallet_first_last(spark, sf_dir):
    return _wallets_text(wallets_of(spark, sf_dir))


@query("wallet_merge", oracle(_WALLET_OUT, _FX_TRADES, _facts_ctes(_ORACLE_WALLETS)))
def q_wallet_merge(spark, sf_dir):
    """Wallets stored from older facts, merged with the newer facts."""
    f = facts_of(spark, sf_dir)
    stored, _ = wl.merge_wallets(None, wl.wallet_activity(f.filter(F.col("ts_unix") < WALLET_SPLIT)))
    merged, _ = wl.merge_wallets(stored, wl.wallet_activity(f.filter(F.col("ts_unix") >= WALLET_SPLIT)))
    return _wallets_text(merged)


@query("wallet_quarantine", oracle(
    """SELECT address, count(*) AS n FROM (
      SELECT maker AS address FROM fx_trades UNION ALL SELECT taker AS address FROM fx_trades)
    WHERE NOT regexp_full_match(address, '0x[a-fA-F0-9]{40}') GROUP BY address""", ("fx_trades",), []))
def q_wallet_quarantine(spark, sf_dir):
    return wl.address_check(Tables(spark, sf_dir).fx_trades, ["maker", "taker"])


_ORACLE_TARGETS = """tg AS (
  SELECT lower(trim(proxy_address)) AS proxy_address,
    row_number() OVER (ORDER BY l DESC, proxy_address) AS rk
  FROM wl ORDER BY l DESC, proxy_address LIMIT 200)"""


@query("snapshot_targets", oracle("SELECT proxy_address FROM tg", _FX_TRADES,
                                  _facts_ctes(_ORACLE_WALLETS, _ORACLE_TARGETS)))
def q_snapshot_targets(spark, sf_dir):
    return wl.snapshot_targets(wallets_of(spark, sf_dir), n=200)


_ORACLE_SNAP = """sides AS (
  SELECT tg.proxy_address, tg.rk,
    (SELECT max(body) FROM fx_wallet_stats s WHERE s.proxy_address = tg.proxy_address AND json_valid(s.body))
      AS user_stats_json,
    (SELECT max(body) FROM fx_wallet_pnl s WHERE s.proxy_address = tg.proxy_address AND json_valid(s.body))
      AS user_pnl_json,
    (SELECT max(body) FROM fx_wallet_profile s WHERE s.proxy_address = tg.proxy_address AND json_valid(s.body))
      AS gamma_profile_json
  FROM tg)"""
_SNAP_FX = (*_FX_TRADES, "fx_wallet_stats", "fx_wallet_pnl", "fx_wallet_profile")


def _snapshots(spark, sf_dir, as_of, n):
    t = Tables(spark, sf_dir)
    targets = wl.snapshot_targets(wallets_of(spark, sf_dir), n=n)
    return wl.build_snapshots(targets, t.fx_wallet_stats, t.fx_wallet_pnl, t.fx_wallet_profile, as_of=as_of)


def _snap_text(s):
    return s.withColumn("fetched_at", ts_text("fetched_at"))


@query("snapshot_rows", oracle(
    f"SELECT proxy_address, {_duck_ts(str(AS_OF))} AS fetched_at, user_stats_json, user_pnl_json, "
    "gamma_profile_json FROM sides", _SNAP_FX, _facts_ctes(_ORACLE_WALLETS, _ORACLE_TARGETS, _ORACLE_SNAP)))
def q_snapshot_rows(spark, sf_dir):
    return _snap_text(_snapshots(spark, sf_dir, AS_OF, 200))


@query("snapshot_latest", oracle(
    f"""SELECT proxy_address,
      CASE WHEN rk <= 100 THEN {_duck_ts(str(AS_OF))} ELSE {_duck_ts(str(AS_OF - 86400))} END AS fetched_at,
      user_stats_json, user_pnl_json, gamma_profile_json FROM sides""",
    _SNAP_FX, _facts_ctes(_ORACLE_WALLETS, _ORACLE_TARGETS, _ORACLE_SNAP)))
def q_snapshot_latest(spark, sf_dir):
    """Two appended runs (top 200 yesterday, top 100 today) -> latest per wallet."""
    runs = _snapshots(spark, sf_dir, AS_OF - 86400, 200).unionByName(_snapshots(spark, sf_dir, AS_OF, 100))
    return _snap_text(wl.latest_snapshots(runs))


# ----------------------------------------------------------------- markets

_MK_OUT = ["market_id", "condition_id", "market_slug", "question", "answer1", "answer2", "neg_risk", "token1",
           "token2", "volume", "ticker", "closed_time", "created_at", "fetched_at"]


def _markets_text(df):
    return df.select(*[ts_text(c).alias(c) if c in ("closed_time", "created_at", "fetched_at")
                       else F.col(c).cast("double").alias(c) if c == "volume" else F.col(c) for c in _MK_OUT])


def _jstr(doc, path):
    return f"CASE WHEN json_type({doc}, '{path}') = 'VARCHAR' THEN json_extract_string({doc}, '{path}') END"


def _jbool(doc, path):
    return f"CASE WHEN json_type({doc}, '{path}') = 'BOOLEAN' THEN CAST(json_extract({doc}, '{path}') AS BOOLEAN) END"


def _jarr(doc, path, i):
    return (f"CASE json_type({doc}, '{path}') WHEN 'ARRAY' THEN json_extract_string({doc}, '{path}[{i}]') "
            f"WHEN 'VARCHAR' THEN json_extract_string(json_extract_string({doc}, '{path}'), '$[{i}]') END")


_ORACLE_MK_JSON = f"""mj AS (
  SELECT {_jstr('doc', '$.id')} AS market_id,
    coalesce({_jstr('doc', '$.conditionId')}, '') AS condition_id,
    coalesce({_jstr('doc', '$.slug')}, '') AS market_slug,
    coalesce({_jstr('doc', '$.question')}, {_jstr('doc', '$.title')}, '') AS question,
    coalesce({_jarr('doc', '$.outcomes', 0)}, '') AS answer1,
    coalesce({_jarr('doc', '$.outcomes', 1)}, '') AS answer2,
    coalesce({_jbool('doc', '$.negRiskAugmented')}, false) OR coalesce({_jbool('doc', '$.negRiskOther')}, false)
      AS neg_risk,
    coalesce({_jarr('doc', '$.clobTokenIds', 0)}, '') AS token1,
    coalesce({_jarr('doc', '$.clobTokenIds', 1)}, '') AS token2,
    CAST(TRY_CAST(json_extract_string(doc, '$.volume') AS DECIMAL(38,9)) AS DOUBLE) AS volume,
    coalesce({_jstr('doc', '$.events[0].ticker')}, '') AS ticker,
    CAST(NULL AS VARCHAR) AS closed_time,
    strftime(strptime({_jstr('doc', '$.createdAt')}, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%d %H:%M:%S') AS created_at,
    {_duck_ts(str(AS_OF))} AS fetched_at
  FROM fx_markets_json
  WHERE coalesce({_jstr('doc', '$.id')}, '') <> '')"""

_ORACLE_MK_PQ = f"""mp AS (
  SELECT market_id, condition_id, coalesce(nullif(slug, ''), nullif(market_slug, ''), '') AS market_slug,
    title AS question, json_extract_string(outcomes, '$[0]') AS answer1, json_extract_string(outcomes, '$[1]') AS answer2,
    coalesce(neg_risk, false) AS neg_risk,
    json_extract_string(clob_token_ids, '$[0]') AS token1, json_extract_string(clob_token_ids, '$[1]') AS token2,
    CAST(CAST(CAST(volume AS DOUBLE) AS DECIMAL(38,9)) AS DOUBLE) AS volume, '' AS ticker,
    CAST(NULL AS VARCHAR) AS closed_time,
    strftime(strptime(created_at, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%d %H:%M:%S') AS created_at,
    {_duck_ts(str(AS_OF))} AS fetched_at
  FROM fx_markets_parquet)"""


@query("markets_from_json", oracle("SELECT * FROM mj", ("fx_markets_json",), [_ORACLE_MK_JSON]))
def q_markets_from_json(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return _markets_text(mk.normalize_markets_json(t.fx_markets_json, as_of=AS_OF))


@query("markets_from_parquet", oracle("SELECT * FROM mp", ("fx_markets_parquet",), [_ORACLE_MK_PQ]))
def q_markets_from_parquet(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return _markets_text(mk.normalize_markets_parquet(t.fx_markets_parquet, as_of=AS_OF))


@query("markets_upsert", oracle(
    """SELECT coalesce(mj.market_id, e.market_id) AS market_id,
      CASE WHEN mj.market_id IS NOT NULL THEN mj.question ELSE e.question END AS question,
      CASE WHEN mj.market_id IS NOT NULL THEN mj.market_slug ELSE e.market_slug END AS market_slug,
      CASE WHEN mj.market_id IS NOT NULL THEN mj.ticker ELSE e.ticker END AS ticker,
      CASE WHEN mj.market_id IS NOT NULL THEN mj.volume ELSE e.volume END AS volume,
      CASE WHEN mj.market_id IS NOT NULL THEN mj.neg_risk ELSE e.neg_risk END AS neg_risk,
      e.category_raw, e.topic_primary
    FROM (SELECT mp.*, dim.category_raw, dim.topic_primary FROM mp JOIN dim USING (market_id)) e
    FULL OUTER JOIN mj ON e.market_id = mj.market_id""",
    ("fx_markets", "fx_markets_json", "fx_markets_parquet"), [_ORACLE_DIM, _ORACLE_MK_JSON, _ORACLE_MK_PQ]))
def q_markets_upsert(spark, sf_dir):
    """Stored markets (from parquet, already categorized) upserted with the JSON feed."""
    t = Tables(spark, sf_dir)
    stored = mk.empty_dim_columns(mk.normalize_markets_parquet(t.fx_markets_parquet, as_of=AS_OF - 86400))
    cats = _dim(t).select("market_id", F.col("category_raw").alias("_c"), F.col("topic_primary").alias("_t"))
    stored = stored.join(cats, "market_id", "left") \
        .withColumn("category_raw", F.col("_c")).withColumn("topic_primary", F.col("_t")).drop("_c", "_t")
    up = mk.upsert_markets(stored, mk.normalize_markets_json(t.fx_markets_json, as_of=AS_OF))
    return up.select("market_id", "question", "market_slug", "ticker", F.col("volume").cast("double").alias("volume"),
                     "neg_risk", "category_raw", "topic_primary")


# ----------------------------------------------------------------- enrichment

def _enrich_dim(t: Tables):
    s = t.fx_enrich_state
    return s.select("market_id", F.lit(None).cast("string").alias("category_raw"),
                    F.lit(None).cast("string").alias("topic_primary"),
                    F.timestamp_seconds("fetched_unix").alias("enrich_gamma_fetched_at"),
                    F.timestamp_seconds("failed_unix").alias("enrich_gamma_failed_at"),
                    F.col("attempts").alias("enrich_gamma_attempts"),
                    F.col("last_error").alias("enrich_gamma_last_error"))


ENRICH_CURSOR = "1000"


@query("enrichment_candidates", oracle(
    f"""SELECT market_id, market_id <= '{ENRICH_CURSOR}' AS wrapped FROM fx_enrich_state
    WHERE fetched_unix IS NULL
      AND (failed_unix IS NULL OR failed_unix < {AS_OF} - 300 * (CAST(1 AS BIGINT) << least(attempts, 10)))""",
    ("fx_enrich_state",), []))
def q_enrichment_candidates(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return en.enrichment_candidates(_enrich_dim(t), as_of=AS_OF, cursor=ENRICH_CURSOR, limit=None)


def _err_sql():
    quoted = {k: v.replace("'", "''") for k, v in en.HTTP_REASONS.items()}
    reasons = " ".join(f"WHEN {k} THEN '{v}'" for k, v in quoted.items())
    return (f"CASE WHEN r.http_status IS NULL THEN 'request error: ' || coalesce(r.error, '') "
            f"WHEN r.http_status = 429 THEN '429 too many requests' "
            f"ELSE 'http status ' || CAST(r.http_status AS VARCHAR) || ' ' || "
            f"CASE r.http_status {reasons} ELSE '<unknown status code>' END END")


_ORACLE_ENRICH = f"""ej AS (
  SELECT s.*, r.market_id IS NOT NULL AS has,
    coalesce(r.http_status BETWEEN 200 AND 299, false) AS ok,
    CASE WHEN json_valid(r.body) AND json_type(r.body, '$.category') = 'VARCHAR'
      THEN json_extract_string(r.body, '$.category') END AS cat,
    {_err_sql()} AS err
  FROM fx_enrich_state s LEFT JOIN fx_enrich_responses r USING (market_id))"""


@query("enrichment_apply", oracle(
    f"""SELECT market_id,
      CASE WHEN ok THEN cat END AS category_raw,
      CASE WHEN ok THEN (CASE WHEN cat IS NULL OR trim(cat, ' \t\n\r') = '' THEN 'other' ELSE {_topic_sql('cat')} END)
        END AS topic_primary,
      CASE WHEN ok THEN {_duck_ts(str(AS_OF))} ELSE {_duck_ts('fetched_unix')} END AS fetched_at,
      CASE WHEN ok THEN NULL WHEN has AND fetched_unix IS NULL THEN {_duck_ts(str(AS_OF))}
        ELSE {_duck_ts('failed_unix')} END AS failed_at,
      CASE WHEN has AND NOT ok AND fetched_unix IS NULL THEN attempts + 1 ELSE attempts END AS attempts,
      CASE WHEN ok THEN NULL WHEN has AND fetched_unix IS NULL THEN err ELSE last_error END AS last_error
    FROM ej""", ("fx_enrich_state", "fx_enrich_responses"), [_ORACLE_ENRICH]))
def q_enrichment_apply(spark, sf_dir):
    t = Tables(spark, sf_dir)
    out = en.apply_enrichment(_enrich_dim(t), t.fx_enrich_responses, as_of=AS_OF)
    return out.select("market_id", "category_raw", "topic_primary",
                      ts_text("enrich_gamma_fetched_at").alias("fetched_at"),
                      ts_text("enrich_gamma_failed_at").alias("failed_at"),
                      F.col("enrich_gamma_attempts").alias("attempts"),
                      F.col("enrich_gamma_last_error").alias("last_error"))


# ----------------------------------------------------------------- activities

ACTIVITY_SPLIT = 1705276800  # 2024-01-15: activities before it are already stored


def _landed_activities(t: Tables) -> DataFrame:
    """Landed API bodies: half as a bare array, half as {"data": [...]}."""
    a = t.fx_activities
    body = F.when(F.col("event_seq") % 2 == 0, F.concat(F.lit("["), F.col("event"), F.lit("]"))) \
        .otherwise(F.concat(F.lit('{"data":['), F.col("event"), F.lit("]}")))
    return a.select("proxy", body.alias("body"), F.lit("activity").alias("source_file"),
                    F.col("event_seq").alias("row_index"))


def activities_of(spark, sf_dir) -> DataFrame:
    t = Tables(spark, sf_dir)
    return act.normalize_activities(act.explode_events(_landed_activities(t)), as_of=AS_OF)


_ACT_OUT = ["occurred_at", "block_number", "tx_hash", "proxy_address", "activity_type", "condition_id",
            "amount_usd", "source"]


def _act_text(df):
    return df.select(*[ts_text(c).alias(c) if c == "occurred_at" else
                       F.col(c).cast("double").alias(c) if c == "amount_usd" else F.col(c) for c in _ACT_OUT])


_ORACLE_ACT = """an AS (SELECT json_extract_string(event, '$.timestamp') AS tsx, * FROM fx_activities),
ao AS (
  SELECT CASE WHEN regexp_full_match(tsx, '[+-]?[0-9]+') THEN CAST(tsx AS BIGINT)
      ELSE CAST(epoch(strptime(tsx, '%Y-%m-%dT%H:%M:%SZ')) AS BIGINT) END AS occ,
    CAST(json_extract(event, '$.blockNumber') AS BIGINT) AS block_number,
    json_extract_string(event, '$.transactionHash') AS tx_hash,
    lower(trim(proxy)) AS proxy_address,
    upper(json_extract_string(event, '$.type')) AS activity_type,
    CAST(NULL AS VARCHAR) AS condition_id,
    CAST(coalesce(TRY_CAST(json_extract_string(event, '$.usdcSize') AS DECIMAL(38,9)),
                  TRY_CAST(json_extract_string(event, '$.size') AS DECIMAL(38,9))) AS DOUBLE) AS amount_usd,
    'data_api' AS source, event_seq
  FROM an WHERE upper(json_extract_string(event, '$.type')) <> 'TRADE')"""
_ACT_SELECT = (f"SELECT {_duck_ts('occ')} AS occurred_at, block_number, tx_hash, proxy_address, activity_type, "
               "condition_id, amount_usd, source")


@query("activities_normalized", oracle(f"{_ACT_SELECT} FROM ao", ("fx_activities",), [_ORACLE_ACT]))
def q_activities_normalized(spark, sf_dir):
    return _act_text(activities_of(spark, sf_dir))


@query("activities_new", oracle(
    f"""{_ACT_SELECT} FROM (
      SELECT *, row_number() OVER (PARTITION BY proxy_address, activity_type, occ, tx_hash ORDER BY event_seq) AS rn
      FROM ao) nw
    WHERE rn = 1 AND NOT EXISTS (
      SELECT 1 FROM ao ex WHERE ex.occ < {ACTIVITY_SPLIT} AND ex.proxy_address = nw.proxy_address
        AND ex.activity_type = nw.activity_type AND ex.occ = nw.occ AND ex.tx_hash IS NOT DISTINCT FROM nw.tx_hash)""",
    ("fx_activities",), [_ORACLE_ACT]))
def q_activities_new(spark, sf_dir):
    """A fresh fetch of every activity against the ones stored before the split."""
    a = activities_of(spark, sf_dir)
    stored = act.new_activities(a.filter(F.col("occurred_at") < F.timestamp_seconds(F.lit(ACTIVITY_SPLIT))), None)
    return _act_text(act.new_activities(a, stored))


# ----------------------------------------------------------------- inspection

from pmflow.operators import status as stq  # noqa: E402
from pmflow.session import scratch_path  # noqa: E402
from pmflow.operators import logs as lg  # noqa: E402
from pmflow.operators import asof as asof_op  # noqa: E402
from pmflow.sources import files as fl  # noqa: E402

_FACT_COLS = ["ts_unix", "market_id", "maker", "taker", "nonusdc_side", "maker_direction", "taker_direction", "price",
              "usd_amount", "token_amount", "transaction_hash", "order_hash", "log_index"]


@query("table_counts", oracle(
    """SELECT 'dim_markets' AS table_name, count(*) AS n FROM fx_markets
    UNION ALL SELECT 'fact_trades', count(*) FROM facts
    UNION ALL SELECT 'dim_wallets', count(*) FROM wl
    UNION ALL SELECT 'agg_wallet_topic', count(*) FROM g
    UNION ALL SELECT 'agg_global_daily', count(*) FROM (SELECT DISTINCT ts_unix // 86400, topic FROM mrows)""",
    _FX_TRADES, _facts_ctes(_ORACLE_DIM, _ORACLE_MAKER_ROWS, _wallet_topic_sql(), _ORACLE_WALLETS)))
def q_table_counts(spark, sf_dir):
    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "facts")
    # what the aggregates ask of the facts, made once
    facts = facts_of(spark, sf_dir).select("ts_unix", "market_id", "maker", "taker", "usd_amount")
    facts.write.option("compression", "zstd").parquet(path)
    facts = spark.read.schema(facts.schema).parquet(path)
    dim = _dim(t)
    return stq.table_counts({
        "dim_markets": t.fx_markets, "fact_trades": facts, "dim_wallets": wallets_from(facts),
        "agg_wallet_topic": agg.wallet_topic_volume(facts, dim, as_of=AS_OF),
        "agg_global_daily": agg.global_daily(facts, dim)})


@query("recent_trades", oracle(
    "SELECT * FROM facts ORDER BY " + ", ".join(f"{c} DESC" for c in _FACT_COLS) + " LIMIT 5",
    _FX_TRADES, _facts_ctes()))
def q_recent_trades(spark, sf_dir):
    return stq.recent_trades(facts_of(spark, sf_dir), 5)


@query("market_fk_check", oracle(
    "SELECT market_id, count(*) AS n FROM facts WHERE market_id NOT IN (SELECT market_id FROM mj) GROUP BY market_id",
    (*_FX_TRADES, "fx_markets_json"), _facts_ctes(_ORACLE_MK_JSON)))
def q_market_fk_check(spark, sf_dir):
    """Facts against the JSON-fed market dimension (which lacks the numeric-id markets)."""
    t = Tables(spark, sf_dir)
    return stq.fk_violations(facts_of(spark, sf_dir), mk.normalize_markets_json(t.fx_markets_json, as_of=AS_OF))


NEXT_ID_CURSOR = 16_000
_RAW_COLS = ["block_number", "log_index", "transaction_hash", "order_hash", "maker", "taker", "maker_asset_id",
             "taker_asset_id", "maker_amount", "taker_amount"]


@query("next_id_batch", oracle(
    f"""SELECT block_number * 16 + log_index AS id, * FROM fx_trades WHERE block_number * 16 + log_index > {NEXT_ID_CURSOR}
    ORDER BY id, {', '.join(_RAW_COLS)} LIMIT 50000""", ("fx_trades",), []))
def q_next_id_batch(spark, sf_dir):
    """The next 50,000 staged rows after the id cursor (the reference's batch size)."""
    t = Tables(spark, sf_dir).fx_trades
    staged = t.select((F.col("block_number") * 16 + F.col("log_index")).alias("id"), *_RAW_COLS)
    return tr.next_id_batch(staged, NEXT_ID_CURSOR, 50_000, tie_break=_RAW_COLS)


@query("next_cursor", oracle(
    f"""SELECT max(id) AS next_cursor, count(*) AS rows FROM (SELECT block_number * 16 + log_index AS id FROM fx_trades
    WHERE block_number * 16 + log_index > {NEXT_ID_CURSOR} ORDER BY id LIMIT 50000)""", ("fx_trades",), []))
def q_next_cursor(spark, sf_dir):
    """The id cursor after that batch, and its rows."""
    return tr.next_cursor(q_next_id_batch(spark, sf_dir))


# ----------------------------------------------------------------- raw decode / block planning

TOPIC0 = "0x" + "d0a08e8c493f9c94f29311604c9de1b4e8c8d4c06bd0c789af57f2d65bfec0f6"


def _landed_logs(t: Tables) -> DataFrame:
    l = t.fx_logs
    return l.select(F.col("blocknumber").alias("block_number_hex"), F.col("logindex").alias("log_index_hex"),
                    F.col("transactionhash").alias("transaction_hash"),
                    F.array(F.lit(TOPIC0), F.lit(""), F.col("topic2")).alias("topics"),
                    "data", F.lit("exchange").alias("contract"))


@query("order_filled_decode", oracle(
    """SELECT l_orderkey AS block_number, CAST(l_linenumber AS BIGINT) AS log_index,
      '0x' || lpad(CAST(l_orderkey AS VARCHAR), 64, '0') AS transaction_hash, '' AS order_hash,
      '0x' || lpad(lower(hex(l_suppkey)), 40, '0') AS maker, '' AS taker,
      '0' AS maker_asset_id, CAST(l_partkey * 2 + 1 AS VARCHAR) AS taker_asset_id,
      CAST(CAST(round(l_extendedprice * 1000000) AS BIGINT) AS VARCHAR) AS maker_amount,
      CAST(CAST(l_quantity * 1000000 AS BIGINT) AS VARCHAR) AS taker_amount, '0' AS fee,
      'exchange' AS _contract, '' AS _fetched_at
    FROM lineitem""", (), []))
def q_order_filled_decode(spark, sf_dir):
    trades, _ = lg.decode_order_filled(_landed_logs(Tables(spark, sf_dir)))
    return trades


CHUNK, STRIDE = 1000, 100
_ORACLE_CHUNKS = f"""bnd AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders),
ch AS (
  SELECT s AS chunk_start, least(s + {CHUNK - 1}, hi) AS chunk_end
  FROM (SELECT unnest(range(lo, hi + 1, {CHUNK})) AS s, hi FROM bnd))"""


def _chunks(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    lo, hi = o.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return lg.block_chunks(spark, int(lo), int(hi), CHUNK)


@query("block_chunks", oracle("SELECT chunk_start, chunk_end FROM ch", (), [_ORACLE_CHUNKS]))
def q_block_chunks(spark, sf_dir):
    """D17 over the block range the data spans (two scalars read from orders)."""
    return _chunks(spark, sf_dir)


@query("block_samples", oracle(
    f"""SELECT DISTINCT chunk_start, block_number FROM (
      SELECT chunk_start, unnest(list_concat(range(chunk_start, chunk_end + 1, {STRIDE}), [chunk_end])) AS block_number
      FROM ch)""", (), [_ORACLE_CHUNKS]))
def q_block_samples(spark, sf_dir):
    return lg.block_samples(_chunks(spark, sf_dir), STRIDE)


@query("block_time_interpolated", oracle(
    """SELECT block_number,
      CASE WHEN pb = block_number THEN pt WHEN pb IS NOT NULL AND nb IS NOT NULL AND nb > pb
        THEN pt + ((nt - pt) * (block_number - pb)) // (nb - pb) END AS ts_unix,
      pb AS prev_block, nb AS next_block,
      CASE WHEN pb = block_number THEN 'exact' WHEN pb IS NOT NULL AND nb IS NOT NULL THEN 'interpolated'
        ELSE 'unresolved' END AS method
    FROM (
      SELECT block_number, is_need,
        last_value(sb IGNORE NULLS) OVER (ORDER BY block_number, is_need
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pb,
        last_value(st IGNORE NULLS) OVER (ORDER BY block_number, is_need
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pt,
        first_value(sb IGNORE NULLS) OVER (ORDER BY block_number, is_need
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nb,
        first_value(st IGNORE NULLS) OVER (ORDER BY block_number, is_need
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nt
      FROM (SELECT block_number, 0 AS is_need, block_number AS sb, ts_unix AS st FROM bt
            UNION ALL
            SELECT DISTINCT block_number, 1 AS is_need, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM fx_trades) u) w
    WHERE is_need = 1""", ("fx_blocks", "fx_trades"), [_ORACLE_BT]))
def q_block_time_interpolated(spark, sf_dir):
    """X1 with a small bucket (1,000 blocks) so the carry rows between buckets are exercised."""
    t = Tables(spark, sf_dir)
    return asof_op.interpolate_block_times(t.fx_trades, tr.block_times(t.fx_blocks), bucket_size=1000)


# ----------------------------------------------------------------- files

MANIFEST_SPLIT = "1996-01-01"


def _listing(t: Tables) -> DataFrame:
    return t.fx_files.unionByName(t.fx_sidecars)


def _manifest(t: Tables) -> DataFrame:
    """Files already processed: the trade files of orders placed before the split."""
    o = t.orders.filter(F.col("o_orderdate") < F.lit(MANIFEST_SPLIT).cast("timestamp"))
    key = F.concat(F.lit("exchange/trades/trades_"), (F.col("o_orderkey") * 10).cast("string"), F.lit("_"),
                   (F.col("o_orderkey") * 10 + 9).cast("string"), F.lit(".parquet"))
    return o.select(key.alias("key"))


_ORACLE_FILES = f"""listing AS (SELECT * FROM fx_files UNION ALL SELECT * FROM fx_sidecars),
cl AS (
  SELECT key, size, regexp_replace(key, '(^|/)\\._([^/]+)$', '\\1\\2') AS normalized_key,
    starts_with(regexp_extract(key, '[^/]*$'), '._') AND ends_with(key, '.parquet') AS is_sidecar
  FROM listing),
mf AS (
  SELECT 'exchange/trades/trades_' || CAST(o_orderkey * 10 AS VARCHAR) || '_' || CAST(o_orderkey * 10 + 9 AS VARCHAR)
    || '.parquet' AS key
  FROM orders WHERE o_orderdate < TIMESTAMP '{MANIFEST_SPLIT}')"""
_FILES_FX = ("fx_files", "fx_sidecars")


@query("file_key_normalize", oracle("SELECT key, normalized_key, is_sidecar FROM cl", _FILES_FX, [_ORACLE_FILES]))
def q_file_key_normalize(spark, sf_dir):
    return fl.classify_listing(_listing(Tables(spark, sf_dir))).select("key", "normalized_key", "is_sidecar")


@query("pending_files", oracle(
    """SELECT key, normalized_key, size FROM cl
    WHERE NOT is_sidecar AND ends_with(key, '.parquet') AND normalized_key NOT IN (SELECT key FROM mf)""",
    _FILES_FX, [_ORACLE_FILES]))
def q_pending_files(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return fl.pending_files(_listing(t), _manifest(t), mode="manifest")


@query("pending_files_lexicographic", oracle(
    """SELECT key, normalized_key, size FROM cl
    WHERE NOT is_sidecar AND ends_with(key, '.parquet') AND normalized_key > (SELECT max(key) FROM mf)""",
    _FILES_FX, [_ORACLE_FILES]))
def q_pending_files_lexicographic(spark, sf_dir):
    """Q1: the reference cursor skips unpadded keys that sort before the last done key."""
    t = Tables(spark, sf_dir)
    return fl.pending_files(_listing(t), _manifest(t), mode="lexicographic")


@query("sidecar_report", oracle(
    """SELECT s.key, s.size, s.normalized_key, c.normalized_key IS NOT NULL AS canonical_counterpart_exists
    FROM cl s LEFT JOIN (SELECT DISTINCT normalized_key FROM cl WHERE NOT is_sidecar AND ends_with(key, '.parquet')) c
      ON s.normalized_key = c.normalized_key
    WHERE s.is_sidecar""", _FILES_FX, [_ORACLE_FILES]))
def q_sidecar_report(spark, sf_dir):
    return fl.sidecar_report(_listing(Tables(spark, sf_dir)))


@query("sidecar_summary", oracle(
    """SELECT (SELECT count(DISTINCT normalized_key) FROM cl WHERE NOT is_sidecar AND ends_with(key, '.parquet'))
        AS canonical_parquet_distinct_keys,
      (SELECT count(*) FROM cl WHERE is_sidecar) AS apple_double_parquet_count,
      (SELECT count(*) FROM cl s WHERE is_sidecar AND normalized_key NOT IN
        (SELECT normalized_key FROM cl WHERE NOT is_sidecar AND ends_with(key, '.parquet')))
        AS apple_double_without_counterpart""", _FILES_FX, [_ORACLE_FILES]))
def q_sidecar_summary(spark, sf_dir):
    return fl.sidecar_summary(_listing(Tables(spark, sf_dir)))


@query("status_report", oracle(
    """SELECT 'files' AS section, 'exchange/trades:' || k AS name, v AS value FROM (
      SELECT 'data_files' AS k, count(*) FILTER (WHERE NOT is_sidecar AND ends_with(key, '.parquet')) AS v FROM cl
      UNION ALL SELECT 'sidecars', count(*) FILTER (WHERE is_sidecar) FROM cl
      UNION ALL SELECT 'pending', count(*) FILTER (WHERE NOT is_sidecar AND ends_with(key, '.parquet')
        AND normalized_key NOT IN (SELECT key FROM mf)) FROM cl)
    UNION ALL SELECT 'tables', 'stg_order_filled', count(*) FROM stg
    UNION ALL SELECT 'tables', 'fact_trades', count(*) FROM facts""",
    (*_FX_TRADES, *_FILES_FX),
    _facts_ctes(_ORACLE_FILES, f"""stg AS (
  SELECT DISTINCT transaction_hash, maker, taker, coalesce(bt.ts_unix, 0) AS ts, maker_asset_id, taker_asset_id
  FROM fx_trades LEFT JOIN bt USING (block_number) WHERE maker <> '' AND taker <> '' AND transaction_hash <> '')""")))
def q_status_report(spark, sf_dir):
    t, bt, _ = _inputs(spark, sf_dir)
    return stq.status_report(_listing(t), _manifest(t), {
        "stg_order_filled": tr.build_staging(t.fx_trades, bt), "fact_trades": facts_of(spark, sf_dir)})


# ----------------------------------------------------------------- streaming

from pmflow.streaming import streams as stm  # noqa: E402

STREAM_FILES = 16
STREAM_FILES_PER_TRIGGER = 4


def _lookups(spark, base, *lookups):
    """Lookups written once, not made anew by each micro-batch."""
    for i, made in enumerate(lookups):
        made.write.option("compression", "zstd").parquet(f"{base}/lookup{i}")
    return [spark.read.schema(made.schema).parquet(f"{base}/lookup{i}") for i, made in enumerate(lookups)]


def _run_fact_stream(spark, sf_dir):
    """Land the raw trades as files (range-cut by block), then stream them
    through ST1 four files per micro-batch. Returns (facts_path, rejects_path)."""
    t, bt, tm = _inputs(spark, sf_dir)
    base = scratch_path(spark, "stream")
    bt, tm = _lookups(spark, base, bt, tm)
    landing = f"{base}/landing/trades"
    t.fx_trades.repartitionByRange(STREAM_FILES, "block_number", "log_index").write.option(
        "compression", "zstd").parquet(landing)
    q = stm.stream_fact_trades(spark, landing, bt, tm, out_path=f"{base}/facts", rejects_path=f"{base}/rejects",
                               checkpoint=f"{base}/_ckpt/facts", max_files_per_trigger=STREAM_FILES_PER_TRIGGER)
    q.awaitTermination()
    return base


@query("stream_fact_trades", oracle("SELECT * FROM facts", _FX_TRADES, _facts_ctes()))
def q_stream_fact_trades(spark, sf_dir):
    base = _run_fact_stream(spark, sf_dir)
    return spark.read.parquet(f"{base}/facts").drop("source_file")


@query("stream_global_daily", oracle(_global_daily_sql("CAST(NULL AS BIGINT)"), _FX_TRADES,
                                     _facts_ctes(_ORACLE_DIM, _ORACLE_MAKER_ROWS)))
def q_stream_global_daily(spark, sf_dir):
    base = _run_fact_stream(spark, sf_dir)
    q = stm.stream_global_daily(spark, f"{base}/facts", out_path=f"{base}/daily", checkpoint=f"{base}/_ckpt/daily",
                                max_files_per_trigger=STREAM_FILES_PER_TRIGGER)
    q.awaitTermination()
    daily = stm.read_global_daily(spark, f"{base}/daily", _dim(Tables(spark, sf_dir)))
    return daily.withColumn("stat_date", F.col("stat_date").cast("string"))


@query("stream_wallets", oracle(_WALLET_OUT, _FX_TRADES, _facts_ctes(_ORACLE_WALLETS)))
def q_stream_wallets(spark, sf_dir):
    base = _run_fact_stream(spark, sf_dir)
    q = stm.stream_wallets(spark, f"{base}/facts", out_path=f"{base}/wallets", checkpoint=f"{base}/_ckpt/wallets",
                           max_files_per_trigger=STREAM_FILES_PER_TRIGGER)
    q.awaitTermination()
    return _wallets_text(stm.read_wallets(spark, f"{base}/wallets"))


_RAW_ORDER = ["maker", "taker", "maker_asset_id", "taker_asset_id", "maker_amount", "taker_amount"]
_FIRST_FACTS = _ORACLE_CLASSIFY.replace(
    "FROM classified WHERE reject_reason IS NULL)",
    "FROM (SELECT *, row_number() OVER (PARTITION BY transaction_hash, log_index ORDER BY "
    + ", ".join(_RAW_ORDER) + ") AS rn FROM classified WHERE reject_reason IS NULL) WHERE rn = 1)")


@query("stream_fact_trades_dedup", oracle("SELECT * FROM facts", _FX_TRADES,
                                          [_ORACLE_BT, _ORACLE_TM, _FIRST_FACTS]))
def q_stream_fact_trades_dedup(spark, sf_dir):
    """Streaming dedupe on (transaction_hash, log_index), the first in writer
    order; the raw trades are landed twice, in files of other names."""
    t, bt, tm = _inputs(spark, sf_dir)
    base = scratch_path(spark, "stream-dedup")
    bt, tm = _lookups(spark, base, bt, tm)
    landing = f"{base}/landing/trades"
    t.fx_trades.repartitionByRange(STREAM_FILES, "block_number", "log_index").sortWithinPartitions(
        "block_number", "log_index", *_RAW_ORDER).write.option("compression", "zstd").parquet(f"{landing}/a")
    # of the key, not the log index alone: that has few values, so few files got all rows
    t.fx_trades.repartition(STREAM_FILES, "block_number", "log_index").write.option(
        "compression", "zstd").parquet(f"{landing}/b")
    q = stm.stream_fact_trades_dedup(spark, landing, bt, tm, out_path=f"{base}/facts",
                                     checkpoint=f"{base}/_ckpt", max_files_per_trigger=STREAM_FILES_PER_TRIGGER)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/facts").select(*tr.FACT_COLUMNS)


@query("listing_sample", oracle(
    "SELECT key FROM cl WHERE NOT is_sidecar AND ends_with(key, '.parquet') ORDER BY key LIMIT 8",
    _FILES_FX, [_ORACLE_FILES]))
def q_listing_sample(spark, sf_dir):
    """The sample of eight keys the status report shows."""
    return fl.listing_sample(_listing(Tables(spark, sf_dir)), 8)



_ORACLE_BT_INTERP = """bt0 AS (
  SELECT block_number, max(CAST(epoch(strptime(timestamp, '%Y-%m-%dT%H:%M:%SZ')) AS BIGINT)) AS ts_unix
  FROM fx_blocks GROUP BY block_number),
bw AS (
  SELECT block_number, is_need,
    last_value(sb IGNORE NULLS) OVER (ORDER BY block_number, is_need
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pb,
    last_value(st IGNORE NULLS) OVER (ORDER BY block_number, is_need
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pt,
    first_value(sb IGNORE NULLS) OVER (ORDER BY block_number, is_need
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nb,
    first_value(st IGNORE NULLS) OVER (ORDER BY block_number, is_need
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nt
  FROM (SELECT block_number, 0 AS is_need, block_number AS sb, ts_unix AS st FROM bt0
        UNION ALL
        SELECT DISTINCT block_number, 1 AS is_need, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM fx_trades) u),
bt AS (
  SELECT block_number,
    CASE WHEN pb = block_number THEN pt WHEN pb IS NOT NULL AND nb IS NOT NULL AND nb > pb
      THEN pt + ((nt - pt) * (block_number - pb)) // (nb - pb) END AS ts_unix
  FROM bw WHERE is_need = 1 AND pb IS NOT NULL AND (pb = block_number OR (nb IS NOT NULL AND nb > pb)))"""


@query("fact_trades_interpolated", oracle(
    "SELECT * FROM facts", _FX_TRADES, [_ORACLE_BT_INTERP, _ORACLE_TM, _ORACLE_CLASSIFY]))
def q_fact_trades_interpolated(spark, sf_dir):
    """X1 inside D3: trades whose block was not sampled get an interpolated time
    instead of being rejected as no_block."""
    t, bt, tm = _inputs(spark, sf_dir)
    blocks = tr.resolve_block_times(t.fx_trades, bt, "interpolated", bucket_size=1000)
    facts, _ = tr.build_fact_trades(t.fx_trades, blocks, tm)
    return facts



PAGE_SIZE = 500  # markets per API page (the reference's default)


@query("markets_from_json_pages", oracle("SELECT * FROM mj", ("fx_markets_json",), [_ORACLE_MK_JSON]))
def q_markets_from_json_pages(spark, sf_dir):
    """The JSON documents landed as pages of 500 markets (a JSON array
    per page), exploded back to one market per row, then normalized (D7)."""
    t = Tables(spark, sf_dir)
    docs = t.fx_markets_json
    # market ids are unique, so a page holds at most PAGE_SIZE documents
    page_no = F.floor(F.get_json_object("doc", "$.id").cast("bigint") / PAGE_SIZE)
    pages = docs.groupBy(page_no.alias("page_no")).agg(
        F.concat(F.lit("["), F.concat_ws(",", F.collect_list("doc")), F.lit("]")).alias("page"))
    return _markets_text(mk.normalize_markets_json(mk.explode_market_pages(pages), as_of=AS_OF))


REPLAY_SPLIT = "1997-01-01"


@query("fact_trades_replay", oracle("SELECT * FROM facts", _FX_TRADES, _facts_ctes()))
def q_fact_trades_replay(spark, sf_dir):
    """I9 late data: run 1 sees only the blocks of orders placed before the
    split, so later trades are rejected as no_block; run 2 replays those
    rejects once the remaining blocks have landed. Run-1 facts plus recovered
    facts equal the single full run."""
    t, bt, tm = _inputs(spark, sf_dir)
    early = tr.block_times(t.fx_blocks.filter(F.col("timestamp") < F.lit(REPLAY_SPLIT)))
    facts1, rejects1 = tr.build_fact_trades(t.fx_trades, early, tm, path=scratch_path(spark, "run1"))
    recovered, _ = tr.replay_rejects(rejects1, bt, tm)
    return facts1.unionByName(recovered)


from pmflow.plans import catalog_runs  # noqa: E402, F401  (registers its queries)
