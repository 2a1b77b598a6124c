"""Trade fact derivation: block times, token map, columnar / staged / keyed facts
(D1-D6), reject table (X2) and real dedupe (X3).

Plan shape of ``classify_trades`` (one pass over raw trades):

    trades --left join--> block_times   (sort-merge with AQE skew split, or broadcast by measured bytes)
           --left join--> token_map     (likewise)
           --> one projection computing every derived column and the reject reason

Only built-in expressions: the whole derivation runs in whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pmflow.functions.exprs import AMOUNT_SCALE, USDC_ASSET, amount_text, iso_to_unix, parse_amount, with_exact_ratio
from pmflow.operators.merge import insert_if_absent, pick_per_key, total_order
from pmflow.plans import tables as tb

FACT_COLUMNS = ["ts_unix", "market_id", "maker", "taker", "nonusdc_side", "maker_direction",
                "taker_direction", "price", "usd_amount", "token_amount", "transaction_hash",
                "order_hash", "log_index"]

STAGING_COLUMNS = ["timestamp_i64", "maker", "maker_asset_id", "maker_amount_filled", "taker",
                   "taker_asset_id", "taker_amount_filled", "transaction_hash"]
STAGING_KEY = ["transaction_hash", "maker", "taker", "timestamp_i64", "maker_asset_id", "taker_asset_id"]

# price: exact to 28 places, NULL from 10^10 on; price_text has all of them
KEYED_COLUMNS = ["ts_unix", "market_id", "maker", "taker", "nonusdc_side", "maker_direction",
                 "taker_direction", "price", "price_text", "usd_amount", "token_amount", "transaction_hash", "source"]
KEYED_KEY = ["transaction_hash", "maker", "taker", "ts_unix"]

# Reject reasons, in the order the reference tests them.
REJECT_REASONS = ["no_block", "empty_field", "bad_amount", "no_market", "zero_denominator",
                  "non_positive_price"]


def _order_of(df: DataFrame, fallback: Sequence[str]) -> list[str]:
    """Writer order: (source_file, row_index) when the scan recorded them."""
    if "source_file" in df.columns and "row_index" in df.columns:
        return ["source_file", "row_index"]
    return list(fallback)


def block_times(blocks: DataFrame) -> DataFrame:
    """block_number -> ts_unix from RFC3339 text; unparseable rows ignored;
    the last row in writer order wins for a repeated block."""
    b = blocks.select(
        F.col("block_number").cast("bigint").alias("block_number"),
        iso_to_unix(F.col("timestamp")).alias("ts_unix"),
        *[c for c in ("source_file", "row_index") if c in blocks.columns])
    order = _order_of(b, ["ts_unix"])
    # last *valid* row wins: invalid rows enter the max as NULL (ignored), so
    # the parse runs once per row instead of once in a filter and again after it
    packed = F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], F.col("ts_unix").alias("ts"))
    best = F.max(F.when(F.col("ts_unix").isNotNull(), packed)).alias("best")
    out = b.filter(F.col("block_number").isNotNull()).groupBy("block_number").agg(best)
    return out.select("block_number", F.col("best.ts").alias("ts_unix")).filter(F.col("ts_unix").isNotNull())


def token_map(markets: DataFrame) -> DataFrame:
    """asset_id -> (market_id, side) from markets whose two tokens are non-empty.
    A token claimed twice goes to the highest market_id, then token2 over token1."""
    m = markets.filter((F.coalesce("token1", F.lit("")) != "") & (F.coalesce("token2", F.lit("")) != ""))
    e = m.select("market_id", F.explode(F.array(
        F.struct(F.col("token1").alias("asset_id"), F.lit("token1").alias("side")),
        F.struct(F.col("token2").alias("asset_id"), F.lit("token2").alias("side")))).alias("t"))
    e = e.select(F.col("t.asset_id").alias("asset_id"), "market_id", F.col("t.side").alias("side"))
    return pick_per_key(e, ["asset_id"], ["market_id", "side"], last=True)


def normalized_raw(trades: DataFrame) -> DataFrame:
    """Defaults of the lenient reader: NULL ids -> '0', NULL amounts -> '0',
    NULL text -> '', NULL block -> 0, negative log index -> 0."""
    cols = set(trades.columns)

    def s(name, default):
        return F.coalesce(F.col(name).cast("string"), F.lit(default)) if name in cols else F.lit(default)

    extra = [c for c in ("source_file", "row_index", WAS) if c in cols]
    return trades.select(
        (F.coalesce(F.col("block_number").try_cast("bigint"), F.lit(0)) if "block_number" in cols
         else F.lit(0).cast("bigint")).alias("block_number"),
        (F.greatest(F.coalesce(F.col("log_index").try_cast("bigint"), F.lit(0)), F.lit(0)) if "log_index" in cols
         else F.lit(0).cast("bigint")).alias("log_index"),
        s("transaction_hash", "").alias("transaction_hash"),
        s("order_hash", "").alias("order_hash"),
        s("maker", "").alias("maker"),
        s("taker", "").alias("taker"),
        s("maker_asset_id", USDC_ASSET).alias("maker_asset_id"),
        s("taker_asset_id", USDC_ASSET).alias("taker_asset_id"),
        (amount_text("maker_amount") if "maker_amount" in cols else F.lit("0")).alias("maker_amount"),
        (amount_text("taker_amount") if "taker_amount" in cols else F.lit("0")).alias("taker_amount"),
        *extra)


def _with_amounts(t: DataFrame) -> DataFrame:
    """Parse both amounts once, in their own projection, before any join: a
    later filter on the reject reason then refers to these columns instead of
    re-running the parse for every predicate Catalyst pushes down."""
    return t.withColumns({"_ma": parse_amount("maker_amount"), "_ta": parse_amount("taker_amount")})


def _price() -> tuple[Column, Column]:
    """Denominator and price of a trade, from its parsed amounts."""
    taker_usdc = F.col("taker_asset_id") == USDC_ASSET
    denom = F.when(taker_usdc, F.col("_ma")).otherwise(F.col("_ta"))
    numer = F.when(taker_usdc, F.col("_ta")).otherwise(F.col("_ma"))
    return denom, numer.cast("double") / denom.cast("double")


def _with_own_columns(t: DataFrame) -> DataFrame:
    """What a trade says by itself, before any join: its asset, the first reason
    of its own to reject it, and its two numbers. So the joins carry those of them that
    are asked for, not the texts and decimals behind them."""
    t = _with_amounts(t)
    denom, price = _price()
    taker_usdc = F.col("taker_asset_id") == USDC_ASSET
    own = (F.when((F.col("maker") == "") | (F.col("taker") == "") | (F.col("transaction_hash") == ""), "empty_field")
           .when(F.col("_ma").isNull() | F.col("_ta").isNull(), "bad_amount")
           .when(denom == 0, "zero_denominator").when(price <= 0, "non_positive_price"))
    usd, token = F.when(taker_usdc, F.col("_ta")).otherwise(F.col("_ma")), F.when(
        taker_usdc, F.col("_ma")).otherwise(F.col("_ta"))
    return t.withColumns({
        "asset_id": asset_id(), "_own": own, "_taker_usdc": taker_usdc, "_maker_usdc": F.col("maker_asset_id") == USDC_ASSET,
        "_usd": usd.cast("double"), "_token": token.cast("double")})


def with_derived(t: DataFrame) -> DataFrame:
    """What follows of a classified trade's other columns (``CARRIED``): side,
    directions and numbers. Either side's price is usd over tokens."""
    usd, token = F.col("_usd"), F.col("_token")
    taker_usdc, maker_usdc = F.col("_taker_usdc"), F.col("_maker_usdc")
    return t.withColumns({
        "taker_direction": F.when(taker_usdc, "BUY").otherwise("SELL"),
        "maker_direction": F.when(taker_usdc, "SELL").otherwise("BUY"),
        "nonusdc_side": F.when(maker_usdc & taker_usdc, "USDC").otherwise(F.col("side")),
        "price": F.when(token != 0, usd / token), "usd_amount": usd / F.lit(float(AMOUNT_SCALE)),
        "token_amount": token / F.lit(float(AMOUNT_SCALE))})


#: What a classified trade carries until it is written as a fact; ``with_derived`` adds the rest.
CARRIED = ["ts_unix", "market_id", "side", "maker", "taker", "_usd", "_token", "_taker_usdc", "_maker_usdc",
           "transaction_hash", "order_hash", "log_index"]
#: The reason of a reject that is classified again.
WAS = "_was"


def asset_id() -> Column:
    """The asset by which a trade finds its market."""
    return F.when(F.col("maker_asset_id") != USDC_ASSET, F.col("maker_asset_id")).otherwise(F.col("taker_asset_id"))


def resolve_block_times(trades: DataFrame, blocks: DataFrame, mode: str = "exact", *,
                        bucket_size: int | None = None) -> DataFrame:
    """Block time per trade block. 'exact': the sampled blocks as they are (the
    reference's join, Q3); 'interpolated': X1, the nearest samples on both
    sides of every block a trade references, interpolated linearly."""
    if mode == "exact":
        return blocks
    if mode != "interpolated":
        raise ValueError(f"mode must be exact|interpolated, got {mode!r}")
    from pmflow.operators.asof import BUCKET_SIZE, interpolate_block_times
    t = trades.select(F.coalesce(F.col("block_number").cast("bigint"), F.lit(0)).alias("block_number"))
    it = interpolate_block_times(t, blocks, bucket_size=bucket_size or BUCKET_SIZE)
    return it.filter(F.col("ts_unix").isNotNull()).select("block_number", "ts_unix")


def classify_trades(trades: DataFrame, blocks: DataFrame, tokens: DataFrame, *, path: str | None = None) -> DataFrame:
    """Every raw trade with its derived fact columns and ``reject_reason`` (NULL = accepted).

    ``blocks`` is a block_times frame (block_number, ts_unix). With ``path`` the
    trades with their block times are written there before they are shuffled again.
    """
    t = _with_own_columns(normalized_raw(trades))
    t = t.join(blocks.select("block_number", F.col("ts_unix").alias("_ts")), "block_number", "left")
    if path is not None:
        t = _stored(t.drop("_ma", "_ta"), path)
    t = t.join(tokens.select("asset_id", "market_id", "side"), "asset_id", "left")
    return _judged(t)


def _judged(t: DataFrame) -> DataFrame:
    """Side and directions, and the first failing reason."""
    before = F.col("_own").isin("empty_field", "bad_amount")
    reason = (F.when(F.col("_ts").isNull() | (F.col("_ts") <= 0), "no_block").when(before, F.col("_own"))
              .when(F.col("market_id").isNull(), "no_market").otherwise(F.col("_own")))
    return with_derived(t.withColumns({"ts_unix": F.col("_ts"), "reject_reason": reason}))


def classify_timed(timed: DataFrame, tokens: DataFrame, path: str) -> DataFrame:
    """``classify_trades`` of trades that have their own columns and block time
    (``_ts``) already: only what may still be accepted is looked up among the
    assets, the others' ``market_id`` stays NULL. What was found is written to
    ``path``, so that facts and rejects are looked up once."""
    may = F.coalesce(F.col("_ts") > 0, F.lit(False)) & F.coalesce(
        ~F.col("_own").isin("empty_field", "bad_amount"), F.lit(True))
    found = _stored(timed.filter(may).join(tokens.select("asset_id", "market_id", "side"), "asset_id", "left"), path)
    none = {c: F.lit(None).cast(tokens.schema[c].dataType) for c in ("market_id", "side")}
    return _judged(found.unionByName(timed.filter(~may).withColumns(none)))


def accepted(classified: DataFrame) -> DataFrame:
    """The classified trades without a reason to reject them. What follows of the
    joins is said too: then they are inner joins, and a trade without a block
    isn't looked up among the assets. Of ``_own`` it isn't said: that filter
    would go below the joins and run the amounts' parse again."""
    return classified.filter(F.col("reject_reason").isNull() & (F.col("_ts") > 0) & F.col("market_id").isNotNull())


def stat_month() -> Column:
    """The UTC month of a trade, by which facts are stored: 'yyyy-MM'."""
    return F.date_format(F.timestamp_seconds("ts_unix"), "yyyy-MM")


def fact_projection(c: DataFrame, extra=()) -> DataFrame:
    """The 13 fact columns (plus ``extra`` pass-through columns)."""
    return c.select(
        "ts_unix", "market_id", "maker", "taker", "nonusdc_side", "maker_direction", "taker_direction",
        "price", "usd_amount", "token_amount", "transaction_hash", "order_hash", "log_index", *extra)


def facts_with(trades: DataFrame, blocks: DataFrame, tokens: DataFrame, own: dict[str, Column],
               columns: Sequence[str], path: str) -> DataFrame:
    """Some columns of the facts, and what ``own`` makes of the raw trades, made before
    the joins: they carry that, not what it is made of. The trades with their block
    times are written to ``path`` on the way."""
    t = _with_own_columns(normalized_raw(trades)).withColumns(own)
    wanted = set(columns)
    numbers = {"_usd", "_token"} if wanted & {"price"} else {n for c, n in (
        ("usd_amount", "_usd"), ("token_amount", "_token")) if c in wanted}
    sides = {"_taker_usdc", "_maker_usdc"} if wanted & {"taker_direction", "maker_direction", "nonusdc_side"} else set()
    keep = {"block_number", "asset_id", "_own"} | wanted | numbers | sides | set(own)
    t = t.select(*[c for c in t.columns if c in keep])
    t = t.join(blocks.select("block_number", F.col("ts_unix").alias("_ts")), "block_number", "inner")
    t = _stored(t if "block_number" in wanted else t.drop("block_number"), path)
    t = t.join(tokens.select("asset_id", "market_id", "side"), "asset_id", "left")
    for c in ("_usd", "_token"):  # not asked for: never read
        t = t if c in t.columns else t.withColumn(c, F.lit(None).cast("double"))
    for c in ("_taker_usdc", "_maker_usdc"):
        t = t if c in t.columns else t.withColumn(c, F.lit(None).cast("boolean"))
    return accepted(_judged(t)).select(*columns, *own)


def build_fact_trades(trades: DataFrame, blocks: DataFrame, tokens: DataFrame, *,
                      dedupe: bool = False, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """D3 (+X2, X3): columnar facts and the rejected rows with their reason.
    With ``path`` the trades with their block times are written there, so that
    who uses both facts and rejects joins them with the blocks once.

    ``dedupe=True`` keeps one fact per (transaction_hash, log_index): the
    first in writer order (``source_file``, ``row_index``) or, without them,
    under a total order of the fact columns.
    """
    if path is None:
        c = classify_trades(trades, blocks, tokens)
    else:
        times = blocks.select("block_number", F.col("ts_unix").alias("_ts"))
        timed = _with_own_columns(normalized_raw(trades).join(times, "block_number", "left")).drop("_ma", "_ta")
        c = classify_timed(_stored(timed, f"{path}/timed"), tokens, f"{path}/found")
    facts = fact_projection(accepted(c))
    if dedupe:
        facts = dedupe_facts(facts)
    rejects = c.filter(F.col("reject_reason").isNotNull()).select(*REJECT_COLUMNS)
    return facts, rejects


REJECT_COLUMNS = ["block_number", "log_index", "transaction_hash", "order_hash", "maker", "taker",
                  "maker_asset_id", "taker_asset_id", "maker_amount", "taker_amount", "reject_reason"]
# Reasons a later-arriving block or market can cure.
REPLAYABLE = ["no_block", "no_market"]


def replay_rejects(rejects: DataFrame, blocks: DataFrame, tokens: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Late data (I9): re-classify rows rejected for a missing block or market
    against the current block times and token map. Returns (recovered facts,
    rejects that remain); rows rejected for other reasons stay as they were.

    The reference loses such trades for good; here the reject table is the
    queue of work for the next run.
    """
    extra = [c for c in rejects.columns if c not in REJECT_COLUMNS]
    retry = rejects.filter(F.col("reject_reason").isin(*REPLAYABLE)).drop("reject_reason")
    keep = rejects.filter(~F.col("reject_reason").isin(*REPLAYABLE))
    c = classify_trades(retry, blocks, tokens)
    recovered = fact_projection(accepted(c), extra=extra)
    still = c.filter(F.col("reject_reason").isNotNull()).select(*REJECT_COLUMNS, *extra)
    return recovered, keep.select(*REJECT_COLUMNS, *extra).unionByName(still)


def dedupe_facts(facts: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """One fact per (transaction_hash, log_index), first under ``order``."""
    keys = ["transaction_hash", "log_index"]
    if order is None:
        order = [c for c in total_order(facts, ["ts_unix"]) if c not in keys]
    return pick_per_key(facts, keys, order)


def reject_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


def build_staging(trades: DataFrame, blocks: DataFrame, existing: DataFrame | None = None, *,
                  order: Sequence[str] | None = None, path: str | None = None) -> DataFrame:
    """Staged order fills. Unresolved block time -> 0; rows with an empty
    maker, taker or tx hash dropped; amounts kept as text; insert-if-absent on
    the staging key, first writer wins.

    The writer order travels along as the struct column ``ingest_order`` (the
    reference's serial id), so the keyed step can keep "first wins". With ``path``
    the trades with their block times and the staged fills are written there.
    """
    t = normalized_raw(trades)
    t = t.join(blocks.select("block_number", "ts_unix"), "block_number", "left")
    t = t.filter((F.col("maker") != "") & (F.col("taker") != "") & (F.col("transaction_hash") != ""))
    if order is None:
        order = _order_of(t, total_order(t.drop("ts_unix"), ["block_number", "log_index"]))
    t = t.withColumn("timestamp_i64", F.coalesce("ts_unix", F.lit(0)))
    # what is shuffled and sorted has each column once: the order's columns that are in the key tell nothing apart
    own = [o for o in order if o not in STAGING_KEY]
    t = t.select(*dict.fromkeys([*STAGING_KEY, *own, "maker_amount", "taker_amount"]))
    if path is not None:
        t = _stored(t, f"{path}/timed")
    t = insert_if_absent(existing, t, STAGING_KEY, own)
    if path is not None:
        t = _stored(t, f"{path}/staged", f"{path}/timed")
    return t.select(
        "timestamp_i64", "maker", "maker_asset_id", F.col("maker_amount").alias("maker_amount_filled"), "taker",
        "taker_asset_id", F.col("taker_amount").alias("taker_amount_filled"), "transaction_hash",
        F.struct(*[F.col(o) for o in order]).alias("ingest_order"))


def build_fact_trades_keyed(staged: DataFrame, tokens: DataFrame, existing: DataFrame | None = None, *,
                            source: str = "batch_pipeline", path: str | None = None) -> DataFrame:
    """Relational facts from staged fills (``timestamp_i64`` resolved,
    ``ingest_order`` = insertion order).

    Differences from the columnar form: no drop of price <= 0, a 0 time is
    kept, exact DECIMAL amounts, and insert-if-absent on
    (transaction_hash, maker, taker, ts) with the first staged row winning.
    """
    of = staged.schema["ingest_order"].dataType
    have = {"maker": "maker", "taker": "taker", "transaction_hash": "transaction_hash", "maker_asset_id": "maker_asset_id",
            "taker_asset_id": "taker_asset_id", "maker_amount_filled": "maker_amount", "taker_amount_filled": "taker_amount"}
    cols = {n: F.col(c) for c, n in have.items()}
    # the order's fields one by one; those that a staged fill has as columns, as these
    fields = of.names if isinstance(of, StructType) else [None]
    order = [f if f in cols else f"_o{i}" for i, f in enumerate(fields)]
    cols |= {o: F.col("ingest_order") if f is None else F.col("ingest_order").getField(f)
             for o, f in zip(order, fields) if o not in cols}
    t = staged.select(F.col("timestamp_i64").alias("ts_unix"), *[c.alias(n) for n, c in cols.items()])
    return _keyed(t, order, tokens, existing, source, path)


def _keyed(t: DataFrame, order: Sequence[str], tokens: DataFrame, existing: DataFrame | None, source: str,
           path: str | None = None) -> DataFrame:
    """Keyed facts of timed fills, whose first one per key is told by the
    columns ``order``. Until it is, each column is carried once and nothing that
    follows from others: amounts as their texts, parsed before the join for
    whether they are any, and again for the rows that stay. With ``path`` the
    fills with their markets are written there."""
    denom, _ = _price()
    valid = F.col("_ma").isNotNull() & F.col("_ta").isNotNull() & F.coalesce(denom != 0, F.lit(False))
    t = _with_amounts(t).withColumns({"_valid": valid, "asset_id": asset_id()}).drop("_ma", "_ta")
    t = t.join(tokens.select("asset_id", "market_id", "side"), "asset_id", "left")
    # one CASE over both join sides: Catalyst cannot split it into conjuncts and
    # push the amount checks below the token join (which would re-run the parse)
    t = t.filter(F.when(F.col("market_id").isNull(), F.lit(False)).otherwise(F.col("_valid"))).drop("asset_id", "_valid")
    if path is not None:
        t = _stored(t, f"{path}/found", f"{path}/timed")
    t = insert_if_absent(existing, t, KEYED_KEY, [o for o in order if o not in KEYED_KEY])
    taker_usdc, maker_usdc = F.col("taker_asset_id") == USDC_ASSET, F.col("maker_asset_id") == USDC_ASSET
    out = _with_amounts(t).select(
        "ts_unix", "market_id", "maker", "taker", "transaction_hash", F.lit(source).alias("source"),
        F.when(taker_usdc, "BUY").otherwise("SELL").alias("taker_direction"),
        F.when(taker_usdc, "SELL").otherwise("BUY").alias("maker_direction"),
        F.when(maker_usdc & taker_usdc, "USDC").otherwise(F.col("side")).alias("nonusdc_side"),
        F.when(taker_usdc, F.col("_ta")).otherwise(F.col("_ma")).cast("decimal(38,0)").alias("_usd"),
        F.when(taker_usdc, F.col("_ma")).otherwise(F.col("_ta")).cast("decimal(38,0)").alias("_token"))
    # exact amounts and price; either side's price is usd over tokens
    scaled = [(F.col(c) / F.lit(1_000_000)).cast("decimal(38,12)").alias(n)
              for c, n in (("_usd", "usd_amount"), ("_token", "token_amount"))]
    out = with_exact_ratio(out, "_usd", "_token", "price_text").select("*", *scaled)
    return out.withColumn("price", F.col("price_text").try_cast("decimal(38,28)")).select(*KEYED_COLUMNS)


def _stored(rows: DataFrame, path: str, used: str | None = None) -> DataFrame:
    """Rows written and read back: what it took to make them is over, its shuffles
    can go, and so can ``used``, a folder of its own making that only they were read from."""
    rows.write.option("compression", "zstd").parquet(path)
    if used is not None:
        tb.remove(rows.sparkSession, used)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def build_fact_trades_direct(trades: DataFrame, blocks: DataFrame, tokens: DataFrame,
                             existing: DataFrame | None = None, *, path: str | None = None) -> DataFrame:
    """Relational facts straight from raw trades: inner block join (drop
    unresolved), empty fields dropped, no price <= 0 test, key dedupe. With
    ``path`` each join's trades are written there before the next step shuffles them."""
    t = normalized_raw(trades)
    t = t.join(blocks.select("block_number", "ts_unix"), "block_number", "inner").filter(F.col("ts_unix") > 0)
    t = t.filter((F.col("maker") != "") & (F.col("taker") != "") & (F.col("transaction_hash") != ""))
    order = _order_of(t, total_order(t.drop("ts_unix"), ["block_number", "log_index"]))
    carried = [*KEYED_KEY, "maker_asset_id", "taker_asset_id", "maker_amount", "taker_amount", *order]
    t = t.select(*dict.fromkeys(carried))
    if path is not None:
        t = _stored(t, f"{path}/timed")
    return _keyed(t, order, tokens, existing, "batch_pipeline", path)


def next_id_batch(df: DataFrame, last_id: int, limit: int = 50_000, id_col: str = "id",
                  tie_break: Sequence[str] = ()) -> DataFrame:
    """The next ``limit`` rows after cursor ``last_id`` in id order
    (``tie_break`` columns make the cut deterministic when ids repeat).
    The limit is the feature: it is the reference's batch size. Spark plans
    it as a per-partition top-k then a merge (TakeOrderedAndProject)."""
    return df.filter(F.col(id_col) > F.lit(last_id)).orderBy(id_col, *tie_break).limit(limit)


def next_cursor(batch: DataFrame, id_col: str = "id") -> DataFrame:
    """The cursor after a batch, max id (even when every row was rejected)."""
    return batch.agg(F.max(id_col).alias("next_cursor"), F.count(F.lit(1)).alias("rows"))
