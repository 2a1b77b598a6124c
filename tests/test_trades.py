"""Fact derivation (P15), rejects (X2), staging and keyed variants on hand-made rows."""

from pyspark.sql import functions as F

from pmflow.operators import trades as tr

COLS = ("block_number bigint, log_index bigint, transaction_hash string, order_hash string, maker string, "
        "taker string, maker_asset_id string, taker_asset_id string, maker_amount string, taker_amount string")


def _inputs(spark, rows):
    trades = spark.createDataFrame(rows, COLS)
    blocks = tr.block_times(spark.createDataFrame(
        [(1, "2024-01-01T00:00:00Z"), (2, "2024-01-02T00:00:00Z"), (3, "bad"), (4, "1970-01-01T00:00:00Z")],
        "block_number bigint, timestamp string"))
    markets = spark.createDataFrame([("m1", "11", "12"), ("m2", "21", ""), ("m3", "31", "32")],
                                    "market_id string, token1 string, token2 string")
    return trades, blocks, tr.token_map(markets)


def row(block=1, tx="0xt", maker="0xM", taker="0xT", ma_id="0", ta_id="11", ma="5000000", ta="10000000", li=0):
    return (block, li, tx, "0xo", maker, taker, ma_id, ta_id, ma, ta)


def test_directions_and_price(spark):
    trades, blocks, tokens = _inputs(spark, [row(), row(ma_id="12", ta_id="0", ma="10000000", ta="4000000", li=1)])
    facts, rejects = tr.build_fact_trades(trades, blocks, tokens)
    got = {r.log_index: r for r in facts.collect()}
    a, b = got[0], got[1]
    assert (a.taker_direction, a.maker_direction, a.nonusdc_side) == ("SELL", "BUY", "token1")
    assert (a.usd_amount, a.token_amount, a.price) == (5.0, 10.0, 0.5)
    assert (b.taker_direction, b.maker_direction, b.nonusdc_side) == ("BUY", "SELL", "token2")
    assert (b.usd_amount, b.token_amount, b.price) == (4.0, 10.0, 0.4)
    assert a.ts_unix == 1704067200 and a.market_id == "m1"
    assert rejects.count() == 0


def test_reject_reasons_in_order(spark):
    rows = [row(block=9, maker=""),              # no_block wins over empty_field
            row(block=3),                        # unparseable block time -> no_block
            row(block=4),                        # ts 0 -> no_block
            row(maker=""),                       # empty_field
            row(ma="abc"),                       # bad_amount
            row(ma_id="0", ta_id="21"),          # market with an empty token2 -> no token map -> no_market
            row(ma_id="0", ta_id="0"),           # both USDC -> looks up '0' -> no_market
            row(ta="0"),                         # taker side is the token: zero denominator
            row(ma="0"),                         # price 0 -> dropped in the columnar form
            row(ta="-5"),                        # negative price
            row(ma_id="31", ta_id="12")]         # token for token: accepted
    trades, blocks, tokens = _inputs(spark, rows)
    facts, rejects = tr.build_fact_trades(trades, blocks, tokens)
    reasons = sorted(r.reject_reason for r in rejects.collect())
    assert reasons == sorted(["no_block", "no_block", "no_block", "empty_field", "bad_amount", "no_market",
                              "no_market", "zero_denominator", "non_positive_price", "non_positive_price"])
    f = facts.collect()
    assert len(f) == 1 and f[0].market_id == "m3" and f[0].maker_direction == "BUY"
    assert facts.count() + rejects.count() == trades.count()


def test_keyed_keeps_zero_price_and_dedupes(spark):
    rows = [row(ma="0", li=0), row(ma="7000000", li=1), row(li=2, tx="0xu"), row(ta="0", li=3, tx="0xv")]
    trades, blocks, tokens = _inputs(spark, rows)
    keyed = tr.build_fact_trades_direct(trades, blocks, tokens).collect()
    # first two share (tx, maker, taker, ts): first in order wins; price 0 kept;
    # a zero denominator is still dropped
    assert len(keyed) == 2
    z = [r for r in keyed if r.transaction_hash == "0xt"][0]
    assert z.price == 0.0 and float(z.usd_amount) == 0.0 and float(z.token_amount) == 10.0


def test_staging_keeps_unresolved_time(spark):
    trades, blocks, _ = _inputs(spark, [row(block=9), row(block=9), row(block=1, maker="")])
    st = tr.build_staging(trades, blocks).collect()
    assert len(st) == 1 and st[0].timestamp_i64 == 0


def test_dedupe_by_tx_log_index(spark):
    trades, blocks, tokens = _inputs(spark, [row(), row(ma="6000000")])
    facts, _ = tr.build_fact_trades(trades, blocks, tokens, dedupe=True)
    assert facts.count() == 1


def test_block_times_last_valid_wins(spark):
    b = spark.createDataFrame([(1, "2024-01-01T00:00:00Z", "a", 0), (1, "2024-01-02T00:00:00Z", "b", 0),
                               (1, "junk", "c", 0), (2, "junk", "a", 0)],
                              "block_number bigint, timestamp string, source_file string, row_index bigint")
    got = {r.block_number: r.ts_unix for r in tr.block_times(b).collect()}
    assert got == {1: 1704153600}


def test_token_collision_highest_market_then_token2(spark):
    m = spark.createDataFrame([("a", "5", "6"), ("b", "6", "7")], "market_id string, token1 string, token2 string")
    got = {r.asset_id: (r.market_id, r.side) for r in tr.token_map(m).collect()}
    assert got["6"] == ("b", "token1") and got["5"] == ("a", "token1")


def test_no_job_while_a_plan_is_built(spark):
    blocks = spark.range(0, 5000).selectExpr("id AS block_number", "id * 10 + 1000000 AS ts_unix")
    tokens = spark.range(0, 50).selectExpr("CAST(id AS STRING) AS asset_id", "'m' AS market_id", "'token1' AS side")
    trades = spark.range(0, 300).selectExpr("id * 7 AS block_number", "'0xt' AS transaction_hash", "'0xa' AS maker",
                                            "'0xb' AS taker", "'7' AS maker_asset_id", "'5' AS maker_amount",
                                            "'2' AS taker_amount")
    spark.sparkContext.setJobGroup("plan", "plan only")
    facts, rejects = tr.build_fact_trades(trades, blocks, tokens)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("plan")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 0
    for threshold in ("10m", "-1"):  # a small lookup, and one that is never broadcast: the same rows
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        assert facts.count() == 300 and rejects.count() == 0
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
