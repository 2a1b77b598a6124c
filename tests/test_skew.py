"""Skew: one wallet, one block and one market hold a third of all trades.
Results must equal a brute-force pandas computation, and the plans must
pre-aggregate before the shuffle (no hot group gathered whole in one task)."""

import contextlib
import io
from collections import defaultdict
from decimal import Decimal

from pyspark.sql import functions as F

from pmflow.operators import aggregates as agg
from pmflow.operators import trades as tr
from pmflow.operators import wallets as wl

AS_OF = 1_700_000_000
N = 3000


def _trades(spark):
    rows = []
    for i in range(N):
        hot = i % 3 == 0
        block = 7 if hot else 100 + i % 50
        maker = "0xHOT" if hot else f"0xm{i % 97}"
        asset = str(1 + (0 if hot else i % 5) * 2)
        rows.append((block, i, f"0xtx{i // 2}", f"0xo{i}", maker, f"0xt{i % 13}", "0", asset,
                     str(1_000_000 + i), str(2_000_000 + 3 * i)))
    trades = spark.createDataFrame(rows, "block_number bigint, log_index bigint, transaction_hash string, "
                                   "order_hash string, maker string, taker string, maker_asset_id string, "
                                   "taker_asset_id string, maker_amount string, taker_amount string")
    blocks = spark.createDataFrame([(7, "2023-11-10T00:00:00Z")] +
                                   [(100 + k, f"2023-{1 + k % 11:02d}-01T00:00:00Z") for k in range(50)],
                                   "block_number bigint, timestamp string")
    markets = spark.createDataFrame([(f"m{k}", str(1 + 2 * k), str(2 + 2 * k), "sports" if k else "crypto")
                                     for k in range(5)], "market_id string, token1 string, token2 string, "
                                                         "topic_primary string")
    return trades, tr.block_times(blocks), markets


def test_hot_keys_match_brute_force(spark):
    trades, blocks, markets = _trades(spark)
    facts, rejects = tr.build_fact_trades(trades.repartition(6), blocks, tr.token_map(markets))
    assert rejects.count() == 0
    out = agg.wallet_topic_volume(facts, markets, as_of=AS_OF)
    got = {(r.proxy_address, r.period, r.topic_primary): (r.volume_usd, r.trade_count) for r in out.collect()}

    pf = facts.toPandas()
    topic = {f"m{k}": ("sports" if k else "crypto") for k in range(5)}
    want = defaultdict(lambda: [Decimal(0), 0])
    for _, r in pf.iterrows():
        for name, days in (("all", None), ("7d", 7), ("30d", 30), ("90d", 90)):
            if days is None or r.ts_unix >= AS_OF - days * 86400:
                k = (r.maker.lower(), name, topic[r.market_id])
                want[k][0] += Decimal(str(r.usd_amount))
                want[k][1] += 1
    assert set(got) == set(want)
    for k, (v, c) in want.items():
        assert got[k] == (float(v), c), k
    hot = got[("0xhot", "all", "crypto")]
    assert hot[1] == N // 3

    w = {r.proxy_address: r for r in wl.wallet_activity(facts).collect()}
    assert w["0xhot"].first_seen_at == w["0xhot"].last_seen_at


def test_plans_preaggregate_before_shuffle(spark):
    trades, blocks, markets = _trades(spark)
    facts, _ = tr.build_fact_trades(trades, blocks, tr.token_map(markets))
    for df in (agg.wallet_topic_volume(facts, markets, as_of=AS_OF), wl.wallet_activity(facts),
               tr.dedupe_facts(facts)):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        assert "partial_" in buf.getvalue(), buf.getvalue()
    # the hot group is one row per map task after the partial aggregate
    dd = tr.dedupe_facts(facts)
    assert dd.count() == facts.select("transaction_hash", "log_index").distinct().count()
