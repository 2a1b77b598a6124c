"""What trades carry into the joins with blocks and markets, and how often they are joined."""

import re

from pmflow.operators import trades as tr

ROWS = [
    (1, 0, "0xt", "0xo", "0xA", "0xb", "0", "11", "5", "10"), (2, 1, "0xt", "", "0xA", "0xb", "11", "0", "x", "10"),
    (1, 2, "", "", "0xA", "0xb", "0", "11", "5", "10"), (1, 3, "0xt", "", "0xA", "0xb", "0", "99", "5", "10"),
    (1, 4, "0xt", "", "0xA", "0xb", "0", "11", "5", "0"), (1, 5, "0xt", "", "0xA", "0xb", "12", "0", "3", "0"),
    (9, 6, "0xt", "", "", "0xb", "0", "11", "5", "10"), (None, 7, "0xt", "", "0xA", "0xb", "0", "0", "5", "10"),
    (3, 8, "0xt", "", "0xA", "0xb", "11", "0", None, "7"), (2, 9, "0xt", "", "0xA", "0xb", "11", "0", "8", "2"),
]
RAW = ("block_number long, log_index long, transaction_hash string, order_hash string, maker string, taker string, "
       "maker_asset_id string, taker_asset_id string, maker_amount string, taker_amount string")


def _inputs(spark):
    blocks = spark.createDataFrame([(1, 100), (2, 200), (3, 0)], "block_number long, ts_unix long")
    tokens = spark.createDataFrame([("11", "m1", "token1"), ("12", "m1", "token2")],
                                   "asset_id string, market_id string, side string")
    return spark.createDataFrame(ROWS, RAW), blocks, tokens


def test_a_count_of_facts_joins_neither_hashes_nor_amounts(spark):
    """the joins' trades have only what is asked of them."""
    facts, _ = tr.build_fact_trades(*_inputs(spark))
    plan = facts.groupBy("market_id").count()._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 2 and all("Inner" in line for line in joins), plan
    below = plan[plan.rindex("Join"):]
    carried = re.search(r"Project \[(.*)\]", below).group(1)
    assert set(re.findall(r" AS (\w+)#", carried)) == {"asset_id", "_own"} and "order_hash" not in carried, carried


def test_written_trades_give_the_same_facts_and_rejects(spark, tmp_path):
    """with a path the trades are joined with the blocks once, and nothing else changes."""
    inputs = _inputs(spark)
    plain, written = tr.build_fact_trades(*inputs), tr.build_fact_trades(*inputs, path=str(tmp_path / "timed"))
    for a, b in zip(plain, written):
        assert a.columns == b.columns
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert {(r["log_index"], r["reject_reason"]) for r in written[1].collect()} == {
        (1, "bad_amount"), (2, "empty_field"), (3, "no_market"), (4, "zero_denominator"), (5, "non_positive_price"),
        (6, "no_block"), (7, "no_block"), (8, "no_block")}
    assert sorted(r["log_index"] for r in written[0].collect()) == [0, 9]
