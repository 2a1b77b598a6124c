"""What jobs hold on disk: columns shuffled once, steps written, shuffle files gone when a command ends."""

import glob
import os
import re

from pyspark.sql import functions as F

from pmflow.operators import trades as tr
from pmflow.session import CLEANUP

ROWS = [
    (1, 0, "0xt", "0xo", "0xA", "0xb", "0", "11", "5", "10"), (1, 0, "0xt", "0xn", "0xA", "0xb", "0", "11", "7", "10"),
    (1, 3, "0xt", "0xo", "0xA", "0xb", "0", "11", "1", "3"), (2, 1, "0xt", None, "0xA", "0xb", "11", "0", "x", "10"),
    (2, 1, "0xt", "", "0xA", "0xb", "11", "0", None, "10"), (2, 2, "0xt", "", "0xA", "0xc", "0", "12", "9.5", "0"),
    (1, 2, "", "", "0xA", "0xb", "0", "11", "5", "10"), (1, 3, "0xu", "", "0xA", "0xb", "0", "99", "5", "10"),
    (9, 6, "0xv", "", "0xA", "0xb", "0", "11", "5", "10"), (None, 7, "0xw", "", "0xA", "0xb", "0", "0", "5", "10"),
    (3, 8, "0xx", "", "0xA", "0xb", "11", "0", "-4", "7"), (2, 9, "0xy", "", "0xA", "0xb", "11", "0", "8", "2"),
    (2, 9, "0xy", "", "0xA", "0xb", "12", "0", "8", "2"), (2, 9, "0xy", "", "0xA", "0xb", "12", "0", "8", "2"),
]
RAW = ("block_number long, log_index long, transaction_hash string, order_hash string, maker string, taker string, "
       "maker_asset_id string, taker_asset_id string, maker_amount string, taker_amount string")


def inputs(spark):
    blocks = spark.createDataFrame([(1, 100), (2, 200), (3, 300)], "block_number long, ts_unix long")
    tokens = spark.createDataFrame([("11", "m1", "token1"), ("12", "m1", "token2")],
                                   "asset_id string, market_id string, side string")
    return spark.createDataFrame(ROWS, RAW), blocks, tokens


def picked(df) -> list[str]:
    """The fields that the last pick of one row per key sorts and shuffles."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return re.findall(r"(?:min|max)\((?:named_)?struct\((.*?)\)\) AS", plan)[0].split(", ")[::2]


def test_keyed_and_staged_facts_are_picked_by_what_tells_them_apart(spark):
    """Neither the key's texts again nor what follows from other columns."""
    trades, blocks, tokens = inputs(spark)
    direct = tr.build_fact_trades_direct(trades, blocks, tokens)
    assert picked(direct) == ["o0", "o1", "o2", "o3", "o4", "o5", "o6", "market_id", "side"]
    staged = tr.build_staging(trades, blocks)
    assert picked(staged) == ["o0", "o1", "o2", "o3", "o4"]
    stored = spark.createDataFrame(staged.collect(), staged.schema)
    assert picked(tr.build_fact_trades_keyed(stored, tokens)) == [
        "o0", "o1", "o2", "o3", "o4", "o5", "o6", "market_id", "side"]


def test_steps_of_keyed_and_staged_facts_give_the_same_rows(spark, tmp_path):
    trades, blocks, tokens = inputs(spark)
    plain = tr.build_fact_trades_direct(trades, blocks, tokens).collect()
    steps = tr.build_fact_trades_direct(trades, blocks, tokens, path=f"{tmp_path}/d").collect()
    assert sorted(map(str, plain)) == sorted(map(str, steps)) and len(plain) == 3
    # of one key the first of its block and log index, then by order hash
    first = next(r for r in plain if r.transaction_hash == "0xt")
    assert (first.ts_unix, first.price_text, str(first.usd_amount)) == (100, "0.7", "0.000007000000")
    staged = tr.build_staging(trades, blocks, path=f"{tmp_path}/s")
    assert sorted(map(str, staged.collect())) == sorted(map(str, tr.build_staging(trades, blocks).collect()))
    keyed = tr.build_fact_trades_keyed(staged, tokens, path=f"{tmp_path}/k").collect()
    assert sorted(map(str, keyed)) == sorted(map(str, tr.build_fact_trades_keyed(staged, tokens).collect()))
    assert sorted(os.listdir(f"{tmp_path}/d")) == ["found"] and os.listdir(f"{tmp_path}/s") == ["staged"]


def test_the_writer_order_may_be_one_column(spark):
    trades, blocks, tokens = inputs(spark)
    staged = tr.build_staging(trades, blocks)
    one = staged.withColumn("ingest_order", F.col("ingest_order.block_number"))
    rows = tr.build_fact_trades_keyed(one, tokens).collect()
    assert {(r.transaction_hash, r.ts_unix) for r in rows} == {("0xt", 100), ("0xx", 300), ("0xy", 200), ("0xv", 0)}


def test_shuffle_files_go_when_a_command_ends(spark, tmp_path):
    assert spark.conf.get(CLEANUP) == "true"
    root = spark._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    shuffles = lambda: {f for d in root for f in glob.glob(f"{d.toString()}/*/shuffle_*")}
    before = shuffles()
    spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").count().write.parquet(f"{tmp_path}/t")
    assert not shuffles() - before


def test_a_run_leaves_no_scratch_and_looks_at_its_rejects_once(spark, tmp_path):
    """what was written on the way is gone, rejects that were classified with
    all that is there aren't looked up again, and those of an earlier run are."""
    from pmflow.plans.pipeline import Pipeline, PipelineConfig
    from pmflow.session import checkpoint_root
    raw = f"{tmp_path}/raw"
    trades, blocks, _ = inputs(spark)
    trades.coalesce(1).write.parquet(f"{raw}/trades/a")
    times = blocks.select("block_number", F.date_format(F.timestamp_seconds("ts_unix"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
                          .alias("timestamp"))
    times.where("block_number < 2").write.parquet(f"{raw}/blocks/a")
    spark.createDataFrame([("m1", '["11","12"]')], "id string, clob_token_ids string").write.parquet(f"{raw}/markets/a")
    cfg = PipelineConfig(raw_root=raw, warehouse=f"{tmp_path}/wh", as_of=1000, dedupe=True,
                         skip={"enrich", "ingest_activities", "snapshot_wallets", "aggregate", "refresh_wallets"})
    before = set(os.listdir(checkpoint_root(spark)))
    asked = []

    def run():
        p = Pipeline(spark, cfg)
        recover = p._recover
        p._recover = lambda rejects, batch: (asked.append(rejects.count()), recover(rejects, batch))
        p.run()
        return sorted((r.transaction_hash, r.log_index, r.order_hash) for r in p.facts().collect()), p
    facts, p = run()
    assert facts == [("0xt", 0, "0xo"), ("0xt", 3, "0xo")] and not asked
    counts = {r.metric: r.value for r in p.step_counters().where("step = 'trades'").collect()}
    assert counts == {"read": 14, "inserted": 2, "rejected": 11, "repeated": 1}
    times.where("block_number >= 2").write.parquet(f"{raw}/blocks/b")
    facts, p = run()
    assert facts == [("0xt", 0, "0xo"), ("0xt", 3, "0xo"), ("0xy", 9, "")] and asked == [7]
    left = {n.rsplit("-", 1)[0] for n in set(os.listdir(checkpoint_root(spark))) - before}
    assert not left & {"classified", "replay", "replayed", "key-candidates", "settled"}, left


def test_rollup_facts_are_the_facts_columns(spark, tmp_path):
    """joins carry what is asked of a fact, and what they carry is right."""
    trades, blocks, tokens = inputs(spark)
    facts, _ = tr.build_fact_trades(trades, blocks, tokens)
    own = {"batch": F.pmod(F.xxhash64("transaction_hash"), F.lit(3)).cast("int")}
    for i, columns in enumerate((["ts_unix", "market_id", "maker", "usd_amount"], list(tr.FACT_COLUMNS))):
        got = tr.facts_with(trades, blocks, tokens, own, columns, f"{tmp_path}/{i}")
        want = facts.withColumns(own).select(*columns, "batch")
        assert got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    timed = spark.read.parquet(f"{tmp_path}/0").columns
    assert sorted(timed) == ["_own", "_ts", "_usd", "asset_id", "batch", "maker"]


def test_facts_of_a_stream_are_few_files_a_source(spark, tmp_path):
    """a source's facts aren't spread over the files of all tasks; F3: no scratch stays."""
    from pmflow.session import checkpoint_root
    from pmflow.streaming import streams as stm
    _, blocks, tokens = inputs(spark)
    n = F.col("id")
    rows = spark.range(4000, numPartitions=4).select(
        (n % 2 + 1).alias("block_number"), n.alias("log_index"), F.lit("0xt").alias("transaction_hash"),
        F.lit("0xo").alias("order_hash"), F.lit("0xA").alias("maker"), F.lit("0xb").alias("taker"),
        F.lit("0").alias("maker_asset_id"), F.lit("11").alias("taker_asset_id"),
        (n + 1).cast("string").alias("maker_amount"), F.lit("10").alias("taker_amount"))
    rows.write.parquet(f"{tmp_path}/raw/a")
    rows.repartition(3).write.parquet(f"{tmp_path}/raw/b")
    before = set(os.listdir(checkpoint_root(spark)))
    stm.stream_fact_trades(spark, f"{tmp_path}/raw", blocks, tokens, out_path=f"{tmp_path}/facts",
                           rejects_path=f"{tmp_path}/rejects", checkpoint=f"{tmp_path}/c1").awaitTermination()
    sources = glob.glob(f"{tmp_path}/facts/source_file=*")
    assert len(sources) == 7 and all(len(glob.glob(f"{s}/*.parquet")) == 1 for s in sources)
    assert spark.read.parquet(f"{tmp_path}/facts").count() == 8000
    stm.stream_fact_trades_dedup(spark, f"{tmp_path}/raw", blocks, tokens, out_path=f"{tmp_path}/first",
                                 checkpoint=f"{tmp_path}/c2", max_files_per_trigger=4).awaitTermination()
    found = spark.read.parquet(f"{tmp_path}/first")
    assert found.count() == 4000 and found.select("log_index").distinct().count() == 4000
    left = {n.rsplit("-", 1)[0] for n in set(os.listdir(checkpoint_root(spark))) - before}
    assert not left & {"first", "classified", "key-candidates"}, left
