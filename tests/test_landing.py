"""Landed views: as many files as the rows call for, the view's rows, and no wide row shuffled."""

import glob

from pyspark.sql import functions as F

from pmflow.sources.fixtures import Tables


def _tables(spark, root: str) -> None:
    n = F.col("id")
    # a third of the lines are of one order, some orders and lines are there twice or have no key
    key = F.when(n % 3 == 0, 7).when(n % 101 == 0, None).otherwise(n % 4000).cast("bigint")
    lines = spark.range(12_000, numPartitions=1).select(
        key.alias("l_orderkey"), (n % 7 + 1).cast("int").alias("l_linenumber"), (n % 90).alias("l_partkey"),
        (n % 11).alias("l_suppkey"), (n % 50 + 0.5).alias("l_quantity"), (n * 1.25).alias("l_extendedprice"))
    lines.write.parquet(f"{root}/lineitem.parquet")
    orders = spark.range(4_100, numPartitions=1).select(
        (n % 4_050).alias("o_orderkey"), (n % 300).alias("o_custkey"), F.timestamp_seconds(n * 9000).alias("o_orderdate"))
    orders.write.parquet(f"{root}/orders.parquet")


def test_files_go_by_size_and_rows_stay(spark, tmp_path):
    root = str(tmp_path)
    _tables(spark, root)
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.shuffle.partitions": "32",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "4k"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        t = Tables(spark, root)
        landed = {name: t.fixture(name) for name in ("fx_trades", "fx_logs", "fx_blocks")}
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    files = {f.split("/part-")[0] for f in landed["fx_logs"].inputFiles()}
    assert len(files) == 1 and len(landed["fx_logs"].inputFiles()) > 2 * spark.sparkContext.defaultParallelism
    assert glob.glob(files.pop().removeprefix("file:").replace("///", "/") + "/*.zstd.parquet")
    lines, orders = t.lineitem, t.orders
    both = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    assert landed["fx_trades"].count() == both.count()
    got = landed["fx_trades"].groupBy("block_number", "log_index").count().collect()
    want = both.groupBy("l_orderkey", "l_linenumber").count().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert landed["fx_logs"].count() == lines.count()  # lines without a key too
    assert landed["fx_blocks"].count() == orders.where("o_orderkey % 97 <> 0").count()
