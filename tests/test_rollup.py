"""Maintained rollups equal the full queries, and read what has changed."""

import random

import pytest
from pyspark.sql import functions as F

from pmflow.operators import aggregates as agg
from pmflow.operators import trades as tr
from pmflow.plans import tables as tb
from pmflow.plans.rollup import DAY, MakerRollup

START = 1_700_000_000
FACTS = "batch int, ts_unix bigint, market_id string, maker string, usd_amount double"


def some_facts(rng, batch, n):
    return [(batch, rng.choice([0, 50, START + rng.randrange(-120 * DAY, 20 * DAY)]) if rng.random() < .1
             else START + rng.randrange(-100 * DAY, DAY), rng.choice(["m1", "m2", "m3", "m4", "", None]),
             rng.choice(["0xA", "0xa", "0xb", "0xc", "", None]), rng.choice([None, 0.0, 1.5, 2.25, 1e6, 0.000001]))
            for _ in range(n)]


class Store:
    """Facts by batch, and which batches were asked for."""

    def __init__(self, spark, root):
        self.spark, self.root, self.asked = spark, root, []

    def write(self, rows):
        df = self.spark.createDataFrame(rows, FACTS).withColumn("stat_month", tr.stat_month())
        for b in {r[0] for r in rows}:
            df.where(F.col("batch") == b).drop("batch").write.partitionBy("stat_month").parquet(
                f"{self.root}/facts/batch={b}")

    def facts(self, batches):
        self.asked.append(set(batches))
        t = tb.read_or_none(self.spark, f"{self.root}/facts")
        return t.where(F.col("batch").isin(sorted(batches)))

    def markets(self, name, **topics):
        path = f"{self.root}/markets/{name}"
        self.spark.createDataFrame(list(topics.items()), "market_id string, topic_primary string").write.parquet(path)
        return path


def equal(a, b):
    rows = [sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=str) for df in (a, b)]
    assert rows[0] == rows[1] and rows[0]


def test_three_clocks_late_batches_and_moved_markets(spark, tmp_path):
    rng = random.Random(8)
    store = Store(spark, str(tmp_path))
    made = MakerRollup(spark, f"{tmp_path}/wh", store.facts, (7, 30))
    first = store.markets("first", m1="tech", m2=None, m3="ai")
    second = store.markets("second", m1="tech", m2="sports", m3="tech", m4="ai")
    runs = [([0], first, START), ([0, 1, 2], first, START + 3 * DAY + 4711), ([0, 1, 2, -1], second, START + 4 * DAY),
            ([0, 1, 2, -1], second, START - 2 * DAY + 5), ([0, 1, 2, -1], second, START + 90 * DAY)]
    stored = set()
    for batches, markets, as_of in runs:
        for b in set(batches) - stored:
            store.write(some_facts(rng, b, 60))
        stored |= set(batches)
        for _ in range(2):  # the second run finds nothing to do
            state = made.refresh(set(batches), markets, as_of)
            daily = made.refresh_daily(set(batches), markets, "exact")
        dim = spark.read.parquet(markets)
        every = store.facts(set(batches))
        equal(made.wallet_topic_volume(state), agg.wallet_topic_volume(every, dim, as_of=as_of, periods=(7, 30)))
        equal(daily, agg.global_daily(every, dim, unique_wallets="exact"))


def test_old_facts_are_not_read(spark, tmp_path):
    rng = random.Random(9)
    store = Store(spark, str(tmp_path))
    made = MakerRollup(spark, f"{tmp_path}/wh", store.facts)
    markets = store.markets("one", m1="tech", m2="ai")
    midnight = START // DAY * DAY
    for b in range(3):
        store.write(some_facts(rng, b, 40))
        store.asked.clear()
        batches = set(range(b + 1))
        state = made.refresh(batches, markets, midnight + b * DAY)
        made.refresh_daily(batches, markets)
        assert store.asked == [{b}]  # its partials; whole days enter and leave
        equal(made.wallet_topic_volume(state), agg.wallet_topic_volume(
            store.facts(batches), spark.read.parquet(markets), as_of=midnight + b * DAY))
    # inside a day, what is read of old facts is the split day
    edge = made.between({0}, midnight - 7 * DAY + 100, midnight - 7 * DAY + 200)
    plan = edge._jdf.queryExecution().executedPlan().toString()
    assert "stat_month" in plan.split("PartitionFilters")[1].split("]")[0]
    for lo, hi in [(5, 5), (9, 3)]:
        assert made.between({0}, lo, hi) is None


def test_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    made = MakerRollup(spark, f"{tmp_path}/wh", store.facts)
    markets = store.markets("one", m1="tech")
    store.write([(0, 0, "m1", "0xa", 1.0)])
    assert made.refresh({0}, markets, START).count() == 0
    assert made.refresh_daily({0}, markets).count() == 0
    with pytest.raises(ValueError):
        made.global_daily({0}, spark.read.parquet(markets), "some")


def test_sketches_of_any_span(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    made = MakerRollup(spark, f"{tmp_path}/wh", store.facts)
    markets = store.markets("one", m1="tech", m2="ai", m3="ai")
    rng = random.Random(10)
    day = START // DAY
    for b in range(2):
        n = 20_000
        rows = [(b, (day - rng.randrange(100)) * DAY + 7, f"m{rng.randrange(1, 4)}", f"0x{rng.randrange(30_000):x}",
                 1.0) for _ in range(n)]
        store.write(rows)
        made.add_batch(b)
    dim = spark.read.parquet(markets)
    for days in (7, 30, 90, 1):
        exact = dict(map(tuple, made.unique_wallets({0, 1}, dim, day - days + 1, day, exact=True).collect()))
        near = dict(map(tuple, made.unique_wallets({0, 1}, dim, day - days + 1, day).collect()))
        assert exact.keys() == near.keys() == {"tech", "ai"}
        assert all(abs(near[t] - exact[t]) <= 0.03 * exact[t] for t in exact)
    one = dict(map(tuple, made.unique_wallets({0}, dim, 0, day, exact=True).collect()))
    assert one["ai"] < exact["ai"] + 30_000 and one["ai"] > 0
    assert made.unique_wallets({0, 1}, dim, 5, 4).collect() == []
