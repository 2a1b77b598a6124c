"""Every registered query against its DuckDB oracle on the smallest driver tables
(the driver repeats this at sf0.01)."""

import os

import pytest

from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


def _entries():
    import __spark_entry__ as entry
    return entry.queries(), entry.oracle_sql()


def _without_sql():
    """Queries that SQL can't express, as their own tests name them."""
    try:
        from tests.llm import WITHOUT_SQL
    except ImportError:
        return set()
    return WITHOUT_SQL


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_all_queries_match_oracle(spark, con):
    q, o = _entries()
    assert {n for n in q if n not in o} == _without_sql()
    bad = []
    for name in o:
        r = compare(spark, con, name, q[name], o[name], SF)
        if not (r.get("cols_match") and r.get("values_match")):
            bad.append(r)
    assert not bad, bad


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.columns == ["proxy_address", "topic_primary", "period", "volume_usd", "trade_count", "share_of_wallet"]
    assert df.count() > 0
