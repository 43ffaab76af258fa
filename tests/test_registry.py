"""Every registered query against its DuckDB oracle on the smallest fixture, plus the driver contract."""

import pytest

import __spark_entry__ as entry_mod
from tools.oracle import compare, duck_connect
from inkstream.plans.registry import load_all

REG = load_all()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck_connect(sf_dir)


@pytest.mark.parametrize("key", sorted(k for k, e in REG.items() if e.sql is not None))
def test_query_matches_oracle(spark, sf_dir, con, key):
    ok, msg = compare(REG[key].build(spark, sf_dir), con, REG[key].sql)
    assert ok, msg


@pytest.mark.parametrize("key", sorted(k for k, e in REG.items() if e.sql is None))
def test_rows_only_queries_run(spark, sf_dir, key):
    assert REG[key].build(spark, sf_dir).count() > 0


def test_entry_contract(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    assert set(REG) <= set(entry_mod.queries())
