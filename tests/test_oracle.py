"""Every registered query against its SQL on another engine."""

import pytest

import __spark_entry__ as entry_module
from oracle_compare import connect, difference
from tradeloom.plans.oracle import ORACLE
from tradeloom.plans.registry import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_module_registers_them_all():
    assert QUERIES.items() <= entry_module.queries().items()
    assert ORACLE.items() <= entry_module.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    assert difference(name, df, con, ORACLE[name]) is None


def test_queries_give_rows(sf, con):
    empty = [n for n, sql in ORACLE.items() if not con.sql(f"SELECT * FROM ({sql}) LIMIT 1").fetchall()]
    assert empty == []


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert {"window_start", "ticker", "vwap"} <= set(df.columns)
