"""Every registered query against its SQL, over the whole small tables."""

import pytest

import __spark_entry__ as entry
from verification.compare import database, differences

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def sql_side(sf_dir):
    return database(sf_dir)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_flagship(spark):
    found = entry.entry(spark)
    assert found.count() > 0 and {"macd_signal", "adx", "vwap", "return", "target"} <= set(found.columns)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, sql_side, name):
    ours = QUERIES[name](spark, sf_dir).toPandas()
    assert len(ours)
    if name in SQL:
        assert differences(ours, sql_side.execute(SQL[name]).df()) == []
