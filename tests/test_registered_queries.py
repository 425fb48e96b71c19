"""Every registered query against its SQL on the independent engine."""

import pytest

import __spark_entry__ as entry
from lakekit.plans import registry
from tests import oracle

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle.connection()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, oracle.DATA)
    found = [tuple(r) for r in df.collect()]
    cursor = duck.execute(SQL[name])
    assert oracle.compare(df.columns, found, [d[0] for d in cursor.description], cursor.fetchall()) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["day", "nation", "revenue", "share_of_day"]
    assert df.limit(1).count() == 1
