"""Every core query with an SQL twin equals it on the smallest tables; the others run and keep a stable schema."""

import pytest

from ledgerloom.plans import registry
from tests.oracle import compare, connect

QUERIES, SQL = registry.collect()


@pytest.fixture(scope="module")
def db(smallest):
    return connect(smallest)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, smallest, db, name):
    compare(QUERIES[name](spark, smallest), db, SQL[name])


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - SQL.keys()))
def test_runs(spark, smallest, name):
    df = QUERIES[name](spark, smallest)
    assert len(set(df.columns)) == len(df.columns)
    df.write.format("noop").mode("overwrite").save()


def test_sql_only_for_queries():
    assert SQL.keys() <= QUERIES.keys()
