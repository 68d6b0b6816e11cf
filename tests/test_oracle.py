"""Every registered query with a SQL oracle, against a second engine."""

import pytest

import __spark_entry__ as entry
from compare import connect, differences

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_registry_is_consistent():
    assert set(SQL) <= set(entry.queries())
    assert len(SQL) >= 70


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, con, name):
    got = entry.queries()[name](spark, sf_dir).toPandas()
    assert differences(got, con.execute(SQL[name]).df()) == ""


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r.model for r in rows} == {"baseline", "route_mean", "route_median"}
    assert all(r.rows == 874 for r in rows)
