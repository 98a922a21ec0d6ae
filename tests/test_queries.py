"""Every registered query on real tables; those with SQL must match it exactly."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def tables():
    return connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, tables, name):
    assert difference(QUERIES[name](spark, FOLDER).toArrow(), tables.sql(ORACLE[name]).to_arrow_table()) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    table = QUERIES[name](spark, FOLDER).toArrow()
    assert table.num_rows > 0
    if "prob" in table.column_names:
        assert all(0 <= p <= 1 for p in table.column("prob").to_pylist())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
