"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(request):
    return connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, duck, small, name):
    assert compare(spark, duck, small, QUERIES[name], ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, small, name):
    assert QUERIES[name](spark, small).limit(1).count() == 1


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["orderkey", "line"]
