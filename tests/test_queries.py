"""Every named query against its SQL on the small tables; those without SQL must give rows."""

import pytest
from compare import check, connect
from conftest import SMALL

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = connect(SMALL)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert check(spark, duck, name, QUERIES[name], ORACLES[name], SMALL) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, duck, name):
    assert check(spark, duck, name, QUERIES[name], None, SMALL) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["n_name", "c_mktsegment", "n", "revenue", "place"]
