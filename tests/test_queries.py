"""Every query against its SQL."""

import oracle
import pytest

import __spark_entry__ as contract


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    assert set(contract.ORACLES) == set(contract.QUERIES)


def test_entry_is_not_empty(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", contract.QUERIES)
def test_query_matches_sql(spark, sf_dir, duck, name):
    names, rows = oracle.actual(contract.QUERIES[name](spark, sf_dir))
    sql_names, sql_rows = oracle.expected(duck, contract.ORACLES[name])
    assert names == sql_names
    assert rows == sql_rows
