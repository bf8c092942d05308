"""Every registered query against its oracle SQL, on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check_oracles import TABLES, compare, duck
from vitrine.catalog import oracles, queries


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, small, con, name):
    fine, text = compare(spark, con, small, name, oracles().get(name))
    assert fine, text


def test_every_query_has_an_oracle():
    assert set(oracles()) == set(queries())


def test_contract(spark):
    assert contract.entry(spark).count() == 1
    assert set(contract.queries()) >= set(queries())
    assert contract.oracle_sql().items() >= oracles().items()
    assert duckdb.__version__ and len(TABLES) == 14
