"""Every registered query against its SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql
from colloquy.catalog.oracle import ORACLE
from colloquy.catalog.queries import QUERIES
from check_queries import compare, duck
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_expected_result():
    assert set(ORACLE) == set(QUERIES) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF_DIR, name).startswith("ok")


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["id", "source", "split", "text"] and df.count() > 0
