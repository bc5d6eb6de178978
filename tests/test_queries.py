"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as driver
from checks.queries import all_queries
from oracle_check import differences, oracle_connection

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert all_queries().keys() <= driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(base_spark, connection, name):
    result = driver.queries()[name](base_spark, SF_DIR)
    assert differences(result, connection, driver.oracle_sql()[name]) == []


def test_flagship(base_spark):
    rows = driver.entry(base_spark).collect()
    assert len(rows) == 50 and rows[0].asDict().keys() == {"o_orderkey", "o_totalprice"}
