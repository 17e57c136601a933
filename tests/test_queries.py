"""Every registered query against its SQL."""

from __future__ import annotations

import pytest
from compare import compare

import __spark_entry__ as driver
from tidemark.plans.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(spark, QUERIES[name], ORACLES[name], SF_DIR) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_driver_offers_every_query():
    assert set(driver.queries()) >= set(QUERIES)
    assert set(driver.oracle_sql()) >= set(ORACLES)


def test_entry_has_rows(spark):
    assert driver.entry(spark).columns == ["datetime", "energy"]
