"""Every registered query against its SQL counterpart, over the smallest of the given tables."""

from __future__ import annotations

import os

import compare
import pytest

import __spark_entry__ as entry_module
from lotwise.plans.oracle import all_oracles
from lotwise.plans.queries import all_queries

FOLDER = os.environ.get("LOTWISE_TEST_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables not there")


@pytest.fixture(scope="module")
def con():
    return compare.duck(FOLDER)


def test_every_query_has_a_counterpart():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entry_module.queries()) and set(all_oracles()) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_same_rows(spark, con, name):
    columns, oracle_columns, rows, oracle_rows = compare.compare(spark, con, name, FOLDER)
    assert columns == oracle_columns
    assert rows == oracle_rows


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["crypto_id", "symbol", "name", "current_holding_quantity"]
    assert df.count() > 0
