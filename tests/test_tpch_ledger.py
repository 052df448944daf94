"""Ledger ids made from order lines that come more than once."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lotwise.sources import tpch_ledger
from lotwise.sources.tpch_ledger import LedgerTables

COLUMNS = (
    "l_orderkey bigint, l_linenumber int, l_suppkey bigint, l_shipdate timestamp_ntz, l_returnflag string, l_linestatus string, "
    "l_quantity double, l_extendedprice double, l_tax double"
)


@pytest.fixture
def tables(spark, tmp_path):
    """Tables of 5,000 copies of one line (3,000 of them equal), a line number of two digits and some plain lines."""
    day = dt.datetime(2000, 1, 1)
    lines = [(7, 3, 1, day, "N", "F", 1.0, 10.0, 0.1)] * 3000
    lines += [(7, 3, n % 9, day + dt.timedelta(days=n % 50), "N", "F", float(n), 10.0, 0.1) for n in range(2000)]
    lines += [(8, 1, 1, day, "N", "F", 1.0, 10.0, 0.1), (8, 12, 1, day, "N", "F", 2.0, 10.0, 0.1), (9, 2, 1, day, "N", "F", 1.0, 10.0, 0.1)]
    spark.createDataFrame(lines, COLUMNS).repartition(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    return LedgerTables(spark, str(tmp_path))


@pytest.mark.parametrize("hot", [1_000_000, 1000, 37])
def test_every_copy_has_an_id(tables, monkeypatch, hot):
    monkeypatch.setattr(tpch_ledger, "HOT_COPIES", hot)
    rows = tables.trades.select("tx_id", "crypto_id", "quantity").collect()
    assert len(rows) == 5003 and len({r.tx_id for r in rows}) == 5003
    # Room for 5,000 copies and for line 12, so copies of a line are numbered from 1 on.
    assert sorted(r.tx_id for r in rows) == sorted([(700 + 3) * 10_000 + n for n in range(1, 5001)] + [8_010_001, 8_120_001, 9_020_001])
    assert Counter((r.crypto_id, float(r.quantity)) for r in rows)[1, 1.0] == 3003


def test_ids_of_one_asset_are_those_of_the_ledger(tables, monkeypatch):
    for hot in (1_000_000, 500):
        monkeypatch.setattr(tpch_ledger, "HOT_COPIES", hot)
        fresh = LedgerTables(tables.spark, tables.folder)
        every = {r.tx_id for r in fresh.trades.filter(F.col("crypto_id") == 4).collect()}
        assert {r.tx_id for r in fresh.trades_of(4).collect()} == every and every


def test_hot_lines_are_numbered_in_pieces(tables, monkeypatch):
    monkeypatch.setattr(tpch_ledger, "HOT_COPIES", 200)
    shown = tables.trades._jdf.queryExecution().optimizedPlan().toString()
    assert "piece" in shown and "raise_error" not in shown
    monkeypatch.setattr(tpch_ledger, "HOT_COPIES", 1_000_000)
    assert "piece" not in LedgerTables(tables.spark, tables.folder).trades._jdf.queryExecution().optimizedPlan().toString()


def test_reports_without_ids_number_nothing(tables):
    assert "tx_id" not in tables.movements.columns and tables.movements.count() == 5003
    assert "Window" not in tables.movements._jdf.queryExecution().optimizedPlan().toString()
