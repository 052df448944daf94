from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from conftest import plan

from lotwise.operators import quality as Q
from lotwise.operators import statistics as S
from lotwise.operators import warehouse as W
from lotwise.plans.ordering import in_report_order


@pytest.fixture(scope="module")
def ledger(make):
    return make.tx(
        (1, 1, "BUY", 2, 50, "2022-01-31 23:59:59", 1, 1, "1.5"),
        (2, 1, "BUY", 1, "100.00000001", "2022-02-01 00:00:00", 1, 1, "0.5"),
        (3, 1, "SELL", 1, 500, "2022-02-02 00:00:00", 2, 1, 0),
        (4, 2, "DEPOSIT", 3, None, "2022-02-03 00:00:00", 2, None, None),
        (5, 2, "BUY", 4, None, "2022-02-04 00:00:00", None, None, "2.25"),
        (6, 2, "BUY", 1, 0, "2022-02-05 00:00:00", 9, None, None),
        (7, 7, "FEE_PAYMENT", 1, None, "2022-02-06 00:00:00", 1, None, None),
        (8, 2, "SELL", 1, "10000.01", "2022-02-07 00:00:00", 1, None, None),
        (9, 2, "SELL", 100, "10000.01", "2022-02-08 00:00:00", 1, None, None),
        (10, 2, "SELL", "0.00000001", 1, "2022-02-09 00:00:00", 1, None, None),
    )


@pytest.fixture(scope="module")
def venues(make):
    return make.exchanges((1, "Alpha", "EXCHANGE"), (2, "Beta", "WALLET"), (3, "Unused", "OTHER"))


def test_months(ledger):
    rows = in_report_order("transaction_frequency_by_month", S.transaction_frequency_by_month(ledger)).collect()
    assert [tuple(r) for r in rows] == [("2022-02", 9, 3, 4, 2), ("2022-01", 1, 1, 0, 0)]
    assert {tuple(r) for r in S.transactions_per_month(ledger).collect()} == {("2022-02", 9), ("2022-01", 1)}


def test_average_price_leaves_out_unpriced_buys(ledger, make):
    rows = {r.symbol: r for r in S.average_purchase_price_by_asset(ledger, make.cryptos()).collect()}
    assert rows["BTC"].total_quantity_purchased == D(3)
    assert rows["BTC"].total_cost_of_purchases_usd == D("200.00000001")
    assert rows["BTC"].weighted_average_purchase_price_usd == pytest.approx(200.00000001 / 3)
    assert rows["ETH"].total_quantity_purchased == D(1) and rows["ETH"].weighted_average_purchase_price_usd == 0.0


def test_venues(ledger, venues):
    rows = {r.exchange_name: r for r in S.transaction_analysis_by_exchange(ledger, venues).collect()}
    assert set(rows) == {"Alpha", "Beta"}
    a = rows["Alpha"]
    assert (a.total_transactions, a.count_buy_transactions, a.count_sell_transactions, a.count_other_transactions) == (6, 2, 3, 1)
    assert a.total_buy_value_usd == D("200.00000001")
    assert rows["Beta"].total_buy_value_usd == 0 and rows["Beta"].total_sell_value_usd == D(500)


def test_venues_of_one_name_count_together(ledger, make):
    same = make.exchanges((1, "Alpha", "EXCHANGE"), (2, "Alpha", "WALLET"))
    row = S.transaction_analysis_by_exchange(ledger, same).collect()
    assert len(row) == 1 and row[0].total_transactions == 8


def test_value_buckets_close_above(ledger):
    rows = {r.value_range: (r.count_buy_transactions, r.count_sell_transactions) for r in S.transaction_value_distribution(ledger).collect()}
    assert rows == {
        "000 - $0 - $100": (1, 1), "001 - $101 - $500": (1, 1), "005 - > $10,000": (0, 2),
    }


def test_fees(ledger, venues, make):
    assert {tuple(r) for r in S.fee_by_exchange(ledger, venues).collect()} == {("Alpha", 2, D("2.0000"))}
    assert {tuple(r) for r in S.fee_by_asset(ledger, make.cryptos()).collect()} == {
        ("BTC", "Bitcoin", 2, D("2.0000")), ("ETH", "Ether", 1, D("2.2500")),
    }


def test_most_active(ledger, make):
    rows = in_report_order("most_active_cryptos", S.most_active_cryptos(ledger, make.cryptos())).collect()
    assert [tuple(r) for r in rows] == [("ETH", "Ether", 6), ("BTC", "Bitcoin", 3)]


def test_price_range(make):
    prices = make.prices((1, "2022-01-05", 15), (1, "2022-01-01", 10), (2, "2022-01-01", 0), (2, "2022-01-09", 5))
    rows = {r.symbol: r for r in S.price_range_check(prices, make.cryptos()).collect()}
    assert (rows["BTC"].first_price_usd, rows["BTC"].last_price_usd, rows["BTC"].percentage_change) == (10, 15, D("50.00"))
    assert rows["ETH"].percentage_change is None


def test_row_counts(ledger, venues):
    counts = S.table_row_counts({"transactions": ledger, "exchanges": venues}).collect()
    assert {tuple(r) for r in counts} == {("transactions", 10), ("exchanges", 3)}


def test_missing_prices(ledger, make):
    # transfers need no price; the fee payment's asset is unknown, so its row has no symbol to show
    assert {r.tx_id for r in Q.dq_missing_or_zero_price(ledger, make.cryptos()).collect()} == {5, 6}


def test_outliers(ledger, make):
    rows = in_report_order("dq_outlier_value", Q.dq_outlier_value(ledger, make.cryptos())).collect()
    assert [r.tx_id for r in rows] == [9, 10]


def test_orphans(ledger, make, venues):
    assert [tuple(r) for r in Q.dq_orphan_crypto(ledger, make.cryptos()).collect()] == [(7,)]
    assert [tuple(r) for r in Q.dq_orphan_exchange(ledger, venues).collect()] == [(9,)]
    # ids are made distinct below the join
    text = plan(Q.dq_orphan_crypto(ledger, make.cryptos()))
    assert text.index("Join") < text.index("HashAggregate")


def test_stale_prices(make):
    tx = make.tx(*[(i, i, "BUY", 1, 1, "2022-01-01 00:00:00") for i in (1, 2, 3)])
    assets = make.cryptos((1, "A", "a"), (2, "B", "b"), (3, "C", "c"))
    prices = make.prices((1, "2022-01-10", 1), (2, "2022-01-03", 1), (2, "2022-01-02", 1))
    rows = {r.symbol: r.last_price_update for r in Q.dq_stale_prices(tx, assets, prices, "2022-01-11").collect()}
    assert rows == {"B": dt.date(2022, 1, 3), "C": None}
    assert "B" not in {r.symbol for r in Q.dq_stale_prices(tx, assets, prices, "2022-01-10").collect()}


def test_gaps(make):
    prices = make.prices((1, "2022-01-01", 1), (1, "2022-01-04", 1), (1, "2022-01-05", 1), (2, "2022-01-01", 1))
    rows = {(r.symbol, str(r.missing_price_date)) for r in Q.dq_price_gaps(prices, make.cryptos()).collect()}
    assert rows == {("BTC", "2022-01-02"), ("BTC", "2022-01-03")}
    assert Q.dq_price_gaps(prices, make.cryptos(), crypto_id=2).count() == 0
    assert Q.dq_price_gaps(prices, make.cryptos(), crypto_id=5).count() == 0


def test_unmapped_dates(spark, make):
    tx = make.tx((1, 1, "BUY", 1, 1, "2004-05-01 00:00:00"), (2, 1, "BUY", 1, 1, "2027-12-31 23:59:59"))
    assert [r.tx_id for r in Q.dq_unmapped_dates(tx, W.build_dim_date(spark)).collect()] == [1]


def test_constraint_report(spark, make, venues, ledger):
    tables = {
        "cryptocurrencies": make.cryptos((1, "BTC", "Bitcoin"), (2, "BTC", "Copy")),
        "exchanges": venues.unionByName(make.exchanges((1, "Gamma", "BANK"))),
        "transaction_categories": make.categories((1, "Trade", None)),
        "transactions": ledger.unionByName(ledger.filter("tx_id = 3")),
        "historical_prices": make.prices((1, "2022-01-01", 1), (1, "2022-01-01", 2), (8, "2022-01-01", 2)),
    }
    found = {tuple(r) for r in Q.dq_constraint_violations(tables).collect()}
    assert found == {
        ("unique cryptocurrencies(symbol)", "BTC", 2),
        ("unique exchanges(exchange_id)", "1", 2),
        ("check exchanges(exchange_type)", "BANK", 1),
        ("unique transactions(tx_id)", "3", 2),
        ("check transactions(tx_type)", "FEE_PAYMENT", 1),
        ("reference transactions(crypto_id)", "7", 1),
        ("reference transactions(exchange_id)", "9", 1),
        ("unique historical_prices(crypto_id,price_date)", "1|2022-01-01", 2),
        ("reference historical_prices(crypto_id)", "8", 1),
    }


def test_constraint_report_counts_nulls(spark, make, venues):
    cryptos = spark.createDataFrame([(1, "BTC", None), (2, None, None)], "crypto_id int, symbol string, name string")
    tables = {
        "cryptocurrencies": cryptos, "exchanges": venues, "transaction_categories": make.categories(),
        "transactions": make.tx(), "historical_prices": make.prices(),
    }
    assert {tuple(r) for r in Q.dq_constraint_violations(tables).collect()} == {
        ("not null cryptocurrencies(symbol)", None, 1), ("not null cryptocurrencies(name)", None, 2),
    }
