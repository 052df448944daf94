from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from conftest import plan

from lotwise.functions.sql_functions import register_sql_functions
from lotwise.operators import holdings as H
from lotwise.operators import valuation as V
from lotwise.plans.ordering import in_report_order
from lotwise.vocabulary import INFLOW_TYPES, OUTFLOW_TYPES


@pytest.fixture(scope="module")
def ledger(make):
    return make.tx(
        (1, 1, "BUY", 5, 10, "2022-01-01 09:00:00"),
        (2, 1, "SELL", 2, 12, "2022-01-03 23:59:59"),
        (3, 1, "STAKING_REWARD", 1, None, "2022-01-04 00:00:00"),
        (4, 2, "DEPOSIT", 4, None, "2022-01-02 00:00:00"),
        (5, 2, "WITHDRAWAL", 4, None, "2022-01-05 12:00:00"),
        (6, 3, "SELL", 1, 7, "2022-01-02 00:00:00"),
        (7, 4, "AIRDROP", "0.00000001", None, "2022-01-02 00:00:00"),
        (8, 4, "REBASE", 100, 1, "2022-01-02 00:00:00"),
    )


@pytest.fixture(scope="module")
def assets(make):
    return make.cryptos((1, "BTC", "Bitcoin"), (2, "ETH", "Ether"), (3, "SOL", "Solana"), (4, "DOT", "Polkadot"))


@pytest.fixture(scope="module")
def quotes(make):
    return make.prices(
        (1, "2022-01-01", 10), (1, "2022-01-03", 20), (1, "2022-01-06", 30),
        (2, "2022-01-02", 100), (3, "2022-01-02", 1),
    )


def test_every_listed_type_counts_with_its_sign(make):
    rows = [(i, 1, t, 1, None, "2022-01-01 00:00:00") for i, t in enumerate(INFLOW_TYPES)]
    rows += [(100 + i, 1, t, 1, None, "2022-01-01 00:00:00") for i, t in enumerate(OUTFLOW_TYPES)]
    assert H.holdings_net(make.tx(*rows)).collect() == [(1, D(10 - 6))]


def test_current_holdings_keep_only_positive_nets(ledger, assets):
    rows = in_report_order("current_holdings", H.current_holdings(ledger, assets)).collect()
    assert [(r.symbol, r.current_holding_quantity) for r in rows] == [("BTC", D(4)), ("DOT", D("0.00000001"))]


def test_cut_off_is_the_end_of_the_day(ledger, assets):
    rows = H.historical_holdings_by_date(ledger, assets, "2022-01-03").collect()
    assert {r.symbol: r.historical_holding_quantity for r in rows} == {"BTC": D(3), "ETH": D(4), "DOT": D("0.00000001")}
    assert {r.target_date for r in rows} == {dt.date(2022, 1, 3)}
    typed = H.get_historical_holdings(ledger, assets, dt.date(2022, 1, 3))
    assert typed.schema["historical_holding_quantity"].dataType.simpleString() == "decimal(28,18)"


def test_many_dates_equal_one_date_at_a_time(ledger):
    days = ["2021-12-31", "2022-01-01", "2022-01-02", "2022-01-03", "2022-01-04", "2022-01-05", "2022-01-02"]
    rows = {(str(r.eval_date), r.crypto_id, r.holding_quantity) for r in H.holdings_at_dates(ledger, days).collect()}
    expected = {(d, r.crypto_id, r.holding_quantity) for d in days for r in H.holdings_net(ledger, d).collect()}
    assert rows == expected
    assert H.holdings_at_dates(ledger, days).count() == len(expected)


def test_date_filter_reaches_the_reader(spark, ledger, tmp_path):
    path = str(tmp_path / "ledger")
    ledger.write.parquet(path)
    text = plan(H.holdings_net(spark.read.parquet(path), "2022-01-03"))
    assert "LessThan(tx_timestamp,2022-01-04" in text
    assert text.count("hashpartitioning") == 1


def test_prices(quotes):
    assert {(r[0], r[1]) for r in V.latest_prices(quotes).collect()} == {(1, D(30)), (2, D(100)), (3, D(1))}
    assert {(r[0], r[1]) for r in V.prices_on_date(quotes, "2022-01-03").collect()} == {(1, D(20))}
    assert {(r[0], r[1]) for r in V.prices_as_of(quotes, "2022-01-05").collect()} == {(1, D(20)), (2, D(100)), (3, D(1))}
    assert V.prices_as_of(quotes, None).count() == 3


def test_unpriced_asset_is_null_in_the_value_and_zero_in_the_allocation(ledger, assets, quotes, make):
    rows = {r.symbol: r for r in V.portfolio_value_breakdown(ledger, assets, quotes).collect()}
    assert rows["DOT"].current_market_value_usd is None and rows["BTC"].current_market_value_usd == D(120)
    assert V.current_portfolio_value(ledger, assets, quotes).collect()[0][0] == D(120)
    shares = {r.symbol: (r.current_price_usd, r.allocation_percentage) for r in V.current_asset_allocation(ledger, assets, quotes).collect()}
    assert shares == {"BTC": (D(30), D("100.00")), "DOT": (D(0), D("0.00"))}
    none = make.prices()
    assert V.current_portfolio_value(ledger, assets, none).collect()[0][0] is None
    assert {r.allocation_percentage for r in V.current_asset_allocation(ledger, assets, none).collect()} == {D("0.00")}


def test_allocations_add_up(make, assets):
    tx = make.tx(*[(i, i, "BUY", i, 1, "2022-01-01 00:00:00") for i in (1, 2, 3)])
    prices = make.prices(*[(i, "2022-01-01", 1) for i in (1, 2, 3)])
    shares = [r.allocation_percentage for r in V.current_asset_allocation(tx, assets, prices).collect()]
    assert abs(sum(shares) - 100) <= D("0.02") and sorted(shares) == [D("16.67"), D("33.33"), D("50.00")]


def test_daily_change_is_asymmetric(ledger, quotes):
    row = V.portfolio_value_change_daily(ledger, quotes, "2022-01-04").collect()[0]
    # now: 4 x 30, all rows and newest prices; yesterday: 3 x 20, ETH without a price on the day
    assert (row.current_portfolio_value, row.yesterday_portfolio_value) == (D(120), D(60))
    assert (row.absolute_change_usd, row.percentage_change) == (D(60), D("100.00"))
    flat = V.portfolio_value_change_daily(ledger, quotes, "2022-01-03").collect()[0]
    assert flat.yesterday_portfolio_value == D(400) and flat.percentage_change == D("-70.00")
    empty = V.portfolio_value_change_daily(ledger, quotes, "2021-12-01").collect()[0]
    assert empty.yesterday_portfolio_value == 0 and empty.percentage_change is None


def test_change_between_dates(ledger, quotes):
    row = V.portfolio_value_change_between_dates(ledger, quotes, "2022-01-01", "2022-01-03").collect()[0]
    assert (row.portfolio_value_at_start_date, row.portfolio_value_at_end_date) == (D(50), D(60))
    assert (row.absolute_change_usd, row.percentage_change) == (D(10), D("20.00"))


def test_value_at_date_rounds_once(make, assets):
    tx = make.tx((1, 1, "BUY", "0.5", 1, "2022-01-01 00:00:00"), (2, 2, "BUY", "0.5", 1, "2022-01-01 00:00:00"))
    prices = make.prices((1, "2022-01-01", "0.005"), (2, "2022-01-01", "0.005"))
    assert V.get_portfolio_value_at_date(tx, assets, prices, "2022-01-01").collect()[0][0] == D("0.01")
    assert V.get_portfolio_value_at_date(tx, assets, prices, "2021-01-01").collect()[0][0] == D("0.00")


def test_sql_functions_agree(spark, ledger, assets, quotes):
    register_sql_functions(spark, {"transactions": ledger, "cryptocurrencies": assets, "historical_prices": quotes})
    for day in ("2022-01-01", "2022-01-03", "2022-01-05"):
        rows = spark.sql(f"SELECT * FROM get_historical_holdings(DATE '{day}')").collect()
        assert sorted(map(tuple, rows)) == sorted(map(tuple, H.get_historical_holdings(ledger, assets, day).collect()))
        value = spark.sql(f"SELECT get_portfolio_value_at_date(DATE '{day}')").collect()[0][0]
        assert value == V.get_portfolio_value_at_date(ledger, assets, quotes, day).collect()[0][0]


def test_benchmark(ledger, quotes):
    row = V.portfolio_vs_btc_benchmark(ledger, quotes, "2022-01-01", "2022-01-05", 1).collect()[0]
    # start 5 x 10; end 4 x 20, the newest price up to the day; ETH is gone by then
    assert (row.portfolio_start_value, row.portfolio_end_value) == (D(50), D(80))
    assert (row.btc_price_start, row.btc_price_end) == (D(10), D(20))
    assert (row.btc_units_hypothetically_bought, row.btc_hypothetical_end_value) == (5.0, 100.0)
    assert (row.portfolio_percentage_growth, row.btc_hypothetical_percentage_growth) == (D("60.00"), D("100.00"))
    assert row.outperformance_vs_btc_pct_points == D("-40.00")


def test_benchmark_ending_today_uses_newest_prices(ledger, quotes):
    row = V.portfolio_vs_btc_benchmark(ledger, quotes, "2022-01-01", "2022-01-05", 1, as_of="2022-01-05").collect()[0]
    assert row.portfolio_end_value == D(120) and row.btc_price_end == D(30)


def test_benchmark_without_start_price(ledger, quotes):
    row = V.portfolio_vs_btc_benchmark(ledger, quotes, "2022-01-02", "2022-01-05", 1).collect()[0]
    assert row.btc_price_start is None and row.btc_hypothetical_end_value is None
    assert row.portfolio_percentage_growth is not None and row.outperformance_vs_btc_pct_points is None


def test_benchmark_with_equal_dates_counts_them_once(ledger, quotes):
    row = V.portfolio_vs_btc_benchmark(ledger, quotes, "2022-01-01", "2022-01-01", 1).collect()[0]
    assert (row.portfolio_start_value, row.portfolio_end_value) == (D(50), D(50))


def test_benchmark_asset_need_not_be_held(make, quotes):
    tx = make.tx((1, 2, "BUY", 1, 1, "2022-01-02 00:00:00"))
    row = V.portfolio_vs_btc_benchmark(tx, quotes, "2022-01-01", "2022-01-06", 1).collect()[0]
    assert (row.btc_price_start, row.btc_price_end) == (D(10), D(30))
    assert row.portfolio_start_value == 0 and row.portfolio_percentage_growth is None
    assert row.btc_hypothetical_end_value == 0.0 and row.btc_hypothetical_percentage_growth is None


def test_the_day_of_a_registered_query_reaches_the_scan(spark):
    import os

    from lotwise.plans.queries import all_queries

    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("given tables not there")
    for name in ("historical_holdings_by_date", "get_portfolio_value_at_date", "portfolio_vs_btc_benchmark"):
        text = plan(all_queries()[name](spark, folder))
        assert "LessThan(l_shipdate,2001-08-02" in text, name
    # Reports without ids number no copies, so nothing is shuffled by order.
    assert "l_orderkey" not in plan(all_queries()["current_holdings"](spark, folder))
    monthly = plan(all_queries()["view_monthly_crypto_transaction_summary"](spark, folder))
    assert "hashpartitioning(l_orderkey" not in monthly and "Window" not in monthly and "o_orderkey" not in monthly
