"""Prices as of a day and portfolio values."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.expressions import (
    above_dust, as_date, by_end_of, moves_holdings, percent, ratio, signed_quantity,
)
from lotwise.operators.holdings import get_historical_holdings, holdings_net
from lotwise.schemas import CENTS, NET_HOLDING

def _worth(holding: Column, price: Column) -> Column:
    return holding.cast(NET_HOLDING) * price


def _price_or_zero(name: str) -> Column:
    return F.coalesce(name, F.lit(0).cast("decimal(18,8)"))


def _or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast("decimal(38,11)"))


def latest_prices(prices: DataFrame) -> DataFrame:
    """Newest close per asset: one combined aggregate instead of a self-join on the newest date."""
    return prices.groupBy("crypto_id").agg(F.max_by("close_price_usd", "price_date").alias("current_price_usd"))


def prices_on_date(prices: DataFrame, day: dt.date | str) -> DataFrame:
    return prices.filter(F.col("price_date") == F.lit(as_date(day))).select("crypto_id", "close_price_usd")


def prices_as_of(prices: DataFrame, day: dt.date | str | None) -> DataFrame:
    """Newest close on or before the day; None sets no limit."""
    rows = prices if day is None else prices.filter(F.col("price_date") <= F.lit(as_date(day)))
    return rows.groupBy("crypto_id").agg(F.max_by("close_price_usd", "price_date").alias("close_price_usd"))


def portfolio_value_breakdown(tx: DataFrame, cryptos: DataFrame, prices: DataFrame) -> DataFrame:
    """Held assets at their newest price; price and value stay NULL for an asset without one."""
    return (
        holdings_net(tx)
        .join(cryptos, "crypto_id")
        .join(latest_prices(prices), "crypto_id", "left")
        .select(
            "symbol", "name", "holding_quantity", "current_price_usd",
            _worth(F.col("holding_quantity"), F.col("current_price_usd")).alias("current_market_value_usd"),
        )
    )


def current_portfolio_value(tx: DataFrame, cryptos: DataFrame, prices: DataFrame) -> DataFrame:
    """One row; assets without a price are left out of the sum, and the sum of none is NULL."""
    return portfolio_value_breakdown(tx, cryptos, prices).agg(
        F.sum("current_market_value_usd").alias("total_portfolio_value_usd")
    )


def current_asset_allocation(tx: DataFrame, cryptos: DataFrame, prices: DataFrame) -> DataFrame:
    """Like the breakdown, with a missing price taken as 0, and each asset's share of the total."""
    price = _price_or_zero("current_price_usd")
    assets = portfolio_value_breakdown(tx, cryptos, prices).select(
        "symbol", "name", "holding_quantity",
        price.alias("current_price_usd"),
        _worth(F.col("holding_quantity"), price).alias("current_market_value_usd"),
    )
    # The total is a scalar subquery: it reads the same exchanges and comes back as one literal.
    total = assets.agg(F.sum("current_market_value_usd")).scalar()
    share = F.coalesce(percent(F.col("current_market_value_usd"), total), F.lit(0).cast("decimal(20,2)"))
    return assets.select("*", share.alias("allocation_percentage"))


def portfolio_value_change_daily(tx: DataFrame, prices: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Everything held now at newest prices, against yesterday's holdings at yesterday's exact prices.

    Both sides come from one pass over the ledger and one over the prices.
    """
    yesterday = as_date(as_of) - dt.timedelta(days=1)
    net = tx.filter(moves_holdings()).groupBy("crypto_id").agg(
        F.sum(signed_quantity()).alias("net_now"),
        F.sum(F.when(by_end_of(yesterday), signed_quantity())).alias("net_before"),
    )
    quotes = prices.groupBy("crypto_id").agg(
        F.max_by("close_price_usd", "price_date").alias("price_now"),
        F.max(F.when(F.col("price_date") == F.lit(yesterday), F.col("close_price_usd"))).alias("price_before"),
    )
    totals = _two_totals(net, quotes, "net_before", "price_before", "net_now", "price_now")
    return totals.select(
        F.col("value_b").alias("current_portfolio_value"),
        F.col("value_a").alias("yesterday_portfolio_value"),
        (F.col("value_b") - F.col("value_a")).cast("decimal(38,11)").alias("absolute_change_usd"),
        percent(F.col("value_b") - F.col("value_a"), F.col("value_a")).alias("percentage_change"),
    )


def portfolio_value_change_between_dates(
    tx: DataFrame, prices: DataFrame, start: dt.date | str, end: dt.date | str
) -> DataFrame:
    """Value at the end of two days, each at that day's exact prices (0 where there is none)."""
    start, end = as_date(start), as_date(end)
    net = _net_at_two_dates(tx, start, end)
    day = F.col("price_date")
    quotes = prices.filter((day == F.lit(start)) | (day == F.lit(end))).groupBy("crypto_id").agg(
        F.max(F.when(F.col("price_date") == F.lit(start), F.col("close_price_usd"))).alias("price_start"),
        F.max(F.when(F.col("price_date") == F.lit(end), F.col("close_price_usd"))).alias("price_end"),
    )
    totals = _two_totals(net, quotes, "net_start", "price_start", "net_end", "price_end")
    return totals.select(
        F.lit(start).alias("start_date"),
        F.lit(end).alias("end_date"),
        F.col("value_a").alias("portfolio_value_at_start_date"),
        F.col("value_b").alias("portfolio_value_at_end_date"),
        (F.col("value_b") - F.col("value_a")).cast("decimal(38,11)").alias("absolute_change_usd"),
        percent(F.col("value_b") - F.col("value_a"), F.col("value_a")).alias("percentage_change"),
    )


def get_portfolio_value_at_date(tx: DataFrame, cryptos: DataFrame, prices: DataFrame, day: dt.date | str) -> DataFrame:
    """One row: value at the end of the day, exact until one final rounding to cents, 0 if nothing is held."""
    worth = _worth(F.col("historical_holding_quantity"), _price_or_zero("close_price_usd"))
    return (
        get_historical_holdings(tx, cryptos, day)
        .join(prices_on_date(prices, day), "crypto_id", "left")
        .agg(_or_zero(F.sum(worth)).cast(CENTS).alias("portfolio_value_usd"))
    )


def portfolio_vs_btc_benchmark(
    tx: DataFrame, prices: DataFrame, start: dt.date | str, end: dt.date | str, btc_id: int,
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """Growth of the portfolio against the same money held in one asset.

    Start prices are those of the exact day, end prices the newest on or before the day. If the end is
    today (``as_of``), end prices are the newest of all. Equal start and end days count once.
    """
    start, end = as_date(start), as_date(end)
    open_end = as_of is not None and as_date(as_of) == end
    net = _net_at_two_dates(tx, start, end)
    rows = prices if open_end else prices.filter(F.col("price_date") <= F.lit(max(start, end)))
    end_day = F.col("price_date") if open_end else F.when(F.col("price_date") <= F.lit(end), F.col("price_date"))
    quotes = rows.groupBy("crypto_id").agg(
        F.max(F.when(F.col("price_date") == F.lit(start), F.col("close_price_usd"))).alias("price_start"),
        F.max_by(F.when(end_day.isNotNull(), F.col("close_price_usd")), end_day).alias("price_end"),
    )
    # Full outer, so that the benchmark asset's prices are found even when it is not held.
    btc = F.col("crypto_id") == btc_id
    totals = _two_totals(
        net, quotes, "net_start", "price_start", "net_end", "price_end", how="full",
        extra=[
            F.max(F.when(btc, F.col("price_start"))).alias("btc_price_start"),
            F.max(F.when(btc, F.col("price_end"))).alias("btc_price_end"),
        ],
    )
    a, b = F.col("value_a"), F.col("value_b")
    units = ratio(a, F.col("btc_price_start"))
    end_value = units * F.col("btc_price_end").cast("double")
    own_growth = percent(b - a, a)
    btc_growth = percent(end_value - a.cast("double"), a)
    return totals.select(
        F.lit(start).alias("start_date"),
        F.lit(end).alias("end_date"),
        a.alias("portfolio_start_value"),
        b.alias("portfolio_end_value"),
        (b - a).cast("decimal(38,11)").alias("portfolio_absolute_gain_loss"),
        own_growth.alias("portfolio_percentage_growth"),
        a.alias("btc_hypothetical_initial_investment"),
        "btc_price_start",
        "btc_price_end",
        units.alias("btc_units_hypothetically_bought"),
        end_value.alias("btc_hypothetical_end_value"),
        (end_value - a.cast("double")).alias("btc_hypothetical_absolute_gain_loss"),
        btc_growth.alias("btc_hypothetical_percentage_growth"),
        (own_growth - btc_growth).cast("decimal(20,2)").alias("outperformance_vs_btc_pct_points"),
    )


def _net_at_two_dates(tx: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return tx.filter(moves_holdings() & by_end_of(max(start, end))).groupBy("crypto_id").agg(
        F.sum(F.when(by_end_of(start), signed_quantity())).alias("net_start"),
        F.sum(F.when(by_end_of(end), signed_quantity())).alias("net_end"),
    )


def _two_totals(
    net: DataFrame, quotes: DataFrame, net_a: str, price_a: str, net_b: str, price_b: str,
    how: str = "left", extra: list[Column] | None = None,
) -> DataFrame:
    """value_a, value_b: two portfolio values from one row per asset. The dust rule applies to each side."""

    def total(holding: str, price: str) -> Column:
        held = F.when(above_dust(F.col(holding)), F.col(holding))
        return _or_zero(F.sum(_worth(held, _price_or_zero(price))))

    return net.join(quotes, "crypto_id", how).agg(
        total(net_a, price_a).alias("value_a"), total(net_b, price_b).alias("value_b"), *(extra or [])
    )
