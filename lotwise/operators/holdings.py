"""Net quantities per asset. One pass over the ledger, combined before the shuffle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.functions.expressions import above_dust, as_date, by_end_of, moves_holdings, signed_quantity
from lotwise.schemas import WIDE_QUANTITY


def holdings_net(tx: DataFrame, until: dt.date | str | None = None) -> DataFrame:
    """crypto_id, holding_quantity for assets held at the end of ``until`` (or over all rows)."""
    rows = tx.filter(moves_holdings())
    if until is not None:
        rows = rows.filter(by_end_of(until))
    return (
        rows.groupBy("crypto_id")
        .agg(F.sum(signed_quantity()).alias("holding_quantity"))
        .filter(above_dust(F.col("holding_quantity")))
    )


def current_holdings(tx: DataFrame, cryptos: DataFrame) -> DataFrame:
    """The dimension is joined after the aggregate, so a hot asset reaches the join as one row."""
    return cryptos.join(holdings_net(tx), "crypto_id").select(
        "crypto_id", "symbol", "name", F.col("holding_quantity").alias("current_holding_quantity")
    )


def historical_holdings_by_date(tx: DataFrame, cryptos: DataFrame, target: dt.date | str) -> DataFrame:
    return cryptos.join(holdings_net(tx, target), "crypto_id").select(
        F.lit(as_date(target)).alias("target_date"),
        "crypto_id", "symbol", "name",
        F.col("holding_quantity").alias("historical_holding_quantity"),
    )


def get_historical_holdings(tx: DataFrame, cryptos: DataFrame, target: dt.date | str) -> DataFrame:
    return historical_holdings_by_date(tx, cryptos, target).select(
        "crypto_id", "symbol", "name",
        F.col("historical_holding_quantity").cast(WIDE_QUANTITY).alias("historical_holding_quantity"),
    )


def holdings_at_dates(tx: DataFrame, dates: list[dt.date | str]) -> DataFrame:
    """eval_date, crypto_id, holding_quantity for each of a caller's list of dates (repeats count once).

    Each ledger row is added up once, under the first date that includes it; only those sums, at most
    one per asset and date, are then spread over the later dates.
    """
    days = sorted({as_date(d) for d in dates})
    calendar = F.array(*[F.lit(d) for d in days])
    tx_day = F.to_date("tx_timestamp")
    first_day = F.element_at(F.filter(calendar, lambda d: d >= tx_day), 1)
    steps = (
        tx.filter(moves_holdings() & by_end_of(days[-1]))
        .groupBy("crypto_id", first_day.alias("first_date"))
        .agg(F.sum(signed_quantity()).alias("net"))
    )
    return (
        steps.select(
            "crypto_id", "net",
            F.explode(F.filter(calendar, lambda d: d >= F.col("first_date"))).alias("eval_date"),
        )
        .groupBy("eval_date", "crypto_id")
        .agg(F.sum("net").cast("decimal(28,8)").alias("holding_quantity"))
        .filter(above_dust(F.col("holding_quantity")))
    )
