"""Counts and sums of the ledger by month, venue, asset and value. Group by id first, then join the names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.expressions import count_if, is_type, percent, ratio, value_usd
from lotwise.vocabulary import VALUE_BUCKETS

def _is_other() -> Column:
    return ~F.col("tx_type").isin("BUY", "SELL")


def _month() -> Column:
    return F.date_trunc("month", "tx_timestamp")


def transaction_frequency_by_month(tx: DataFrame) -> DataFrame:
    return (
        tx.groupBy(_month().alias("month"))
        .agg(
            F.count(F.lit(1)).alias("total_transactions_in_month"),
            count_if(is_type("BUY")).alias("buy_transactions"),
            count_if(is_type("SELL")).alias("sell_transactions"),
            count_if(_is_other()).alias("other_transactions"),
        )
        .select(
            F.date_format("month", "yyyy-MM").alias("year_month"),
            "total_transactions_in_month", "buy_transactions", "sell_transactions", "other_transactions",
        )
    )


def transactions_per_month(tx: DataFrame) -> DataFrame:
    return (
        tx.groupBy(_month().alias("month"))
        .agg(F.count(F.lit(1)).alias("total_transactions"))
        .select(F.date_format("month", "yyyy-MM").alias("transaction_year_month"), "total_transactions")
    )


def average_purchase_price_by_asset(tx: DataFrame, cryptos: DataFrame) -> DataFrame:
    bought = (
        tx.filter(is_type("BUY") & F.col("price_per_unit_usd").isNotNull() & (F.col("quantity") > 0))
        .groupBy("crypto_id")
        .agg(
            F.sum("quantity").alias("total_quantity_purchased"),
            F.sum(value_usd()).alias("total_cost_of_purchases_usd"),
        )
    )
    return cryptos.join(bought, "crypto_id").select(
        "crypto_id", "symbol", "name", "total_quantity_purchased", "total_cost_of_purchases_usd",
        ratio(F.col("total_cost_of_purchases_usd"), F.col("total_quantity_purchased")).alias(
            "weighted_average_purchase_price_usd"
        ),
    )


def transaction_analysis_by_exchange(tx: DataFrame, exchanges: DataFrame) -> DataFrame:
    """Rows without a venue drop out before the shuffle: the join would drop them anyway."""

    zero = F.lit(0).cast("decimal(37,16)")

    def traded(kind: str) -> Column:
        return F.sum(F.when(is_type(kind), F.coalesce(value_usd(), zero)).otherwise(zero))

    per_venue = (
        tx.filter(F.col("exchange_id").isNotNull())
        .groupBy("exchange_id")
        .agg(
            F.count(F.lit(1)).alias("total_transactions"),
            count_if(is_type("BUY")).alias("count_buy_transactions"),
            count_if(is_type("SELL")).alias("count_sell_transactions"),
            count_if(_is_other()).alias("count_other_transactions"),
            traded("BUY").alias("total_buy_value_usd"),
            traded("SELL").alias("total_sell_value_usd"),
        )
    )
    return _sum_by_name(
        per_venue.join(exchanges, "exchange_id"), [F.col("name").alias("exchange_name")],
        per_venue.columns[1:],
    )


def transaction_value_distribution(tx: DataFrame) -> DataFrame:
    value = F.col("transaction_value_usd")
    label = None
    for upper, text in VALUE_BUCKETS:
        inside = F.lit(True) if upper is None else value <= upper
        label = F.when(inside, text) if label is None else label.when(inside, text)
    return (
        tx.filter(F.col("tx_type").isin("BUY", "SELL") & (F.col("quantity") > 0) & (F.col("price_per_unit_usd") > 0))
        .select("tx_type", value_usd().alias("transaction_value_usd"))
        .groupBy(label.alias("value_range"))
        .agg(
            count_if(is_type("BUY")).alias("count_buy_transactions"),
            count_if(is_type("SELL")).alias("count_sell_transactions"),
        )
    )


def _fees_by(tx: DataFrame, key: str, count_name: str, sum_name: str) -> DataFrame:
    return (
        tx.filter((F.col("fee_usd") > 0) & F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias(count_name), F.sum("fee_usd").alias(sum_name))
    )


def fee_by_exchange(tx: DataFrame, exchanges: DataFrame) -> DataFrame:
    fees = _fees_by(
        tx, "exchange_id", "total_transactions_with_fees_on_exchange", "total_fees_paid_usd_on_exchange"
    )
    return _sum_by_name(
        fees.join(exchanges, "exchange_id"), [F.col("name").alias("exchange_name")], fees.columns[1:]
    )


def fee_by_asset(tx: DataFrame, cryptos: DataFrame) -> DataFrame:
    fees = _fees_by(
        tx, "crypto_id", "total_transactions_with_fees_for_asset", "total_fees_paid_usd_for_asset_transactions"
    )
    return _sum_by_name(
        fees.join(cryptos, "crypto_id"),
        [F.col("symbol").alias("crypto_symbol"), F.col("name").alias("crypto_name")],
        fees.columns[1:],
    )


def most_active_cryptos(tx: DataFrame, cryptos: DataFrame) -> DataFrame:
    counts = tx.groupBy("crypto_id").agg(F.count(F.lit(1)).alias("total_transaction_count"))
    return counts.join(cryptos, "crypto_id").select("symbol", "name", "total_transaction_count")


def price_range_check(prices: DataFrame, cryptos: DataFrame) -> DataFrame:
    """First and last close in one aggregate, where a self-join would read the prices four times."""
    ends = prices.groupBy("crypto_id").agg(
        F.min("price_date").alias("first_date"),
        F.min_by("close_price_usd", "price_date").alias("first_price_usd"),
        F.max("price_date").alias("last_date"),
        F.max_by("close_price_usd", "price_date").alias("last_price_usd"),
    )
    return cryptos.join(ends, "crypto_id").select(
        "symbol", "name", "first_date", "first_price_usd", "last_date", "last_price_usd",
        percent(F.col("last_price_usd") - F.col("first_price_usd"), F.col("first_price_usd")).alias(
            "percentage_change"
        ),
    )


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _sum_by_name(df: DataFrame, names: list[Column], measures: list[str]) -> DataFrame:
    """Add up one-row-per-id measures per name: ids that share a name count together."""
    wanted = {f.name: f.dataType for f in df.schema.fields}
    return df.groupBy(*names).agg(*[F.sum(m).cast(wanted[m]).alias(m) for m in measures])
