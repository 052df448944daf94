"""Star schema: calendar, dimensions, fact, the monthly report and the load checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.functions.expressions import count_if, is_type, ratio
from lotwise.operators.merge import insert_new, upsert
from lotwise.schemas import (
    DIM_CRYPTOCURRENCY, DIM_DATE, DIM_EXCHANGE, DIM_TRANSACTION_CATEGORY, FACT_TRANSACTIONS, conform,
)
from lotwise.vocabulary import CALENDAR_END, CALENDAR_START


def build_dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first_day"), F.lit(end).cast("date").alias("last_day")
    )
    return calendar(bounds)


def calendar_covering(tx: DataFrame) -> DataFrame:
    """A calendar of whole years around the ledger's dates."""
    return calendar(
        tx.agg(
            F.trunc(F.min("tx_timestamp"), "year").alias("first_day"),
            F.date_sub(F.trunc(F.add_months(F.max("tx_timestamp"), 12), "year"), 1).alias("last_day"),
        )
    )


def calendar(bounds: DataFrame) -> DataFrame:
    """All days from first_day to last_day with their attributes."""
    day = F.col("full_date")
    iso_day = F.weekday(day) + 1
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("full_date")).select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        "full_date",
        F.year(day).alias("year_actual"),
        F.quarter(day).alias("quarter_actual"),
        F.month(day).alias("month_actual"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day_of_month"),
        iso_day.alias("day_of_week_iso"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_of_year_iso"),
        (iso_day <= 5).alias("is_weekday"),
        (iso_day >= 6).alias("is_weekend"),
    )
    return conform(days, DIM_DATE)


def extend_dim_date(dim: DataFrame, days: DataFrame) -> DataFrame:
    """Adds missing days; days already there are never changed."""
    return insert_new(dim, days, "date_key")


def upsert_dim_cryptocurrency(cryptos: DataFrame, dim: DataFrame) -> DataFrame:
    rows = cryptos.select(
        F.col("crypto_id").alias("crypto_id_original"), "symbol", "name", F.lit(False).alias("is_stablecoin")
    )
    return conform(upsert(dim, rows, "crypto_id_original", "crypto_key"), DIM_CRYPTOCURRENCY)


def upsert_dim_exchange(exchanges: DataFrame, dim: DataFrame) -> DataFrame:
    rows = exchanges.select(
        F.col("exchange_id").alias("exchange_id_original"), F.col("name").alias("exchange_name"), "exchange_type"
    )
    return conform(upsert(dim, rows, "exchange_id_original", "exchange_key"), DIM_EXCHANGE)


def upsert_dim_transaction_category(categories: DataFrame, dim: DataFrame) -> DataFrame:
    rows = categories.select(
        F.col("category_id").alias("category_id_original"),
        F.col("name").alias("category_name"),
        F.col("description").alias("category_description"),
    )
    return conform(upsert(dim, rows, "category_id_original", "category_key"), DIM_TRANSACTION_CATEGORY)


def empty_table(spark: SparkSession, schema) -> DataFrame:
    """Known to be empty when planning, so that a first load needs no join with it."""
    return conform(spark.range(1).select(*[F.lit(None).alias(f.name) for f in schema.fields]).limit(0), schema)


def per_day(dim_date: DataFrame, day: Column, *values: str) -> DataFrame:
    """One row per day, broadcast. Grouping bounds it by the days there are, even if a calendar lists one twice."""
    return F.broadcast(dim_date.groupBy(day).agg(*[F.min(v).alias(v) for v in values]))


def _day_keys(dim_date: DataFrame) -> DataFrame:
    return per_day(dim_date, F.col("full_date").alias("tx_date"), "date_key")


def _with_dimension_keys(
    tx: DataFrame, dim_date: DataFrame, dim_crypto: DataFrame, dim_exchange: DataFrame, dim_category: DataFrame
) -> DataFrame:
    """Left lookups on unique ids, so no row is lost or doubled.

    The calendar has one row per day, so its broadcast is bounded. Spark broadcasts the other dimensions only
    if their stored size is below its limit, and otherwise splits skewed join partitions (a hot asset, the
    rows without a venue).
    """
    day = _day_keys(dim_date)
    asset = dim_crypto.select(F.col("crypto_id_original").alias("crypto_id"), "crypto_key")
    venue = dim_exchange.select(F.col("exchange_id_original").alias("exchange_id"), "exchange_key")
    kind = dim_category.select(F.col("category_id_original").alias("category_id"), "category_key")
    keyed = tx.withColumn("tx_date", F.to_date("tx_timestamp"))
    for lookup, on in ((day, "tx_date"), (venue, "exchange_id"), (kind, "category_id"), (asset, "crypto_id")):
        keyed = keyed.join(lookup, on, "left")
    return keyed


def fact_rows(
    tx: DataFrame, dim_date: DataFrame, dim_crypto: DataFrame, dim_exchange: DataFrame, dim_category: DataFrame
) -> DataFrame:
    """Ledger rows as fact rows, transaction_key still NULL. Rows that cannot be stored are left to
    ``fact_rejects``."""
    keyed = _with_dimension_keys(tx, dim_date, dim_crypto, dim_exchange, dim_category)
    return conform(
        keyed.filter(F.col("date_key").isNotNull() & F.col("crypto_key").isNotNull()).select(
            F.lit(None).alias("transaction_key"),
            F.col("tx_id").alias("tx_id_original"),
            "date_key",
            F.date_format("tx_timestamp", "HH:mm:ss").alias("time_of_day"),
            "crypto_key", "exchange_key", "category_key", "tx_type", "quantity", "price_per_unit_usd",
            (F.col("quantity") * F.col("price_per_unit_usd")).alias("transaction_value_usd"),
            "fee_usd",
        ),
        FACT_TRANSACTIONS,
    )


def fact_measures(tx: DataFrame, dim_date: DataFrame, dim_crypto: DataFrame) -> DataFrame:
    """date_key, crypto_key, tx_type, quantity, value and fee of the fact rows, for reports by day and asset.

    No other dimension is looked up, and no id is needed. Rows are the same as in the fact.
    """
    asset = dim_crypto.select(F.col("crypto_id_original").alias("crypto_id"), "crypto_key")
    types = {f.name: f.dataType for f in FACT_TRANSACTIONS.fields}
    value = F.col("quantity") * F.col("price_per_unit_usd")
    dated = tx.withColumn("tx_date", F.to_date("tx_timestamp")).join(_day_keys(dim_date), "tx_date")
    return dated.join(asset, "crypto_id").select(
        "date_key", "crypto_key", "tx_type",
        F.col("quantity").cast(types["quantity"]).alias("quantity"),
        value.cast(types["transaction_value_usd"]).alias("transaction_value_usd"),
        F.col("fee_usd").cast(types["fee_usd"]).alias("fee_usd"),
    )


def fact_rejects(tx: DataFrame, dim_date: DataFrame, dim_crypto: DataFrame) -> DataFrame:
    """tx_id, reason for ledger rows without a calendar day or an asset row."""
    day = _day_keys(dim_date)
    asset = dim_crypto.select(F.col("crypto_id_original").alias("crypto_id"), "crypto_key")
    reason = F.when(F.col("date_key").isNull(), "date outside calendar").when(
        F.col("crypto_key").isNull(), "unknown asset"
    )
    return (
        tx.select("tx_id", "crypto_id", F.to_date("tx_timestamp").alias("tx_date"))
        .join(day, "tx_date", "left")
        .join(asset, "crypto_id", "left")
        .select("tx_id", reason.alias("reason"))
        .filter(F.col("reason").isNotNull())
    )


def build_fact_transactions(
    tx: DataFrame, dim_date: DataFrame, dim_crypto: DataFrame, dim_exchange: DataFrame, dim_category: DataFrame,
    fact: DataFrame, size: int | None = None,
) -> DataFrame:
    """The fact table after loading the ledger: upsert by tx id, new rows get the next keys. ``size`` is the number of
    rows of both, where that is known."""
    rows = fact_rows(tx, dim_date, dim_crypto, dim_exchange, dim_category)
    return conform(upsert(fact, rows, "tx_id_original", "transaction_key", size=size), FACT_TRANSACTIONS)


def view_monthly_crypto_transaction_summary(fact: DataFrame, dim_date: DataFrame, dim_crypto: DataFrame) -> DataFrame:
    """Per month and asset.

    The calendar joins by a broadcast, bounded by its days. The fact is then summed by month and asset key, before
    any shuffle, so the join with the asset dimension carries sums and not rows.
    """
    amounts = {"quantity": F.col("quantity"), "value": F.col("transaction_value_usd")}
    kinds = {"buy": "BUY", "sell": "SELL"}
    months = dim_date.select("date_key", F.date_format("full_date", "yyyy-MM").alias("year_month"))
    dated = fact.join(per_day(months, F.col("date_key"), "year_month"), "date_key")
    sums = dated.groupBy("year_month", "crypto_key").agg(
        *[F.sum(F.when(is_type(t), c)).alias(f"{k}_{a}") for k, t in kinds.items() for a, c in amounts.items()],
        *[count_if(is_type(t)).alias(f"{k}_count") for k, t in kinds.items()],
        F.sum("fee_usd").alias("fees"),
    )

    def total(name: str, dtype: str) -> Column:
        return F.coalesce(F.sum(name).cast(dtype), F.lit(0).cast(dtype))

    monthly = (
        sums.join(dim_crypto.select("crypto_key", "symbol", "name"), "crypto_key")
        .groupBy("year_month", F.col("symbol").alias("crypto_symbol"), F.col("name").alias("crypto_name"))
        .agg(
            *[total(f"{k}_quantity", "decimal(38,18)").alias(f"{k}_quantity") for k in kinds],
            *[total(f"{k}_value", "decimal(38,8)").alias(f"{k}_value") for k in kinds],
            *[F.sum(f"{k}_count").alias(f"{k}_count") for k in kinds],
            total("fees", "decimal(38,8)").alias("fees"),
        )
    )
    c = F.col
    return monthly.select(
        "year_month", "crypto_symbol", "crypto_name",
        c("buy_quantity").alias("total_buy_quantity"),
        c("buy_value").alias("total_buy_value_usd"),
        c("buy_count").alias("number_of_buy_transactions"),
        ratio(c("buy_value"), c("buy_quantity")).alias("average_buy_price_usd"),
        c("sell_quantity").alias("total_sell_quantity"),
        c("sell_value").alias("total_sell_value_usd"),
        c("sell_count").alias("number_of_sell_transactions"),
        ratio(c("sell_value"), c("sell_quantity")).alias("average_sell_price_usd"),
        (c("buy_quantity") - c("sell_quantity")).cast("decimal(38,18)").alias("net_quantity_transacted_this_month"),
        (c("buy_value") - c("sell_value")).cast("decimal(38,8)").alias("net_value_transacted_this_month_usd"),
        c("fees").alias("total_fees_paid_for_asset_this_month_usd"),
    )


def verify_star_null_keys(fact: DataFrame, tx: DataFrame) -> DataFrame:
    """check_name, row_count: keys that are missing; for the optional ones, only where the ledger had an id.

    One pass over the fact: only its rows with a missing key are looked up in the ledger.
    """
    keys = ("date_key", "crypto_key", "exchange_key", "category_key")
    missing = {k: F.col(k).isNull() for k in keys}
    suspects = fact.filter(
        missing["date_key"] | missing["crypto_key"] | missing["exchange_key"] | missing["category_key"]
    ).select("tx_id_original", *keys)
    source = tx.select(F.col("tx_id").cast("bigint").alias("tx_id_original"), "exchange_id", "category_id")
    found = suspects.join(source, "tx_id_original", "left").agg(
        count_if(missing["date_key"]).alias("date_key"),
        count_if(missing["crypto_key"]).alias("crypto_key"),
        count_if(missing["exchange_key"] & F.col("exchange_id").isNotNull()).alias("exchange_key"),
        count_if(missing["category_key"] & F.col("category_id").isNotNull()).alias("category_key"),
    )
    listed = F.array(*[F.struct(F.lit(f"null_{k}").alias("check_name"), F.col(k).alias("row_count")) for k in keys])
    return found.select(F.inline(listed))


def value_by_symbol_year(fact: DataFrame, dim_date: DataFrame, dim_crypto: DataFrame) -> DataFrame:
    yearly = (
        fact.filter(F.col("tx_type").isin("BUY", "SELL"))
        .join(per_day(dim_date, F.col("date_key"), "year_actual"), "date_key")
        .groupBy("year_actual", "crypto_key")
        .agg(F.sum("transaction_value_usd").alias("value"))
    )
    return (
        yearly.join(dim_crypto.select("crypto_key", "symbol"), "crypto_key")
        .groupBy(F.col("symbol").alias("crypto_symbol"), F.col("year_actual").alias("transaction_year"))
        .agg(F.sum("value").cast("decimal(38,8)").alias("total_value_transacted_usd"))
    )
