"""Declared schemas of the ledger, the price series, the audit log and the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUANTITY = T.DecimalType(18, 8)
PRICE = T.DecimalType(18, 8)
FEE = T.DecimalType(10, 4)
VOLUME = T.DecimalType(24, 2)
WIDE_QUANTITY = T.DecimalType(28, 18)
WIDE_PRICE = T.DecimalType(24, 8)
WIDE_VALUE = T.DecimalType(30, 8)
WIDE_FEE = T.DecimalType(18, 8)
CENTS = T.DecimalType(30, 2)
PERCENT = T.DecimalType(20, 2)
# A net holding times a price: keeps 27 integer digits and 11 decimals within Spark's 38 digits.
NET_HOLDING = T.DecimalType(24, 8)


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, nullable) for name, dtype, nullable in fields])


_INT, _LONG, _STR, _DATE, _TS, _BOOL = (
    T.IntegerType(), T.LongType(), T.StringType(), T.DateType(), T.TimestampType(), T.BooleanType(),
)

# Table layouts. Third item: nullable.
CRYPTOCURRENCIES = _struct(("crypto_id", _LONG, False), ("symbol", _STR, False), ("name", _STR, False))
EXCHANGES = _struct(("exchange_id", _LONG, False), ("name", _STR, False), ("exchange_type", _STR, False))
TRANSACTION_CATEGORIES = _struct(("category_id", _LONG, False), ("name", _STR, False), ("description", _STR, True))
TRANSACTIONS = _struct(
    ("tx_id", _LONG, False), ("crypto_id", _LONG, False), ("exchange_id", _LONG, True), ("category_id", _LONG, True),
    ("tx_type", _STR, False), ("quantity", QUANTITY, False), ("price_per_unit_usd", PRICE, True),
    ("tx_timestamp", _TS, False), ("fee_usd", FEE, True), ("notes", _STR, True),
)
HISTORICAL_PRICES = _struct(
    ("price_id", _LONG, False), ("crypto_id", _LONG, False), ("price_date", _DATE, False),
    ("close_price_usd", PRICE, False), ("open_price_usd", PRICE, True), ("high_price_usd", PRICE, True),
    ("low_price_usd", PRICE, True), ("volume_usd", VOLUME, True),
)
TABLES = {
    "cryptocurrencies": CRYPTOCURRENCIES,
    "exchanges": EXCHANGES,
    "transaction_categories": TRANSACTION_CATEGORIES,
    "transactions": TRANSACTIONS,
    "historical_prices": HISTORICAL_PRICES,
}
AUDIT_IMAGE = _struct(
    ("tx_id", _LONG, True), ("crypto_id", _LONG, True), ("exchange_id", _LONG, True), ("category_id", _LONG, True),
    ("tx_type", _STR, True), ("quantity", WIDE_QUANTITY, True), ("price_per_unit_usd", WIDE_PRICE, True),
    ("tx_timestamp", _TS, True), ("fee_usd", WIDE_FEE, True), ("notes", _STR, True),
)
AUDIT_HISTORY = T.StructType(
    [T.StructField("audit_id", _LONG), T.StructField("operation_type", _STR), T.StructField("operation_timestamp", _TS)]
    + AUDIT_IMAGE.fields
)
DIM_DATE = _struct(
    ("date_key", _INT, False), ("full_date", _DATE, False), ("year_actual", _INT, False),
    ("quarter_actual", _INT, False), ("month_actual", _INT, False), ("month_name", _STR, False),
    ("day_of_month", _INT, False), ("day_of_week_iso", _INT, False), ("day_name", _STR, False),
    ("week_of_year_iso", _INT, False), ("is_weekday", _BOOL, False), ("is_weekend", _BOOL, False),
)
DIM_CRYPTOCURRENCY = _struct(
    ("crypto_key", _LONG, True), ("crypto_id_original", _LONG, True), ("symbol", _STR, True), ("name", _STR, True),
    ("is_stablecoin", _BOOL, True),
)
DIM_EXCHANGE = _struct(
    ("exchange_key", _LONG, True), ("exchange_id_original", _LONG, True), ("exchange_name", _STR, True),
    ("exchange_type", _STR, True),
)
DIM_TRANSACTION_CATEGORY = _struct(
    ("category_key", _LONG, True), ("category_id_original", _LONG, True), ("category_name", _STR, True),
    ("category_description", _STR, True),
)
FACT_TRANSACTIONS = _struct(
    ("transaction_key", _LONG, True), ("tx_id_original", _LONG, True), ("date_key", _INT, True),
    ("time_of_day", _STR, True), ("crypto_key", _LONG, True), ("exchange_key", _LONG, True),
    ("category_key", _LONG, True), ("tx_type", _STR, True), ("quantity", WIDE_QUANTITY, True),
    ("price_per_unit_usd", WIDE_PRICE, True), ("transaction_value_usd", WIDE_VALUE, True), ("fee_usd", WIDE_FEE, True),
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast the schema's columns, in its order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
