"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotwise.schemas import PERCENT
from lotwise.vocabulary import DUST, INFLOW_TYPES, OUTFLOW_TYPES


def signed_quantity() -> Column:
    """+quantity for inflow types, -quantity for outflow types, 0 for any other."""
    q = F.col("quantity")
    return (
        F.when(F.col("tx_type").isin(*INFLOW_TYPES), q)
        .when(F.col("tx_type").isin(*OUTFLOW_TYPES), -q)
        .otherwise(F.lit(0).cast("decimal(18,8)"))
    )


def moves_holdings() -> Column:
    return F.col("tx_type").isin(*INFLOW_TYPES, *OUTFLOW_TYPES)


def above_dust(c: Column) -> Column:
    return c > F.lit(DUST).cast("decimal(18,18)")


def as_date(value: dt.date | str) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def by_end_of(day: dt.date | str) -> Column:
    """True for ledger rows up to the end of the day; a plain comparison, so it reaches the Parquet reader."""
    return F.col("tx_timestamp") < F.lit(as_date(day) + dt.timedelta(days=1)).cast("timestamp")


def value_usd() -> Column:
    """quantity x price: (18,8) x (18,8) is exact in (37,16)."""
    return F.col("quantity") * F.col("price_per_unit_usd")


def ratio(num: Column, den: Column) -> Column:
    """num / den in double precision, NULL where den is 0 or NULL.

    Spark caps decimals at 38 digits and would leave as few as 6 decimals in a quotient of sums;
    doubles keep 15 to 17 significant digits.
    """
    den = den.cast("double")
    return F.when(den != 0, num.cast("double") / den)


def percent(num: Column, den: Column) -> Column:
    """num / den as a percentage with two decimals, NULL where den is 0 or NULL."""
    return F.round(ratio(num, den) * 100, 2).cast(PERCENT)


def count_if(condition: Column) -> Column:
    return F.coalesce(F.sum(condition.cast("bigint")), F.lit(0).cast("bigint"))


def is_type(tx_type: str) -> Column:
    return F.col("tx_type") == tx_type
