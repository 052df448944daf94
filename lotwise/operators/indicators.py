"""Rolling indicators over the daily price series.

Windows run per asset. A series has one row per calendar day at most (unique asset and date, reported
by ``dq_constraint_violations``), so a window holds thousands of rows however large the table is; the
hot-asset split of the tax lots is not needed here. The window comes before the join with the asset
names, and that join reuses its partitioning when it does not broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lotwise.functions.expressions import ratio
from lotwise.vocabulary import BENCHMARK_SYMBOL, MIN_COMMON_DAYS


def _by_day() -> WindowSpec:
    return Window.partitionBy("crypto_id").orderBy("price_date")


def _close() -> Column:
    return F.col("close_price_usd")


def _last_rows(n: int) -> WindowSpec:
    return _by_day().rowsBetween(1 - n, 0)


def _full_frame(value: Column, source: Column, n: int) -> Column:
    """value once the last n rows are all there; frames count rows, gaps in the dates do not matter."""
    return F.when(F.count(source).over(_last_rows(n)) == n, value)


def _series(prices: DataFrame) -> DataFrame:
    return prices.select("crypto_id", "price_date", "close_price_usd")


def moving_averages(prices: DataFrame, cryptos: DataFrame) -> DataFrame:
    rolled = _series(prices).select(
        "*",
        *[
            _full_frame(F.avg(_close()).over(_last_rows(n)), _close(), n).alias(f"sma_{n}_day")
            for n in (7, 30)
        ],
    )
    return rolled.join(cryptos, "crypto_id").select(
        "symbol", "name", "price_date", "close_price_usd", "sma_7_day", "sma_30_day"
    )


def _changes(prices: DataFrame) -> DataFrame:
    """The first row of a series has no predecessor and counts as no change."""
    diff = _close() - F.coalesce(F.lag("close_price_usd").over(_by_day()), _close())
    zero = F.lit(0).cast("decimal(19,8)")
    return (
        _series(prices)
        .withColumn("price_diff", diff)
        .withColumn("gain", F.greatest(zero, F.col("price_diff")))
        .withColumn("loss", F.greatest(zero, -F.col("price_diff")))
    )


def price_changes(prices: DataFrame, cryptos: DataFrame) -> DataFrame:
    return _changes(prices).join(cryptos, "crypto_id").select(
        "crypto_id", "symbol", "name", "price_date", "close_price_usd", "price_diff", "gain", "loss"
    )


def rsi_14(prices: DataFrame, cryptos: DataFrame, periods: int = 14) -> DataFrame:
    """Relative strength by simple averages. Without any loss in the frame the index is 100."""
    frame = _last_rows(periods)
    gain, loss = F.col("avg_gain_14"), F.col("avg_loss_14")
    strength = ratio(gain, loss)
    return (
        _changes(prices)
        .select(
            "*",
            F.row_number().over(_by_day()).alias("nth"),
            F.avg("gain").over(frame).alias("avg_gain_14"),
            F.avg("loss").over(frame).alias("avg_loss_14"),
        )
        .filter(F.col("nth") >= periods)
        .join(cryptos, "crypto_id")
        .select(
            "symbol", "name", "price_date", "close_price_usd", "price_diff", "gain", "loss",
            "avg_gain_14", "avg_loss_14",
            strength.alias("rs_14"),
            F.when(loss == 0, F.lit(100).cast("decimal(5,2)"))
            .otherwise(F.round(100 - 100 / (1 + strength), 2).cast("decimal(5,2)"))
            .alias("rsi_14"),
        )
    )


def _returns(prices: DataFrame) -> DataFrame:
    previous = F.lag("close_price_usd").over(_by_day())
    return (
        _series(prices)
        .withColumn("prev_day_close_price_usd", previous)
        .withColumn(
            "daily_pct_return",
            ratio(_close() - F.col("prev_day_close_price_usd"), F.col("prev_day_close_price_usd")),
        )
    )


def daily_returns(prices: DataFrame, cryptos: DataFrame) -> DataFrame:
    return _returns(prices).join(cryptos, "crypto_id").select(
        "crypto_id", "symbol", "price_date", "close_price_usd", "prev_day_close_price_usd", "daily_pct_return"
    )


def price_volatility_30day(prices: DataFrame, cryptos: DataFrame) -> DataFrame:
    """Sample deviation of the last 30 valid returns: rows without a return leave before the frame is built."""
    change = F.col("daily_pct_return")
    deviation = F.round(F.stddev_samp("daily_pct_return").over(_last_rows(30)), 6).cast("decimal(20,6)")
    return (
        _returns(prices)
        .filter(change.isNotNull())
        .withColumn("volatility_30day_stddev_returns", _full_frame(deviation, change, 30))
        .join(cryptos, "crypto_id")
        .select("symbol", "price_date", "close_price_usd", "daily_pct_return", "volatility_30day_stddev_returns")
    )


def price_correlation_with_btc(
    prices: DataFrame, cryptos: DataFrame, benchmark: str = BENCHMARK_SYMBOL
) -> DataFrame:
    """Pearson correlation of each asset's closes with the benchmark's, over the dates both have.

    The benchmark's series is one row per calendar day (symbols and asset-dates are unique), so
    broadcasting it is bounded, and the price table is not shuffled for the join.
    """
    reference = (
        prices.join(cryptos.filter(F.col("symbol") == benchmark).select("crypto_id"), "crypto_id", "left_semi")
        .select("price_date", _close().cast("double").alias("benchmark_close"))
    )
    x, y = _close().cast("double"), F.col("benchmark_close")
    # A constant series has no correlation; the built-in corr would divide by zero in ANSI mode.
    corr = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return (
        prices.join(F.broadcast(reference), "price_date")
        .groupBy("crypto_id")
        .agg(F.count("price_date").alias("common_data_points_with_btc"), corr.alias("corr"))
        .filter(F.col("common_data_points_with_btc") > MIN_COMMON_DAYS)
        .join(cryptos.filter(F.col("symbol") != benchmark), "crypto_id")
        .select(
            F.col("symbol").alias("asset_symbol"),
            "common_data_points_with_btc",
            F.round("corr", 4).cast("decimal(6,4)").alias("correlation_with_btc"),
        )
    )
