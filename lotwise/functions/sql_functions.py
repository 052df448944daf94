"""The two date functions for SQL callers, as SQL functions that Catalyst inlines into the calling query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lotwise.vocabulary import INFLOW_TYPES, OUTFLOW_TYPES


# The functions' views must not replace views of the caller.
VIEW_PREFIX = "lotwise_"


def _listed(types: tuple[str, ...]) -> str:
    return ", ".join(f"'{t}'" for t in types)


def register_sql_functions(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Registers the tables as temp views with a prefix of their own, ``get_historical_holdings(date)`` as a table function and
    ``get_portfolio_value_at_date(date)`` as a scalar one."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{VIEW_PREFIX}{name}")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION get_historical_holdings(p_target_date DATE)
        RETURNS TABLE (crypto_id BIGINT, symbol STRING, name STRING, historical_holding_quantity DECIMAL(28,18))
        RETURN
          SELECT a.crypto_id, a.symbol, a.name, CAST(net.held AS DECIMAL(28,18))
          FROM {VIEW_PREFIX}cryptocurrencies a
          JOIN (SELECT crypto_id,
                       SUM(CASE WHEN tx_type IN ({_listed(OUTFLOW_TYPES)}) THEN -quantity ELSE quantity END) AS held
                FROM {VIEW_PREFIX}transactions
                WHERE tx_type IN ({_listed(INFLOW_TYPES + OUTFLOW_TYPES)})
                  AND tx_timestamp < CAST(DATE_ADD(get_historical_holdings.p_target_date, 1) AS TIMESTAMP)
                GROUP BY crypto_id) net
            ON net.crypto_id = a.crypto_id
          WHERE net.held > 0
    """)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION get_portfolio_value_at_date(p_target_date DATE)
        RETURNS DECIMAL(30,2)
        RETURN
          SELECT CAST(COALESCE(SUM(CAST(h.historical_holding_quantity AS DECIMAL(24,8))
                                   * COALESCE(p.close_price_usd, 0)), 0) AS DECIMAL(30,2))
          FROM get_historical_holdings(get_portfolio_value_at_date.p_target_date) h
          LEFT JOIN {VIEW_PREFIX}historical_prices p
            ON p.crypto_id = h.crypto_id AND p.price_date = get_portfolio_value_at_date.p_target_date
    """)
