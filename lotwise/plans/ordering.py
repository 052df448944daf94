"""Presentation order of the reports.

Operators return sets of rows. Sorting a row-level result as a whole costs a range shuffle of all of it, so it
is asked for by name, with a unique last key where the leading ones can tie.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Sort keys per report. A leading "-" sorts downwards (NULLs last), "|x|" is the absolute value.
REPORT_ORDER = {
    "current_holdings": ["symbol"],
    "historical_holdings_by_date": ["symbol"],
    "get_historical_holdings": ["symbol"],
    "read_mv_current_holdings": ["symbol"],
    "portfolio_value_breakdown": ["-current_market_value_usd", "symbol"],
    "current_asset_allocation": ["-current_market_value_usd", "symbol"],
    "transaction_frequency_by_month": ["-year_month"],
    "transactions_per_month": ["-transaction_year_month"],
    "average_purchase_price_by_asset": ["symbol"],
    "transaction_analysis_by_exchange": ["-total_transactions", "exchange_name"],
    "transaction_value_distribution": ["value_range"],
    "fee_by_exchange": ["-total_fees_paid_usd_on_exchange", "exchange_name"],
    "fee_by_asset": ["-total_fees_paid_usd_for_asset_transactions", "crypto_symbol"],
    "most_active_cryptos": ["-total_transaction_count", "symbol"],
    "price_range_check": ["symbol"],
    "moving_averages": ["symbol", "-price_date"],
    "rsi_14": ["symbol", "-price_date"],
    "price_volatility_30day": ["symbol", "-price_date"],
    "price_correlation_with_btc": ["-|correlation_with_btc|", "asset_symbol"],
    "fifo_realized_single_asset": [
        "sell_timestamp", "sell_tx_id", "matched_buy_lot_timestamp", "matched_buy_lot_tx_id",
    ],
    "fifo_summary_per_sale_single_asset": ["sell_timestamp", "sell_tx_id"],
    "fifo_summary_per_sale_all_assets": ["symbol", "sell_timestamp", "sell_tx_id"],
    "fifo_annual_single_asset": ["symbol", "tax_year"],
    "fifo_annual_all_assets": ["symbol", "tax_year"],
    "tax_lot_inventory_current": ["symbol", "buy_timestamp", "buy_tx_id"],
    "dq_missing_or_zero_price": ["-tx_timestamp", "tx_id"],
    "dq_outlier_value": ["-|transaction_value_usd|", "tx_id"],
    "dq_stale_prices": ["symbol"],
    "dq_price_gaps": ["symbol", "missing_price_date"],
    "view_monthly_crypto_transaction_summary": ["-year_month", "crypto_symbol", "crypto_name"],
    "value_by_symbol_year": ["crypto_symbol", "transaction_year"],
}


def in_report_order(name: str, df: DataFrame) -> DataFrame:
    keys = []
    for key in REPORT_ORDER.get(name, []):
        column = F.col(key.strip("-|"))
        column = F.abs(column) if "|" in key else column
        keys.append(column.desc_nulls_last() if key.startswith("-") else column.asc())
    return df.orderBy(*keys) if keys else df
