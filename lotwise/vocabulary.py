"""Fixed values of the ledger domain."""

# Transaction types that add to, or take from, a holding. Any other type adds nothing.
INFLOW_TYPES = (
    "BUY",
    "TRANSFER_IN",
    "DEPOSIT",
    "AIRDROP",
    "STAKING_REWARD",
    "MINING_REWARD",
    "INTEREST_REWARD",
    "LENDING_REWARD",
    "GIFT_RECEIVED",
    "OTHER_INCOME",
)
OUTFLOW_TYPES = (
    "SELL",
    "TRANSFER_OUT",
    "WITHDRAWAL",
    "FEE_PAYMENT",
    "GIFT_SENT",
    "OTHER_EXPENSE",
)

# What the ledger's own constraint admits, and the venue kinds.
STORED_TX_TYPES = ("BUY", "SELL", "DEPOSIT", "WITHDRAWAL")
EXCHANGE_TYPES = ("EXCHANGE", "WALLET", "OTHER")

# Fixed value: amounts must exceed this to count. Quantities carry 8 decimals, so it means "above zero".
DUST = "0.000000000000000001"

# USD buckets (upper bound inclusive, label); None is open-ended.
VALUE_BUCKETS = (
    (100, "000 - $0 - $100"),
    (500, "001 - $101 - $500"),
    (1000, "002 - $501 - $1,000"),
    (5000, "003 - $1,001 - $5,000"),
    (10000, "004 - $5,001 - $10,000"),
    (None, "005 - > $10,000"),
)

# Outlier limits in USD, price types that need a price, staleness and sample limits.
OUTLIER_HIGH = 1000000
OUTLIER_LOW = "0.01"
PRICED_TX_TYPES = ("BUY", "SELL", "FEE_PAYMENT")
STALE_AFTER_DAYS = 7
MIN_COMMON_DAYS = 30
BENCHMARK_SYMBOL = "BTC"

# Default calendar.
CALENDAR_START = "2018-01-01"
CALENDAR_END = "2027-12-31"
