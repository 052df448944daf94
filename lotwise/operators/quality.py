"""Data-quality reports. Filters and aggregates come first, joins see only what is left."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions.expressions import as_date, value_usd
from lotwise.operators.holdings import holdings_net
from lotwise.vocabulary import (
    EXCHANGE_TYPES, OUTLIER_HIGH, OUTLIER_LOW, PRICED_TX_TYPES, STALE_AFTER_DAYS, STORED_TX_TYPES,
)


def dq_missing_or_zero_price(tx: DataFrame, cryptos: DataFrame) -> DataFrame:
    price = F.col("price_per_unit_usd")
    return (
        tx.filter(F.col("tx_type").isin(*PRICED_TX_TYPES) & (price.isNull() | (price <= 0)))
        .join(cryptos, "crypto_id")
        .select("tx_id", "tx_type", "symbol", "tx_timestamp", "quantity", "price_per_unit_usd", "notes")
    )


def dq_outlier_value(
    tx: DataFrame, cryptos: DataFrame, high: float = OUTLIER_HIGH, low: str = OUTLIER_LOW
) -> DataFrame:
    value = F.col("transaction_value_usd")
    return (
        tx.withColumn("transaction_value_usd", value_usd())
        .filter((value > high) | ((value > 0) & (value < F.lit(low).cast("decimal(18,8)"))))
        .join(cryptos, "crypto_id")
        .select("tx_id", "tx_type", "symbol", "tx_timestamp", "transaction_value_usd", "notes")
    )


def _orphans(tx: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Ids are made distinct before the join: the ledger itself is not shuffled to the dimension."""
    return tx.select(key).filter(F.col(key).isNotNull()).distinct().join(dimension, key, "left_anti")


def dq_orphan_crypto(tx: DataFrame, cryptos: DataFrame) -> DataFrame:
    return _orphans(tx, cryptos, "crypto_id").select(F.col("crypto_id").alias("missing_crypto_id_in_transactions"))


def dq_orphan_exchange(tx: DataFrame, exchanges: DataFrame) -> DataFrame:
    return _orphans(tx, exchanges, "exchange_id").select(
        F.col("exchange_id").alias("missing_exchange_id_in_transactions")
    )


def dq_stale_prices(
    tx: DataFrame, cryptos: DataFrame, prices: DataFrame, as_of: dt.date | str, days: int = STALE_AFTER_DAYS
) -> DataFrame:
    oldest = F.lit(as_date(as_of) - dt.timedelta(days=days))
    last = prices.groupBy("crypto_id").agg(F.max("price_date").alias("last_price_update"))
    return (
        holdings_net(tx)
        .join(last, "crypto_id", "left")
        .filter(F.col("last_price_update").isNull() | (F.col("last_price_update") < oldest))
        .join(cryptos, "crypto_id")
        .select("symbol", "name", "holding_quantity", "last_price_update")
    )


def dq_price_gaps(prices: DataFrame, cryptos: DataFrame, crypto_id: int | None = None) -> DataFrame:
    """Days without a price between an asset's first and last one; all assets unless one is given.

    Each price row lists the days up to the next one, so no calendar is joined and one shuffle is enough.
    """
    rows = prices if crypto_id is None else prices.filter(F.col("crypto_id") == crypto_id)
    following = F.lead("price_date").over(Window.partitionBy("crypto_id").orderBy("price_date"))
    return (
        rows.select("crypto_id", "price_date", following.alias("following"))
        .filter(F.datediff("following", "price_date") > 1)
        .select(
            "crypto_id",
            F.explode(F.sequence(F.date_add("price_date", 1), F.date_sub("following", 1))).alias("missing_price_date"),
        )
        .join(cryptos, "crypto_id", "inner" if crypto_id is None else "left")
        .select("symbol", "missing_price_date")
    )


def dq_unmapped_dates(tx: DataFrame, dim_date: DataFrame) -> DataFrame:
    # Distinct days: the broadcast is bounded by the calendar's range, the ledger stays where it is.
    days = F.broadcast(dim_date.select(F.col("full_date").alias("tx_date")).distinct())
    return (
        tx.select("tx_id", "tx_timestamp", F.to_date("tx_timestamp").alias("tx_date"))
        .join(days, "tx_date", "left_anti")
        .select("tx_id", "tx_timestamp")
    )


def dq_constraint_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """rule, key, n: what the declared constraints of the five tables would have refused.

    n is the number of rows of a key. NULLs are exempt from UNIQUE, CHECK and reference rules. Every table is read once:
    each row says which rules it breaks, which keys it has and what it refers to, and one grouping by rule and key, added
    up before its shuffle, shows keys that come twice and references that nothing fulfils.
    """
    cryptos, exchanges, categories, tx, prices = (
        tables[t] for t in ("cryptocurrencies", "exchanges", "transaction_categories", "transactions", "historical_prices")
    )
    rules: list[str] = []
    said = [
        _sayings(
            rules, cryptos, "cryptocurrencies", unique=(("crypto_id",), ("symbol",)), not_null=("crypto_id", "symbol", "name"),
            longest={"symbol": 10, "name": 100},
            fulfils={"crypto_id": ("reference transactions(crypto_id)", "reference historical_prices(crypto_id)")},
        ),
        _sayings(
            rules, exchanges, "exchanges", unique=(("exchange_id",), ("name",)), not_null=("exchange_id", "name", "exchange_type"),
            allowed={"exchange_type": EXCHANGE_TYPES}, longest={"name": 100, "exchange_type": 20},
            fulfils={"exchange_id": ("reference transactions(exchange_id)",)},
        ),
        _sayings(
            rules, categories, "transaction_categories", unique=(("category_id",), ("name",)), not_null=("category_id", "name"),
            longest={"name": 50}, fulfils={"category_id": ("reference transactions(category_id)",)},
        ),
        _sayings(
            rules, tx, "transactions", unique=(("tx_id",),),
            not_null=("tx_id", "crypto_id", "tx_type", "quantity", "tx_timestamp"),
            allowed={"tx_type": STORED_TX_TYPES}, longest={"tx_type": 20},
            references=("crypto_id", "exchange_id", "category_id"),
        ),
        _sayings(
            rules, prices, "historical_prices", unique=(("price_id",), ("crypto_id", "price_date")),
            not_null=("price_id", "crypto_id", "price_date", "close_price_usd"), references=("crypto_id",),
        ),
    ]
    every = said[0]
    for more in said[1:]:
        every = every.unionByName(more)
    broken = (F.col("kind") == _BROKEN) | ((F.col("kind") == _UNIQUE) & (F.col("n") > 1))
    return (
        every.groupBy("rule", "key", "kind")
        .agg(F.sum("rows").alias("n"), F.max(F.col("rows") == 0).alias("fulfilled"))
        .filter(broken | ((F.col("kind") == _REFERENCE) & ~F.col("fulfilled")))
        .select(F.get(F.array(*[F.lit(r) for r in rules]), F.col("rule")).alias("rule"), "key", "n")
    )


_BROKEN, _UNIQUE, _REFERENCE = range(3)


def _sayings(
    rules: list[str], df: DataFrame, table: str, unique: tuple[tuple[str, ...], ...] = (), not_null: tuple[str, ...] = (),
    allowed: dict[str, tuple[str, ...]] | None = None, longest: dict[str, int] | None = None,
    references: tuple[str, ...] = (), fulfils: dict[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """rule, key, kind, rows: what each row has to say to the rules, in one pass. A rule is its place in ``rules``.

    A row that breaks a rule, or has a key, or refers to one, counts 1; one that fulfils references counts 0.
    """

    def say(rule: str, kind: int, key: Column, when: Column, rows: int = 1) -> Column:
        if rule not in rules:
            rules.append(rule)
        said = F.struct(F.lit(rules.index(rule)).alias("rule"), key.cast("string").alias("key"), F.lit(kind).alias("kind"), F.lit(rows).cast("bigint").alias("rows"))
        return F.when(when, said)

    def known(*columns: str) -> Column:
        whole = F.lit(True)
        for c in columns:
            whole = whole & F.col(c).isNotNull()
        return whole

    entries = [say(f"unique {table}({','.join(keys)})", _UNIQUE, F.concat_ws("|", *keys), known(*keys)) for keys in unique]
    entries += [say(f"not null {table}({c})", _BROKEN, F.lit(None), F.col(c).isNull()) for c in not_null]
    entries += [say(f"check {table}({c})", _BROKEN, F.col(c), ~F.col(c).isin(*values)) for c, values in (allowed or {}).items()]
    entries += [say(f"length {table}({c})", _BROKEN, F.col(c), F.char_length(c) > n) for c, n in (longest or {}).items()]
    entries += [say(f"reference {table}({c})", _REFERENCE, F.col(c), known(c)) for c in references]
    entries += [say(rule, _REFERENCE, F.col(c), known(c), rows=0) for c, rules in (fulfils or {}).items() for rule in rules]
    return df.select(F.inline(F.array_compact(F.array(*entries))))
