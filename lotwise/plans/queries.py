"""The registered queries: every operator over the whole of the given tables.

A callable takes (spark, folder of the given tables) and returns a DataFrame. Quotients are doubles and are
rounded to six decimals here, so that two engines agree on them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from lotwise.functions.sql_functions import register_sql_functions
from lotwise.operators import (
    audit, fifo, holdings, indicators, keys, ledger_edits, quality, statistics, valuation, warehouse,
)
from lotwise.plans.ordering import in_report_order
from lotwise.schemas import (
    AUDIT_IMAGE, DIM_CRYPTOCURRENCY, DIM_EXCHANGE, DIM_TRANSACTION_CATEGORY, FACT_TRANSACTIONS, TABLES,
)
from lotwise.session import shared_dir
from lotwise.sources import csv_ledger, snapshots
from lotwise.sources.tpch_ledger import LedgerTables
from lotwise.streaming import audit_stream

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the runs.
AS_OF = "2001-08-01"
START, END = "2000-01-08", "2001-08-01"
TARGET_ASSET = 0
LATE_FROM = "2001-01-01"
STAKING_CLOSED = "1996-01-01"
EARLIER_LOAD_UNTIL = "2000-01-01"
ONE_MONTH = ("2000-03-01", "2000-03-31")
LOGGED_AT = dt.datetime(2001, 8, 1, 12, 0, 0)


class _Run(LedgerTables):
    """The tables of one run, with what several queries derive from them.

    Dimensions are stored before the fact is built, as in any load: Spark then knows their size when it plans
    the lookups, and broadcasts the small ones instead of shuffling the ledger once per dimension.
    """

    def stored(self, name: str, df: DataFrame) -> DataFrame:
        path = shared_dir(self.spark, name)
        snapshots.save_table(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def dimensions(self) -> dict[str, DataFrame]:
        """The four dimensions of a first load. The loads do not depend on each other and run side by side."""
        empty = warehouse.empty_table
        loads = {
            "dim_date": warehouse.calendar_covering(self.movements),
            "dim_cryptocurrency": warehouse.upsert_dim_cryptocurrency(
                self.cryptocurrencies, empty(self.spark, DIM_CRYPTOCURRENCY)
            ),
            "dim_exchange": warehouse.upsert_dim_exchange(self.exchanges, empty(self.spark, DIM_EXCHANGE)),
            "dim_transaction_category": warehouse.upsert_dim_transaction_category(
                self.transaction_categories, empty(self.spark, DIM_TRANSACTION_CATEGORY)
            ),
        }
        with ThreadPoolExecutor(len(loads)) as pool:
            return dict(zip(loads, pool.map(self.stored, loads, loads.values())))

    @property
    def dim_date(self) -> DataFrame:
        return self.dimensions["dim_date"]

    @property
    def dim_crypto(self) -> DataFrame:
        return self.dimensions["dim_cryptocurrency"]

    @property
    def dim_exchange(self) -> DataFrame:
        return self.dimensions["dim_exchange"]

    @property
    def dim_category(self) -> DataFrame:
        return self.dimensions["dim_transaction_category"]

    def fact_rows(self, tx: DataFrame | None = None, dim_date: DataFrame | None = None) -> DataFrame:
        return warehouse.fact_rows(
            tx if tx is not None else self.transactions, dim_date if dim_date is not None else self.dim_date,
            self.dim_crypto, self.dim_exchange, self.dim_category,
        )

    def ledger(self, rows: DataFrame, dealt: bool = False) -> DataFrame:
        """A snapshot of the ledger, stored by month."""
        path = shared_dir(self.spark, "ledger")
        snapshots.save_ledger(rows, path, dealt)
        return snapshots.read_ledger(self.spark, path)

    @cached_property
    def booked(self) -> DataFrame:
        """The ledger, computed once and stored, for loads that read it several times."""
        return self.stored("booked", self.transactions)

    @cached_property
    def whole_by_month(self) -> DataFrame:
        """The ledger, computed once and stored by month. What came before the late rows and these are read from it."""
        return self.ledger(self.transactions)

    @property
    def before_by_month(self) -> DataFrame:
        """The stored ledger before its late rows arrived."""
        return self.whole_by_month.filter(F.col("tx_timestamp") < F.lit(LATE_FROM).cast("timestamp"))

    @property
    def before(self) -> DataFrame:
        return self.before_by_month.drop(audit.MONTH)

    @cached_property
    def after_by_month(self) -> DataFrame:
        """The next snapshot, after inserts, updates and deletes."""
        late = self.whole_by_month.filter(F.col("tx_timestamp") >= F.lit(LATE_FROM).cast("timestamp")).drop(audit.MONTH)
        closed = F.lit(STAKING_CLOSED).cast("timestamp")
        step = ledger_edits.update_rows(
            self.before, F.col("exchange_id").isNull(), {"notes": F.lit("venue unknown"), "fee_usd": F.lit(1.25)}
        )
        step = ledger_edits.delete_rows(step, (F.col("tx_type") == "STAKING_REWARD") & (F.col("tx_timestamp") < closed))
        return self.ledger(ledger_edits.insert_rows(step, late), dealt=True)

    @property
    def after(self) -> DataFrame:
        return self.after_by_month.drop(audit.MONTH)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), 6) for c in columns})


def _on(build: Callable[[_Run], DataFrame], *ratios: str, order: str | None = None) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        df = _rounded(build(_Run(spark, folder)), *ratios)
        return in_report_order(order, df) if order else df

    return run


# --- holdings, valuation -------------------------------------------------------------------------------------

def _holdings() -> dict[str, Query]:
    growth = (
        "portfolio_percentage_growth", "btc_units_hypothetically_bought", "btc_hypothetical_end_value",
        "btc_hypothetical_absolute_gain_loss", "btc_hypothetical_percentage_growth",
        "outperformance_vs_btc_pct_points",
    )
    return {
        "table_row_counts": _on(lambda t: statistics.table_row_counts(t.as_dict())),
        "current_holdings": _on(
            lambda t: holdings.current_holdings(t.movements, t.cryptocurrencies), order="current_holdings"
        ),
        "historical_holdings_by_date": _on(
            lambda t: holdings.historical_holdings_by_date(t.trades_in(until=AS_OF), t.cryptocurrencies, AS_OF),
            order="historical_holdings_by_date",
        ),
        "get_historical_holdings": _on(
            lambda t: holdings.get_historical_holdings(t.trades_in(until=AS_OF), t.cryptocurrencies, AS_OF),
            order="get_historical_holdings",
        ),
        "get_historical_holdings_sql": _sql_holdings,
        "holdings_net": _on(lambda t: holdings.holdings_net(t.movements)),
        "holdings_at_dates": _on(lambda t: holdings.holdings_at_dates(t.trades_in(until=END), [START, "2000-12-31", END])),
        "latest_prices": _on(lambda t: valuation.latest_prices(t.historical_prices)),
        "prices_on_date": _on(lambda t: valuation.prices_on_date(t.historical_prices, AS_OF)),
        "prices_as_of": _on(lambda t: valuation.prices_as_of(t.historical_prices, AS_OF)),
        "current_portfolio_value": _on(
            lambda t: valuation.current_portfolio_value(t.movements, t.cryptocurrencies, t.historical_prices)
        ),
        "portfolio_value_breakdown": _on(
            lambda t: valuation.portfolio_value_breakdown(t.movements, t.cryptocurrencies, t.historical_prices),
            order="portfolio_value_breakdown",
        ),
        "current_asset_allocation": _on(
            lambda t: valuation.current_asset_allocation(t.movements, t.cryptocurrencies, t.historical_prices),
            "allocation_percentage", order="current_asset_allocation",
        ),
        "portfolio_value_change_daily": _on(
            lambda t: valuation.portfolio_value_change_daily(t.movements, t.historical_prices, AS_OF),
            "percentage_change",
        ),
        "portfolio_value_change_between_dates": _on(
            lambda t: valuation.portfolio_value_change_between_dates(t.trades_in(until=END), t.historical_prices, START, END),
            "percentage_change",
        ),
        "get_portfolio_value_at_date": _on(
            lambda t: valuation.get_portfolio_value_at_date(t.trades_in(until=AS_OF), t.cryptocurrencies, t.historical_prices, AS_OF)
        ),
        "get_portfolio_value_at_date_sql": _sql_value,
        "portfolio_vs_btc_benchmark": _on(
            lambda t: valuation.portfolio_vs_btc_benchmark(t.trades_in(until=END), t.historical_prices, START, END, TARGET_ASSET),
            *growth,
        ),
    }


def _sql_tables(t: _Run) -> dict[str, DataFrame]:
    return {
        "transactions": t.movements, "cryptocurrencies": t.cryptocurrencies, "historical_prices": t.historical_prices,
    }


def _sql_holdings(spark: SparkSession, folder: str) -> DataFrame:
    register_sql_functions(spark, _sql_tables(_Run(spark, folder)))
    return spark.sql(f"SELECT * FROM get_historical_holdings(DATE '{AS_OF}') ORDER BY symbol")


def _sql_value(spark: SparkSession, folder: str) -> DataFrame:
    register_sql_functions(spark, _sql_tables(_Run(spark, folder)))
    return spark.sql(f"SELECT get_portfolio_value_at_date(DATE '{AS_OF}') AS portfolio_value_usd")


# --- statistics ----------------------------------------------------------------------------------------------

def _statistics() -> dict[str, Query]:
    return {
        "transaction_frequency_by_month": _on(
            lambda t: statistics.transaction_frequency_by_month(t.movements), order="transaction_frequency_by_month"
        ),
        "average_purchase_price_by_asset": _on(
            lambda t: statistics.average_purchase_price_by_asset(t.movements, t.cryptocurrencies),
            "weighted_average_purchase_price_usd", order="average_purchase_price_by_asset",
        ),
        "transaction_analysis_by_exchange": _on(
            lambda t: statistics.transaction_analysis_by_exchange(t.placed_movements, t.exchanges),
            order="transaction_analysis_by_exchange",
        ),
        "transaction_value_distribution": _on(
            lambda t: statistics.transaction_value_distribution(t.movements), order="transaction_value_distribution"
        ),
        "fee_by_exchange": _on(
            lambda t: statistics.fee_by_exchange(t.placed_movements, t.exchanges), order="fee_by_exchange"
        ),
        "fee_by_asset": _on(lambda t: statistics.fee_by_asset(t.movements, t.cryptocurrencies), order="fee_by_asset"),
        "transactions_per_month": _on(
            lambda t: statistics.transactions_per_month(t.movements), order="transactions_per_month"
        ),
        "most_active_cryptos": _on(
            lambda t: statistics.most_active_cryptos(t.movements, t.cryptocurrencies), order="most_active_cryptos"
        ),
        "price_range_check": _on(
            lambda t: statistics.price_range_check(t.historical_prices, t.cryptocurrencies),
            "percentage_change", order="price_range_check",
        ),
    }


# --- indicators and tax lots: row-level results, left in the order of the shuffle -----------------------------

def _indicators() -> dict[str, Query]:
    def over(f, *ratios: str) -> Query:
        return _on(lambda t: f(t.historical_prices, t.cryptocurrencies), *ratios)

    return {
        "moving_averages": over(indicators.moving_averages, "sma_7_day", "sma_30_day"),
        "rsi_14": over(indicators.rsi_14, "avg_gain_14", "avg_loss_14", "rs_14", "rsi_14"),
        "price_correlation_with_btc": _on(
            lambda t: indicators.price_correlation_with_btc(t.historical_prices, t.cryptocurrencies),
            "correlation_with_btc", order="price_correlation_with_btc",
        ),
        "price_volatility_30day": over(
            indicators.price_volatility_30day, "daily_pct_return", "volatility_30day_stddev_returns"
        ),
        "daily_returns": over(indicators.daily_returns, "daily_pct_return"),
        "price_changes": over(indicators.price_changes),
    }


def _tax_lots() -> dict[str, Query]:
    return {
        "fifo_buys": _on(lambda t: fifo.fifo_buys(t.trades)),
        "fifo_sells": _on(lambda t: fifo.fifo_sells(t.trades)),
        "fifo_matched_lots": _on(lambda t: fifo.fifo_matched_lots(t.trades)),
        "fifo_realized_single_asset": _on(
            lambda t: fifo.fifo_realized_single_asset(t.trades_of(TARGET_ASSET), t.cryptocurrencies, TARGET_ASSET),
            order="fifo_realized_single_asset",
        ),
        "fifo_summary_per_sale_single_asset": _on(
            lambda t: fifo.fifo_summary_per_sale_single_asset(t.trades_of(TARGET_ASSET), t.cryptocurrencies, TARGET_ASSET),
            order="fifo_summary_per_sale_single_asset",
        ),
        "fifo_annual_single_asset": _on(
            lambda t: fifo.fifo_annual_single_asset(t.trades_of(TARGET_ASSET), t.cryptocurrencies, TARGET_ASSET),
            order="fifo_annual_single_asset",
        ),
        "fifo_summary_per_sale_all_assets": _on(
            lambda t: fifo.fifo_summary_per_sale_all_assets(t.trades, t.cryptocurrencies)
        ),
        "fifo_annual_all_assets": _on(
            lambda t: fifo.fifo_annual_all_assets(t.trades, t.cryptocurrencies), order="fifo_annual_all_assets"
        ),
        "tax_lot_inventory_current": _on(lambda t: fifo.tax_lot_inventory_current(t.trades, t.cryptocurrencies)),
        "buy_lot_consumption": _on(lambda t: fifo.buy_lot_consumption(t.trades)),
    }


# --- data quality --------------------------------------------------------------------------------------------

def _quality() -> dict[str, Query]:
    return {
        "dq_missing_or_zero_price": _on(
            lambda t: quality.dq_missing_or_zero_price(t.trades, t.cryptocurrencies), order="dq_missing_or_zero_price"
        ),
        "dq_outlier_value": _on(lambda t: quality.dq_outlier_value(t.trades, t.cryptocurrencies, high=1_000_000)),
        "dq_orphan_crypto": _on(lambda t: quality.dq_orphan_crypto(t.checked, t.cryptocurrencies)),
        "dq_orphan_exchange": _on(lambda t: quality.dq_orphan_exchange(t.checked, t.exchanges)),
        "dq_stale_prices": _on(
            lambda t: quality.dq_stale_prices(t.movements, t.cryptocurrencies, t.historical_prices, "2001-11-01"),
            order="dq_stale_prices",
        ),
        "dq_price_gaps": _on(lambda t: quality.dq_price_gaps(t.historical_prices, t.cryptocurrencies)),
        "dq_constraint_violations": _on(
            lambda t: quality.dq_constraint_violations(t.as_dict() | {"transactions": t.spoiled})
        ),
        "dq_unmapped_dates": _on(
            lambda t: quality.dq_unmapped_dates(t.checked, warehouse.calendar_covering(t.movements))
        ),
    }


# --- warehouse -----------------------------------------------------------------------------------------------

def _insert_only_load(t: _Run) -> DataFrame:
    """Days of an earlier load carry other names and must keep them."""
    days = t.stored("dim_date", warehouse.calendar_covering(t.movements))
    earlier = days.filter(F.col("full_date") < F.lit(EARLIER_LOAD_UNTIL).cast("date")).withColumn(
        "day_name", F.upper("day_name")
    )
    return warehouse.extend_dim_date(earlier, days)


def _second_load_cryptos(t: _Run) -> DataFrame:
    empty = warehouse.empty_table(t.spark, DIM_CRYPTOCURRENCY)
    earlier = t.cryptocurrencies.filter(F.col("symbol") < "S5").withColumn("name", F.upper("name"))
    first = t.stored("dim_cryptocurrency", warehouse.upsert_dim_cryptocurrency(earlier, empty))
    return warehouse.upsert_dim_cryptocurrency(t.cryptocurrencies, first)


def _second_load_exchanges(t: _Run) -> DataFrame:
    empty = warehouse.empty_table(t.spark, DIM_EXCHANGE)
    earlier = t.exchanges.filter(F.col("exchange_type") == "WALLET").withColumn("exchange_type", F.lit("OTHER"))
    first = t.stored("dim_exchange", warehouse.upsert_dim_exchange(earlier, empty))
    return warehouse.upsert_dim_exchange(t.exchanges, first)


def _second_load_categories(t: _Run) -> DataFrame:
    empty = warehouse.empty_table(t.spark, DIM_TRANSACTION_CATEGORY)
    earlier = t.transaction_categories.filter(F.col("name") > "B").withColumn("description", F.lit("to be removed"))
    first = t.stored("dim_transaction_category", warehouse.upsert_dim_transaction_category(earlier, empty))
    return warehouse.upsert_dim_transaction_category(t.transaction_categories, first)


def _load_fact(t: _Run, tx: DataFrame, fact: DataFrame, dim_date: DataFrame, size: int | None = None) -> DataFrame:
    return warehouse.build_fact_transactions(tx, dim_date, t.dim_crypto, t.dim_exchange, t.dim_category, fact, size)


def _second_load_fact(t: _Run) -> DataFrame:
    return snapshots.read_fact(t.spark, _fact_of_two_loads(t, t.fact_rows(t.booked))[0])


def _fact_of_two_loads(t: _Run, rows: DataFrame, summary: str | None = None) -> tuple[str, list[int]]:
    """Load the early part of the ledger without fees, store it by month (and its monthly report), then load rows over it."""
    path = shared_dir(t.spark, "fact")
    early = t.booked.filter(F.col("tx_timestamp") < F.lit(EARLIER_LOAD_UNTIL).cast("timestamp"))
    first = _load_fact(
        t, early.withColumn("fee_usd", F.lit(None).cast("decimal(10,4)")),
        warehouse.empty_table(t.spark, FACT_TRANSACTIONS), t.dim_date, early.count(),
    )
    snapshots.save_fact(first, path)
    if summary:
        snapshots.save_monthly_summary(snapshots.read_fact(t.spark, path), t.dim_date, t.dim_crypto, summary)
    return path, snapshots.load_fact_months(t.spark, path, rows, shared_dir(t.spark, "fact-staging"))


def _refreshed_summary(t: _Run) -> DataFrame:
    """The stored monthly report after a load of the months that an earlier load hadn't: only these are made anew."""
    summary = shared_dir(t.spark, "monthly-summary")
    late = t.booked.filter(F.col("tx_timestamp") >= F.lit(EARLIER_LOAD_UNTIL).cast("timestamp"))
    path, months = _fact_of_two_loads(t, t.fact_rows(late), summary)
    snapshots.refresh_monthly_summary(t.spark, summary, path, months, t.dim_date, t.dim_crypto)
    return snapshots.read_monthly_summary(t.spark, summary)


def _refreshed_holdings(t: _Run) -> DataFrame:
    """The stored holdings of an earlier ledger, brought up to date from the audit log of what has changed since."""
    path = shared_dir(t.spark, "mv_current_holdings")
    snapshots.save_mv_current_holdings(t.before, t.cryptocurrencies, path)
    snapshots.refresh_mv_current_holdings(t.stored("audit", _audit_log(t)), t.after, t.cryptocurrencies, path)
    return snapshots.read_mv_current_holdings(t.spark, path)


def _materialized_holdings(t: _Run) -> DataFrame:
    path = shared_dir(t.spark, "mv_current_holdings")
    snapshots.save_mv_current_holdings(t.movements, t.cryptocurrencies, path)
    return snapshots.read_mv_current_holdings(t.spark, path)


def _next_keys(t: _Run) -> DataFrame:
    parts = [
        keys.next_key(df, key).select(F.lit(name).alias("table_name"), "next_key")
        for name, df, key in (
            ("cryptocurrencies", t.cryptocurrencies, "crypto_id"),
            ("exchanges", t.exchanges, "exchange_id"),
            ("transaction_categories", t.transaction_categories, "category_id"),
            ("transactions", t.trades, "tx_id"),
        )
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def _star_counts(t: _Run) -> DataFrame:
    return statistics.table_row_counts(
        {
            "fact_transactions": _measures(t), "dim_date": t.dim_date, "dim_cryptocurrency": t.dim_crypto,
            "dim_exchange": t.dim_exchange, "dim_transaction_category": t.dim_category,
        }
    )


def _measures(t: _Run, tx: DataFrame | None = None) -> DataFrame:
    return warehouse.fact_measures(t.movements if tx is None else tx, t.dim_date, t.dim_crypto)


def _monthly(t: _Run, tx: DataFrame | None = None) -> DataFrame:
    return warehouse.view_monthly_crypto_transaction_summary(_measures(t, tx), t.dim_date, t.dim_crypto)


def _null_keys(t: _Run) -> DataFrame:
    """The ledger with a few ids that no dimension has."""
    return warehouse.verify_star_null_keys(t.fact_rows(t.checked), t.checked)


def _holdings_of_an_earlier_refresh(t: _Run) -> DataFrame:
    """A snapshot is stored, then the ledger grows: what is read is still the stored one."""
    path = shared_dir(t.spark, "mv_current_holdings")
    until = dt.date.fromisoformat(LATE_FROM) - dt.timedelta(days=1)
    snapshots.save_mv_current_holdings(t.trades_in(until=until), t.cryptocurrencies, path)
    return snapshots.read_mv_current_holdings(t.spark, path)


def _warehouse() -> dict[str, Query]:
    return {
        "mv_current_holdings": _on(_materialized_holdings),
        "read_mv_current_holdings": _on(_holdings_of_an_earlier_refresh, order="read_mv_current_holdings"),
        "refresh_mv_current_holdings": _on(_refreshed_holdings, order="read_mv_current_holdings"),
        "refresh_monthly_summary": _on(
            _refreshed_summary, "average_buy_price_usd", "average_sell_price_usd", order="view_monthly_crypto_transaction_summary",
        ),
        "build_dim_date": _on(lambda t: warehouse.calendar_covering(t.movements)),
        "insert_only_load": _on(_insert_only_load),
        "upsert_dim_cryptocurrency": _on(_second_load_cryptos),
        "upsert_dim_exchange": _on(_second_load_exchanges),
        "upsert_dim_transaction_category": _on(_second_load_categories),
        "build_fact_transactions": _on(
            lambda t: _load_fact(
                t, t.checked, warehouse.empty_table(t.spark, FACT_TRANSACTIONS), t.dim_date,
            )
        ),
        "upsert_fact_transactions": _on(_second_load_fact),
        "fact_rejects": _on(
            lambda t: warehouse.fact_rejects(t.checked, t.dim_date, t.dim_crypto)
        ),
        "view_monthly_crypto_transaction_summary": _on(
            _monthly, "average_buy_price_usd", "average_sell_price_usd", order="view_monthly_crypto_transaction_summary",
        ),
        "monthly_summary_of_asset": _on(
            lambda t: _monthly(t, t.trades_in(crypto_id=TARGET_ASSET)),
            "average_buy_price_usd", "average_sell_price_usd", order="view_monthly_crypto_transaction_summary",
        ),
        "monthly_summary_of_month": _on(
            lambda t: _monthly(t, t.trades_in(*ONE_MONTH)),
            "average_buy_price_usd", "average_sell_price_usd", order="view_monthly_crypto_transaction_summary",
        ),
        "verify_star_counts": _on(_star_counts),
        "verify_star_null_keys": _on(_null_keys),
        "value_by_symbol_year": _on(
            lambda t: warehouse.value_by_symbol_year(_measures(t), t.dim_date, t.dim_crypto),
            order="value_by_symbol_year",
        ),
        "assign_surrogate_keys": _on(
            lambda t: keys.assign_surrogate_keys(
                t.trades.select("tx_id", F.lit(None).cast("bigint").alias("ledger_key")), "ledger_key", "tx_id"
            )
        ),
        "next_keys": _on(_next_keys),
    }


# --- import, edits, audit ------------------------------------------------------------------------------------

def _csv_round_trip(table: str, source: Callable[[_Run], DataFrame]) -> Callable[[_Run], DataFrame]:
    """Writes a table as CSV files, timestamps of some rows with an impossible day, and imports them."""

    def run(t: _Run) -> DataFrame:
        fields = TABLES[table].fields
        path = shared_dir(t.spark, f"{table}-csv")
        text = F.date_format("tx_timestamp", csv_ledger.TIMESTAMP_FORMAT)
        spoiled = F.when(F.col("tx_type") == "WITHDRAWAL", F.concat(F.substring(text, 1, 8), F.lit("00 00:00:00")))
        source(t).select(
            *[F.coalesce(spoiled, text).alias(f.name) if f.name == "tx_timestamp" else F.col(f.name) for f in fields]
        ).write.option("header", True).option("escape", '"').csv(path)
        rows, rejects = csv_ledger.load_ledger_csv(t.spark, path, table)
        return rows.withColumn("reason", F.lit("").cast("string")).unionByName(
            rejects.select(*[_refused(f).alias(f.name) for f in fields], "reason")
        )

    return run


def _refused(field: StructField) -> Column:
    """A rejected row's value; the text of a timestamp is in the reason."""
    return F.lit(None).cast("timestamp") if field.name == "tx_timestamp" else F.col(field.name).try_cast(field.dataType)


def _inserted_without_ids(t: _Run) -> DataFrame:
    """The late rows come without ids and get the ones after the ledger's last, in order of their own."""
    late = t.trades.filter(F.col("tx_timestamp") >= F.lit(LATE_FROM).cast("timestamp"))
    early = t.trades.filter(F.col("tx_timestamp") < F.lit(LATE_FROM).cast("timestamp"))
    return ledger_edits.insert_with_new_ids(early, late.withColumnRenamed("tx_id", "arrival"), "arrival")


def _audit_log(t: _Run) -> DataFrame:
    return audit.audit_entries(audit.audit_changes(t.before_by_month, t.after_by_month), LOGGED_AT)


def _streamed_audit(t: _Run) -> DataFrame:
    """Stores the changes as a feed and runs the stream over it until it is used up."""
    feed, log, checkpoint = (shared_dir(t.spark, n) for n in ("change-feed", "audit-log", "audit-checkpoint"))
    op = F.when(F.col("old").isNull(), "I").when(F.col("new").isNull(), "D").otherwise("U")
    changed = ~F.col("old").eqNullSafe(F.col("new"))
    changes = audit.paired_images(t.before, t.after, t.before.count() + t.after.count()).filter(changed).select(
        op.alias("op"), F.lit(LOGGED_AT).cast("timestamp").alias("changed_at"), "old", "new"
    )
    snapshots.save_table(changes, feed)
    audit_stream.start_audit_stream(
        audit_stream.read_change_feed(t.spark, feed), log, checkpoint
    ).awaitTermination()
    # Ids follow the order of arrival, which SQL over the tables can't know.
    return t.spark.read.parquet(log).select("operation_type", "operation_timestamp", *AUDIT_IMAGE.fieldNames())


def _audit() -> dict[str, Query]:
    return {
        "load_ledger_csv": _on(_csv_round_trip("transactions", lambda t: t.transactions)),
        "load_cryptocurrencies_csv": _on(_csv_round_trip("cryptocurrencies", lambda t: t.cryptocurrencies)),
        "load_exchanges_csv": _on(_csv_round_trip("exchanges", lambda t: t.exchanges)),
        "load_transaction_categories_csv": _on(
            _csv_round_trip("transaction_categories", lambda t: t.transaction_categories)
        ),
        "load_historical_prices_csv": _on(_csv_round_trip("historical_prices", lambda t: t.historical_prices)),
        "ledger_edits": _on(lambda t: t.after),
        "insert_with_new_ids": _on(_inserted_without_ids),
        "audit_changes": _on(_audit_log),
        "recent_audit": _on(lambda t: audit.recent_audit(_audit_log(t), 5)),
        "audit_stream": _on(_streamed_audit),
    }


def all_queries() -> dict[str, Query]:
    return _holdings() | _statistics() | _indicators() | _tax_lots() | _quality() | _warehouse() | _audit()
