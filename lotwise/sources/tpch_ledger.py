"""The given TPC-H-like tables read as ledger tables (the mapping of FIXTURES.md, section 3)."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.functions.expressions import as_date
from lotwise.schemas import FEE, PRICE, QUANTITY, VOLUME
from lotwise.session import pin_session, tasks_for

# Return flag and line status to transaction type.
TYPE_OF_FLAGS = {
    "NF": "BUY",
    "NO": "BUY",
    "RO": "SELL",
    "AF": "DEPOSIT",
    "AO": "STAKING_REWARD",
    "RF": "WITHDRAWAL",
}
# Fixed value: every 997th order line gets price 0, the edge case of a zero-priced trade.
ZERO_PRICE_EVERY = 997


# Room for the days of one asset in the ids of prices.
DAYS_PER_ASSET = 1_000_000
# Room for the copies of an order line and for the lines of an order in ids; more where there are more.
COPIES, LINES = 1000, 10
# Copies of one order line that are numbered in one task.
HOT_COPIES = 1_000_000
# What copies of a line are ordered by.
_VALUES = ("l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice", "l_tax")


class LedgerTables:
    """The five tables as lazy DataFrames. Ids are BIGINT here, as in the source."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = pin_session(spark)
        self.folder = folder.rstrip("/")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def cryptocurrencies(self) -> DataFrame:
        return self._read("supplier").select(
            F.col("s_suppkey").alias("crypto_id"),
            F.when(F.col("s_suppkey") == 0, "BTC")
            .otherwise(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")))
            .alias("symbol"),
            F.col("s_name").alias("name"),
        )

    @cached_property
    def exchanges(self) -> DataFrame:
        kind = F.when(F.col("n_regionkey") <= 2, "EXCHANGE").when(F.col("n_regionkey") == 3, "WALLET")
        return self._read("nation").select(
            F.col("n_nationkey").alias("exchange_id"),
            F.col("n_name").alias("name"),
            kind.otherwise("OTHER").alias("exchange_type"),
        )

    @cached_property
    def transaction_categories(self) -> DataFrame:
        return self._read("region").select(
            F.col("r_regionkey").alias("category_id"),
            F.col("r_name").alias("name"),
            F.lit(None).cast("string").alias("description"),
        )

    @cached_property
    def trades(self) -> DataFrame:
        """The ledger without venue and category, which need three more joins: one row per line item."""
        return self._trades(self._read("lineitem")).drop("l_orderkey", "l_linenumber")

    @cached_property
    def movements(self) -> DataFrame:
        """`trades` without ids, for reports that show none."""
        return self._trades(self._read("lineitem"), ids=False).drop("l_orderkey", "l_linenumber")

    def trades_in(
        self, start: dt.date | str | None = None, until: dt.date | str | None = None, crypto_id: int | None = None
    ) -> DataFrame:
        """Trades from the start of one day to the end of another, and of one asset, filtered in the Parquet scan.

        For reports that show no ids: these follow from all copies of a line.
        """
        rows = self._read("lineitem")
        midnight = lambda day: F.lit(dt.datetime.combine(day, dt.time())).cast("timestamp_ntz")
        if start is not None:
            rows = rows.filter(F.col("l_shipdate") >= midnight(as_date(start)))
        if until is not None:
            rows = rows.filter(F.col("l_shipdate") < midnight(as_date(until) + dt.timedelta(days=1)))
        if crypto_id is not None:
            rows = rows.filter(F.col("l_suppkey") == crypto_id)
        return self._trades(rows, ids=False).drop("l_orderkey", "l_linenumber")

    def trades_of(self, crypto_id: int) -> DataFrame:
        """`trades` of one asset. Only lines that it has a copy of are numbered, so only these are shuffled."""
        lines = self._read("lineitem")
        own = lines.filter(F.col("l_suppkey") == crypto_id).select("l_orderkey", "l_linenumber").distinct()
        near = lines.join(own, ["l_orderkey", "l_linenumber"], "left_semi")
        return self._trades(near).filter(F.col("crypto_id") == crypto_id).drop("l_orderkey", "l_linenumber")

    @cached_property
    def _widths(self) -> tuple[int, int, int]:
        """Room for lines and copies in ids, as powers of ten, and the most copies that a line has."""
        lines = self._read("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("copies"))
        last, most = lines.agg(F.max("l_linenumber"), F.max("copies")).first()
        power = lambda least, top: max(least, 10 ** len(str(top or 0)))
        return power(LINES, last), power(COPIES, most), most or 0

    def _numbered(self, lines: DataFrame) -> DataFrame:
        """Order lines with ``copy``, from 1: each line's copies in order of their values.

        Lines with more than HOT_COPIES copies are numbered on two levels: equal copies are counted first, the others
        dealt into pieces by a hash and numbered there after the copies of the pieces before, so that no task has all.
        """
        line = ["l_orderkey", "l_linenumber"]
        plain = lines.withColumn("copy", F.row_number().over(Window.partitionBy(*line).orderBy(*_VALUES)).cast("bigint"))
        if self._widths[2] <= HOT_COPIES:
            return plain
        hot = self._read("lineitem").groupBy(*line).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > HOT_COPIES)
        pieces = F.ceil(F.col("n") / HOT_COPIES)
        equal = (
            lines.select(*line, *_VALUES).join(hot, line).groupBy(*line, *_VALUES, "n").agg(F.count(F.lit(1)).alias("same"))
            .withColumn("piece", F.pmod(F.xxhash64(*_VALUES), pieces))
        )
        totals = equal.groupBy(*line, "piece").agg(F.sum("same").alias("total"))
        earlier = Window.partitionBy(*line).orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
        starts = totals.select(*line, "piece", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("start"))
        inside = Window.partitionBy(*line, "piece").orderBy(*_VALUES).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        last = F.col("start") + F.sum("same").over(inside)
        many = (
            equal.join(starts, [*line, "piece"]).withColumn("last", last)
            .select(*line, *_VALUES, F.explode(F.sequence(F.col("last") - F.col("same") + 1, F.col("last"))).alias("copy"))
        )
        few = lines.select(*line, *_VALUES).join(hot, line, "left_anti")
        few = few.withColumn("copy", F.row_number().over(Window.partitionBy(*line).orderBy(*_VALUES)).cast("bigint"))
        return few.unionByName(many)

    def _trades(self, lines: DataFrame, ids: bool = True) -> DataFrame:
        """Ids are made of order, line and the copy of the line, since lines come more than once.

        Without ``ids`` no copies are numbered and no shuffle precedes what follows.
        """
        room, copies, _ = self._widths if ids else (0, 0, 0)
        line = F.col("l_orderkey") * LINES + F.col("l_linenumber")
        flags = F.concat("l_returnflag", "l_linestatus")
        tx_type = F.coalesce(*[F.when(flags == code, kind) for code, kind in TYPE_OF_FLAGS.items()], flags)
        tx_id = [((F.col("l_orderkey") * room + F.col("l_linenumber")) * copies + F.col("copy")).alias("tx_id")] if ids else []
        return (self._numbered(lines) if ids else lines).select(
            "l_orderkey", "l_linenumber",
            *tx_id,
            F.col("l_suppkey").alias("crypto_id"),
            tx_type.alias("tx_type"),
            F.col("l_quantity").cast(QUANTITY).alias("quantity"),
            F.when(tx_type.isin("DEPOSIT", "WITHDRAWAL"), F.lit(None))
            .when(line % ZERO_PRICE_EVERY == 0, F.lit(0))
            .otherwise(F.col("l_extendedprice"))
            .cast(PRICE)
            .alias("price_per_unit_usd"),
            F.col("l_shipdate").cast("timestamp").alias("tx_timestamp"),
            F.col("l_tax").cast(FEE).alias("fee_usd"),
            F.lit(None).cast("string").alias("notes"),
        )

    @cached_property
    def transactions(self) -> DataFrame:
        """The whole ledger. Orders without a customer or nation leave venue and category empty."""
        return self._placed(ids=True)

    @cached_property
    def placed_movements(self) -> DataFrame:
        """`transactions` without ids, for reports that show none."""
        return self._placed(ids=False)

    def _placed(self, ids: bool) -> DataFrame:
        venue = (
            self._read("orders").select("o_orderkey", "o_custkey")
            .join(
                self._read("customer").select("c_custkey", "c_nationkey"),
                F.col("o_custkey") == F.col("c_custkey"), "left",
            )
            .join(
                self._read("nation").select("n_nationkey", "n_regionkey"),
                F.col("c_nationkey") == F.col("n_nationkey"), "left",
            )
        )
        line = F.col("l_linenumber")
        # Both sides grow with the data: a merge join, so that neither is ever broadcast on an estimate.
        lines = self._read("lineitem")
        if ids and self._widths[2] <= HOT_COPIES:
            # Dealt by order once: the copies are numbered and the orders joined in the same partitions.
            tasks = tasks_for(self.spark, lines.count())
            lines = lines.select("l_orderkey", "l_linenumber", *_VALUES).repartition(*([tasks] if tasks else []), "l_orderkey")
        rows = self._trades(lines, ids)
        return rows.join(venue.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
            *(["tx_id"] if ids else []), "crypto_id",
            F.when(line != 7, F.col("c_nationkey")).alias("exchange_id"),
            F.when(line != 6, F.col("n_regionkey")).alias("category_id"),
            "tx_type", "quantity", "price_per_unit_usd", "tx_timestamp", "fee_usd", "notes",
        )

    @cached_property
    def checked(self) -> DataFrame:
        """The whole ledger and a few rows that break its references: asset, venue, category, calendar."""
        columns = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in self.transactions.schema)
        orphans = self.spark.sql(f"""
            SELECT {columns} FROM VALUES
              (-1, -5, 0, 0, 'BUY', 1, 10, '2000-06-01', 0.1, 'unknown asset'),
              (-2, 0, -7, 1, 'SELL', 2, 11, '2000-06-02', 0.2, 'unknown venue'),
              (-3, 0, 1, -9, 'BUY', 3, 12, '2000-06-03', NULL, 'unknown category'),
              (-4, 0, 1, 1, 'BUY', 4, 13, '1950-01-01', 0.4, 'before any calendar')
            AS t({", ".join(self.transactions.columns)})""")
        return self.transactions.unionByName(orphans)

    @cached_property
    def spoiled(self) -> DataFrame:
        """`checked`, and an id that comes twice with nothing else filled in."""
        blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.transactions.schema.fields[1:]]
        twice = self.spark.range(2).select(F.lit(-6).cast("bigint").alias("tx_id"), *blank)
        return self.checked.unionByName(twice)

    @cached_property
    def historical_prices(self) -> DataFrame:
        price = F.col("l_extendedprice").cast(PRICE)
        return (
            self._read("lineitem")
            .groupBy(F.col("l_suppkey").alias("crypto_id"), F.to_date("l_shipdate").alias("price_date"))
            .agg(
                F.max(price).alias("close_price_usd"),
                F.min(price).alias("open_price_usd"),
                F.max(price).alias("high_price_usd"),
                F.min(price).alias("low_price_usd"),
                F.sum(F.col("l_quantity").cast(VOLUME)).cast(VOLUME).alias("volume_usd"),
            )
            .withColumn("price_id", F.col("crypto_id") * DAYS_PER_ASSET + F.unix_date("price_date"))
        )

    def as_dict(self) -> dict[str, DataFrame]:
        return {
            "cryptocurrencies": self.cryptocurrencies,
            "exchanges": self.exchanges,
            "transaction_categories": self.transaction_categories,
            "transactions": self.transactions,
            "historical_prices": self.historical_prices,
        }
