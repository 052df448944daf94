"""Parquet snapshots: every load writes a complete new folder, and readers move to it when it is done."""

from __future__ import annotations

from collections import Counter

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lotwise.functions.expressions import above_dust, moves_holdings, signed_quantity
from lotwise.operators.audit import MONTH
from lotwise.operators.keys import assign_surrogate_keys
from lotwise.operators.merge import upsert
from lotwise.operators.warehouse import view_monthly_crypto_transaction_summary
from lotwise.schemas import FACT_TRANSACTIONS, WIDE_QUANTITY, conform
from lotwise.session import COMPRESSION, shared_dir, spread, tasks_for


def save_mv_current_holdings(tx: DataFrame, cryptos: DataFrame, path: str) -> None:
    """Create or refresh: the snapshot is computed anew from the whole ledger, as a new version."""
    _save_version(tx.sparkSession, path, _net(tx), cryptos)


def refresh_mv_current_holdings(audit: DataFrame, tx: DataFrame, cryptos: DataFrame, path: str) -> None:
    """The next version of a stored snapshot, from what the audit log says has changed since: ``audit`` has the entries
    after that snapshot (audit_id, operation_type and the row images), ``tx`` is the ledger as it is now.

    A row counted with the image that its first entry holds, unless that entry inserted it, and counts with its present
    values, if it is still there. Only changed rows are looked up; the stored sums of all others stay.
    """
    # Only what holdings are made of is taken from the log.
    spark, images = tx.sparkSession, ["crypto_id", "tx_type", "quantity"]
    first = audit.groupBy(F.col("tx_id").alias("id")).agg(F.min_by(F.struct("operation_type", *images), "audit_id").alias("first"))
    counted = first.filter(F.col("first.operation_type") != "I").select([F.col(f"first.{c}").alias(c) for c in images])
    present = tx.join(first.select(F.col("id").alias("tx_id")), "tx_id", "left_semi")
    stored = spark.read.parquet(f"{path}/net/version={_newest(spark, path)}")
    change = _net(present).unionByName(_net(counted).withColumn("net", -F.col("net"))).unionByName(stored)
    _save_version(spark, path, change.groupBy("crypto_id").agg(F.sum("net").cast(_NET).alias("net")), cryptos)


def read_mv_current_holdings(spark: SparkSession, path: str) -> DataFrame:
    """The newest version that is complete. It stays readable while the next one is written."""
    return spark.read.parquet(f"{path}/holdings/version={_newest(spark, path)}").orderBy("symbol")


_NET = "decimal(38,18)"
# Rows of a month that a task writes to one file, at most, by a hash of their ids.
ROWS_PER_SLICE = 500_000


def _net(tx: DataFrame) -> DataFrame:
    """crypto_id, net: sums of all signed quantities, also where nothing is held."""
    return tx.filter(moves_holdings()).groupBy("crypto_id").agg(F.sum(signed_quantity()).cast(_NET).alias("net"))


def _save_version(spark: SparkSession, path: str, net: DataFrame, cryptos: DataFrame) -> None:
    """A new version beside the earlier ones: sums, holdings made from them, and last the mark that it is complete."""
    version = (_newest(spark, path) or 0) + 1
    net.write.mode("overwrite").parquet(f"{path}/net/version={version}")
    held = spark.read.parquet(f"{path}/net/version={version}").filter(above_dust(F.col("net")))
    cryptos.join(held, "crypto_id").select(
        "crypto_id", "symbol", "name", F.col("net").cast(WIDE_QUANTITY).alias("current_holding_quantity")
    ).write.mode("overwrite").parquet(f"{path}/holdings/version={version}")
    spark.range(1).select(F.lit(version).alias("version")).write.mode("append").parquet(f"{path}/complete")


def _newest(spark: SparkSession, path: str) -> int | None:
    """The newest complete version; none if there is none yet."""
    try:
        return spark.read.schema("version int").parquet(f"{path}/complete").agg(F.max("version")).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def save_ledger(tx: DataFrame, path: str, dealt: bool = False) -> None:
    """A snapshot of the ledger, stored by month. ``dealt``: the rows are read from a snapshot that is, so a task has
    few months, and they need not be shuffled for that again."""
    by_month = tx.withColumn(MONTH, F.date_format("tx_timestamp", "yyyyMM").cast("int"))
    by_month = by_month if dealt else by_month.hint("rebalance", F.col(MONTH))
    by_month.write.mode("errorifexists").option("compression", COMPRESSION).partitionBy(MONTH).parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot with its month, by which it is pruned."""
    return spark.read.parquet(path)


def save_table(df: DataFrame, path: str) -> None:
    """To a folder that must not exist yet: a load never overwrites what it reads."""
    df.write.mode("errorifexists").option("compression", COMPRESSION).parquet(path)


def _month_of_key() -> Column:
    return F.floor(F.col("date_key") / 100).cast("int")


def _by_month(fact: DataFrame, dealt: bool = False) -> DataFrame:
    """Partitioned by month for pruning; the rebalance keeps files even when one month is far larger. Rows that are
    ``dealt`` by month already aren't shuffled again."""
    fact = fact.withColumn("date_month", _month_of_key())
    return fact if dealt else fact.hint("rebalance", F.col("date_month"))


def save_fact(fact: DataFrame, path: str, dealt: bool = False) -> None:
    by_month = _by_month(fact, dealt).write.mode("errorifexists").option("compression", COMPRESSION)
    by_month.partitionBy("date_month").parquet(path)


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("date_month")


def load_fact_months(spark: SparkSession, path: str, rows: DataFrame, staging: str) -> list[int]:
    """Upsert fact rows into a stored fact, rewriting only the months the load touches, and return these (yyyyMM).

    These are the months of the loaded rows and those their ids are stored in so far, so a row that moves to another
    month leaves the old one. The next content of these months is written to ``staging``, a folder that must not exist,
    before any month is replaced; the other months keep their files. A calendar's months are few, so their list may go
    through the driver.

    Ids meet the stored keys without the rest of the rows, and new ones get theirs. Rows then are shuffled once, to
    where their keys are and by month. Stored rows are read for ids that the load doesn't bring only. Where an id is
    NULL or comes twice, the general upsert pairs whole rows.
    """
    stored = spark.read.parquet(path)
    copies = F.count(F.lit(1)).over(Window.partitionBy("tx_id_original"))
    new = rows.select("tx_id_original", _month_of_key().alias("date_month"), F.lit(True).alias("loaded"))
    old = stored.select("tx_id_original", "transaction_key", F.col("date_month").alias("old_month"), F.lit(True).alias("kept"))
    size, met = stored.count() + rows.count(), shared_dir(spark, "fact-ids")
    sides = [spread(side, size, "tx_id_original").withColumn(n, copies) for side, n in ((new, "copies"), (old, "old_copies"))]
    save_table(sides[0].join(sides[1], "tx_id_original", "full"), met)
    ids = spark.read.parquet(met)
    loaded, key = F.col("loaded").isNotNull(), F.col("transaction_key")
    odd = F.col("tx_id_original").isNull() | (F.greatest("copies", "old_copies") > 1) | (F.col("kept") & key.isNull())
    found = ids.groupBy("loaded", "date_month", "old_month").agg(F.count(F.lit(1)).alias("n"), F.max(odd).alias("odd")).collect()
    counts = Counter()
    for r in found:
        if r.loaded:
            counts[r.date_month] += r.n
    touched = sorted({m for r in found if r.loaded for m in (r.date_month, r.old_month) if m is not None})
    part = stored.filter(F.col("date_month").isin(touched)).drop("date_month")
    if any(r.odd for r in found) or not counts or None in counts:
        save_fact(conform(upsert(part, rows, "tx_id_original", "transaction_key", keyed=stored, size=size), FACT_TRANSACTIONS), staging)
    else:
        taken = ids.filter(loaded).select("tx_id_original", "date_month", "transaction_key")
        fresh = assign_surrogate_keys(taken.filter(key.isNull()), "transaction_key", "tx_id_original", keyed=stored, rows=size)
        content = _with_keys(rows, taken.filter(key.isNotNull()).unionByName(fresh), counts)
        left = ids.filter(~loaded & F.col("old_month").isin(touched)).select("tx_id_original")
        if not left.isEmpty():
            others = shared_dir(spark, "fact-ids-left")
            save_table(left, others)
            content = content.unionByName(part.join(spark.read.parquet(others), "tx_id_original", "left_semi").select(content.columns))
        save_fact(conform(content, FACT_TRANSACTIONS), staging, dealt=True)
    finish_fact_months(spark, path, staging, touched)
    return touched


def _with_keys(rows: DataFrame, keys: DataFrame, counts: dict[int, int]) -> DataFrame:
    """Rows with the keys of their ids, dealt by month; a month of more than ROWS_PER_SLICE rows, by ranges of hashes, too."""
    slices = F.create_map(*[F.lit(x) for month, n in counts.items() for x in (month, 1 + n // ROWS_PER_SLICE)])
    cell = ["date_month", "slice"]
    values = [f.name for f in FACT_TRANSACTIONS if f.name != "transaction_key"]
    both = rows.select(*values, _month_of_key().alias("date_month"), F.lit(True).alias("is_row")).unionByName(keys, allowMissingColumns=True)
    of_id = Window.partitionBy(*cell, "tx_id_original")
    tasks = tasks_for(rows.sparkSession, 2 * sum(counts.values()))
    return (
        both.withColumn("slice", F.pmod(F.xxhash64("tx_id_original"), F.element_at(slices, F.col("date_month"))))
        .repartition(*([tasks] if tasks else []), *cell)
        .withColumn("transaction_key", F.max("transaction_key").over(of_id))
        .filter("is_row").select(FACT_TRANSACTIONS.fieldNames())
    )


def finish_fact_months(spark: SparkSession, path: str, staging: str, touched: list[int]) -> None:
    """Replace the touched months by what is staged. A load that broke off here is finished by calling this once more:
    months are replaced as wholes, so those already replaced come out the same. The staged files are by month already,
    so a task reads few months, and nothing is shuffled for that again."""
    staged = spark.read.parquet(staging)
    by_month = staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION)
    by_month.partitionBy("date_month").parquet(path)
    left = {r.date_month for r in staged.select("date_month").distinct().collect()}
    for month in touched:
        if month not in left:
            staged.drop("date_month").limit(0).write.mode("overwrite").parquet(f"{path}/date_month={month}")


def save_monthly_summary(fact: DataFrame, dim_date: DataFrame, dim_crypto: DataFrame, path: str) -> None:
    """The monthly report, stored by month."""
    _summary_by_month(fact, dim_date, dim_crypto).write.mode("errorifexists").partitionBy("summary_month").parquet(path)


def read_monthly_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("summary_month")


def refresh_monthly_summary(
    spark: SparkSession, path: str, fact_path: str, months: list[int], dim_date: DataFrame, dim_crypto: DataFrame
) -> None:
    """Recompute the stored report for the months a load has touched (``load_fact_months`` returns them), from these
    months of the stored fact; the other months keep their files."""
    part = spark.read.parquet(fact_path).filter(F.col("date_month").isin(months)).drop("date_month")
    fresh = _summary_by_month(part, dim_date, dim_crypto)
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("summary_month").parquet(path)
    left = {r[0] for r in part.select(F.floor(F.col("date_key") / 100).cast("int")).distinct().collect()}
    for month in months:
        if month not in left:
            fresh.drop("summary_month").limit(0).write.mode("overwrite").parquet(f"{path}/summary_month={month}")


def _summary_by_month(fact: DataFrame, dim_date: DataFrame, dim_crypto: DataFrame) -> DataFrame:
    report = view_monthly_crypto_transaction_summary(fact, dim_date, dim_crypto)
    return report.withColumn("summary_month", F.regexp_replace("year_month", "-", "").cast("int"))
