"""Generated keys, dense and stable, without ordering a table in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.session import COMPRESSION, shared_dir, tasks_for

# monotonically_increasing_id() holds the partition above these bits and the place in it below.
_PLACE_BITS = 33


def next_key(table: DataFrame, key: str) -> DataFrame:
    """One row: the key the next inserted row would get (1 for an empty table)."""
    return table.agg((F.coalesce(F.max(key).cast("bigint"), F.lit(0)) + 1).alias("next_key"))


def assign_surrogate_keys(
    df: DataFrame, key: str, natural_id: str, start_after: int = 0, keyed: DataFrame | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Fill NULL keys with the numbers after the largest existing one, in order of the natural id.

    Rows that have a key keep it. The rows are range-partitioned once, those without a key first, and written to the
    shared folder with their place; a partition's numbers start after those of the partitions before it, whose counts
    are one row each. So no task orders more than a partition, however sparse or dense the ids are. Spark samples the
    input for the ranges, up to its last shuffle: one that ends in a join of many rows should be stored first.
    ``natural_id`` can be of any type with an order and must be unique. ``keyed`` is a table that holds all keys given
    so far, where ``df`` doesn't. ``rows`` is how many rows there are, where that is known: more tasks then order many.
    """
    marked, order = df.withColumn("__kept", F.col(key).isNotNull()), ("__kept", natural_id)
    tasks = tasks_for(df.sparkSession, rows)
    ranged = marked.repartitionByRange(tasks, *order) if tasks else marked.repartitionByRange(*order)
    in_order = ranged.sortWithinPartitions(*order)
    return _numbered(in_order, key, start_after, keyed).select(df.columns)


def number_as_they_come(df: DataFrame, key: str, start_after: int = 0) -> DataFrame:
    """All rows with numbers after ``start_after``, in the order in which Spark reads them: nothing is shuffled."""
    columns = [*[c for c in df.columns if c != key], F.lit(None).cast("bigint").alias(key), F.lit(False).alias("__kept")]
    return _numbered(df.select(columns), key, start_after).drop("__kept")


def _numbered(df: DataFrame, key: str, start_after: int, keyed: DataFrame | None = None) -> DataFrame:
    """Numbers for the rows that aren't ``__kept``, which come first and in order in all partitions."""
    spark = df.sparkSession
    path = shared_dir(spark, "numbered")
    df.withColumn("__place", F.monotonically_increasing_id()).write.option("compression", COMPRESSION).parquet(path)
    placed = spark.read.parquet(path).withColumn("__part", F.shiftright("__place", _PLACE_BITS))
    parts = placed.groupBy("__part").agg(F.count(F.when(~F.col("__kept"), 1)).alias("fresh"), F.max(key).cast("bigint").alias("top"))
    # One row for each partition, so they may be ordered in one task and broadcast.
    before = F.coalesce(F.sum("fresh").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    every = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    top = F.greatest(F.coalesce(F.max("top").over(every), F.lit(0)), F.lit(start_after))
    if keyed is not None:
        parts = parts.crossJoin(F.broadcast(keyed.agg(F.max(key).cast("bigint").alias("other_top"))))
        top = F.greatest(top, F.coalesce("other_top", F.lit(0)))
    offsets = parts.select("__part", (before + top).alias("__offset"))
    number = F.col("__offset") + F.col("__place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)) + 1
    numbered = F.when(F.col("__kept"), F.col(key).cast("bigint")).otherwise(number)
    return placed.join(F.broadcast(offsets), "__part").withColumn(key, numbered).select(df.columns)
