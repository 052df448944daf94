"""The audit log as a stream over a change feed: every change is logged, also one that changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lotwise.operators.keys import number_as_they_come
from lotwise.schemas import AUDIT_HISTORY, AUDIT_IMAGE, conform
from lotwise.session import COMPRESSION

# Partition column of the streamed log.
BATCH = "stream_batch"
# Folder of the last ids beside the batches; readers of the log don't see it.
LAST_IDS = "_last_ids"

# op is I, U or D; old is NULL for I, new is NULL for D.
CHANGE_FEED = T.StructType(
    [
        T.StructField("op", T.StringType()),
        T.StructField("changed_at", T.TimestampType()),
        T.StructField("old", AUDIT_IMAGE),
        T.StructField("new", AUDIT_IMAGE),
    ]
)


def read_change_feed(spark: SparkSession, path: str, max_files_per_trigger: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(CHANGE_FEED).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)
    )


def audit_rows(feed: DataFrame) -> DataFrame:
    """Stateless: one audit row per change, so it runs the same on a batch or a stream."""
    image = F.when(F.col("op") == "I", F.col("new")).otherwise(F.col("old"))
    return feed.filter(F.col("op").isin("I", "U", "D")).select(
        F.col("op").alias("operation_type"), F.col("changed_at").alias("operation_timestamp"), image.alias("image")
    ).select("operation_type", "operation_timestamp", *[F.col(f"image.{c}").alias(c) for c in AUDIT_IMAGE.fieldNames()])


def start_audit_stream(feed: DataFrame, audit_path: str, checkpoint: str) -> StreamingQuery:
    """Appends what has arrived and stops; the same checkpoint picks up from there, each change once.

    Entries get the ids after the log's last one, in order of arrival. A batch is a folder of its own in the log, which
    a repeated batch replaces, so a restart neither doubles entries nor leaves gaps. Each batch leaves the last id it
    gave in a small file beside the log, where the next one reads it: no batch reads the log.
    """

    def append(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        last = _last_id(spark, audit_path, number - 1)
        numbered = number_as_they_come(audit_rows(batch), "audit_id", start_after=last)
        folder = f"{audit_path}/{BATCH}={number}"
        conform(numbered, AUDIT_HISTORY).write.mode("overwrite").option("compression", COMPRESSION).parquet(folder)
        given = spark.read.schema(AUDIT_HISTORY).parquet(folder).agg(F.coalesce(F.max("audit_id"), F.lit(last)).alias("last_id"))
        given.write.mode("overwrite").parquet(f"{audit_path}/{LAST_IDS}/{number}")

    return (
        feed.writeStream.foreachBatch(append)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _last_id(spark: SparkSession, audit_path: str, number: int) -> int:
    """The last id that was given up to a batch."""
    if number < 0:
        return 0
    return spark.read.parquet(f"{audit_path}/{LAST_IDS}/{number}").first()["last_id"]
