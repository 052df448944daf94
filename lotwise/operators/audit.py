"""Change log of the ledger, from two snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.operators.keys import assign_surrogate_keys
from lotwise.schemas import AUDIT_HISTORY, AUDIT_IMAGE, conform
from lotwise.session import COMPRESSION, shared_dir, spread


# Least width of the ranges of ids that are compared by checksum, and how many there are at most.
IDS_PER_RANGE = 1_000_000
RANGES = 1000
# Column of a snapshot that is stored by month (``sources.snapshots.save_ledger``), as yyyyMM.
MONTH = "tx_month"


def _ids_per_range(before: DataFrame, after: DataFrame) -> tuple[int, int]:
    """The width of the ranges, so that however far ids spread, there are few ranges beside the rows of a task; and the
    number of rows of both."""
    ids = before.select("tx_id").unionByName(after.select("tx_id"))
    least, most, rows = ids.agg(F.min("tx_id"), F.max("tx_id"), F.count(F.lit(1))).first()
    return max(IDS_PER_RANGE, ((most or 0) - (least or 0)) // RANGES + 1), rows


def _by_range(snapshot: DataFrame, width: int) -> DataFrame:
    """The audited columns, in the snapshot's types, with the month and the range of ids that each row is in."""
    if MONTH not in snapshot.columns:
        snapshot = snapshot.withColumn(MONTH, F.date_format("tx_timestamp", "yyyyMM").cast("int"))
    return snapshot.select(
        MONTH, F.floor(F.col("tx_id") / width).cast("bigint").alias("id_range"), *AUDIT_IMAGE.fieldNames()
    )


def differing_ranges(before: DataFrame, after: DataFrame, width: int | None = None) -> DataFrame:
    """tx_month, id_range: where two snapshots differ, told by row counts and sums of row hashes.

    Sums are added up before the shuffle, and ranges are wide enough for that to leave few: no row of the ledger is
    shuffled.
    """
    width = width or _ids_per_range(before, after)[0]
    columns = AUDIT_IMAGE.fieldNames()
    # Hashes skip NULLs, so which columns are NULL is hashed, too.
    image = [F.col(f.name).cast(f.dataType) for f in AUDIT_IMAGE]
    row_hash = F.xxhash64(*image, *[F.col(c).isNull() for c in columns]).cast("decimal(20,0)")
    signed = [
        _by_range(snapshot, width).select(MONTH, "id_range", (row_hash * sign).alias("hash"), F.lit(sign).alias("sign"))
        for snapshot, sign in ((before, -1), (after, 1))
    ]
    sums = signed[0].unionByName(signed[1]).groupBy(MONTH, "id_range").agg(F.sum("hash").alias("hashes"), F.sum("sign").alias("signs"))
    return sums.filter((F.col("hashes") != 0) | (F.col("signs") != 0)).select(MONTH, "id_range")


def paired_images(before: DataFrame, after: DataFrame, rows: int | None = None) -> DataFrame:
    """old, new: the row images of both snapshots side by side, NULL where one hasn't the id.

    Rows are shuffled in the snapshots' own types, which are narrower than those of the audit log. ``rows`` is how many
    both have, where that is known: more tasks then join many.
    """
    values = [f for f in AUDIT_IMAGE if f.name != "tx_id"]
    sides = [df.select("tx_id", F.struct(*[f.name for f in values]).alias(n)) for df, n in ((before, "old"), (after, "new"))]
    wide = {
        n: F.when(F.col(n).isNotNull(), F.struct(
            F.col("tx_id").cast(AUDIT_IMAGE["tx_id"].dataType).alias("tx_id"),
            *[F.col(f"{n}.{f.name}").cast(f.dataType).alias(f.name) for f in values],
        ))
        for n in ("old", "new")
    }
    sides = [spread(side, rows, "tx_id") for side in sides]
    return sides[0].join(sides[1], "tx_id", "full").select(*[image.alias(n) for n, image in wide.items()])


def audit_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """operation_type and the row image: the new one for I, the old one for U and D.

    Only rows in ranges whose checksums differ are joined; snapshots stored by month are read again in months that have
    such a range only. A calendar's months are few, so their list goes through the driver. A snapshot pair cannot show
    updates that change nothing, or the steps between; the change feed (``streaming.audit_stream``) does.
    """
    columns = AUDIT_IMAGE.fieldNames()
    spark, path = before.sparkSession, shared_dir(before.sparkSession, "differing-ranges")
    width, rows = _ids_per_range(before, after)
    differing_ranges(before, after, width).write.parquet(path)
    ranges = spark.read.parquet(path)
    months = [r[0] for r in ranges.select(MONTH).distinct().collect()]
    touched = F.col(MONTH).isin([m for m in months if m is not None])
    touched = touched | F.col(MONTH).isNull() if None in months else touched
    # At most RANGES a month, and one more.
    ranges = F.broadcast(ranges.select(F.col(MONTH).alias("of_month"), F.col("id_range").alias("of_range")))

    def suspects(snapshot: DataFrame) -> DataFrame:
        audited = _by_range(snapshot, width).filter(touched)
        same = F.col(MONTH).eqNullSafe(F.col("of_month")) & F.col("id_range").eqNullSafe(F.col("of_range"))
        return audited.join(ranges, same, "left_semi")

    operation = (
        F.when(F.col("old").isNull(), "I")
        .when(F.col("new").isNull(), "D")
        .when(~F.col("old").eqNullSafe(F.col("new")), "U")
    )
    return (
        paired_images(suspects(before), suspects(after), rows)
        .select(operation.alias("operation_type"), F.coalesce("old", "new").alias("image"))
        .filter(F.col("operation_type").isNotNull())
        .select("operation_type", *[F.col(f"image.{c}").alias(c) for c in columns])
    )


def audit_entries(changes: DataFrame, operation_timestamp: dt.datetime, last_audit_id: int = 0) -> DataFrame:
    """Changes as rows of the audit table: stamped, and numbered after the last id in order of tx_id.

    They are stored first: numbering samples its input, and would join the snapshots twice.
    """
    spark, path = changes.sparkSession, shared_dir(changes.sparkSession, "changes")
    changes.write.option("compression", COMPRESSION).parquet(path)
    stored = spark.read.schema(changes.schema).parquet(path)
    stamped = stored.select(
        F.lit(None).cast("bigint").alias("audit_id"),
        "operation_type",
        F.lit(operation_timestamp).cast("timestamp").alias("operation_timestamp"),
        *AUDIT_IMAGE.fieldNames(),
    )
    return conform(assign_surrogate_keys(stamped, "audit_id", "tx_id", start_after=last_audit_id, rows=stored.count()), AUDIT_HISTORY)


def recent_audit(history: DataFrame, n: int = 5) -> DataFrame:
    """The last n entries: a top-n per task, then of those."""
    return history.orderBy(F.desc("operation_timestamp"), F.desc("audit_id")).limit(n)
