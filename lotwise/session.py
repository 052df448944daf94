"""Session settings the operators rely on, and the shared folder for materialized steps."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# DATE(ts), month truncation and day-end cut-offs all follow the session zone.
SESSION_ZONE = "UTC"
# Codec of stored tables and steps.
COMPRESSION = "zstd"
# Whole rows that a task sorts or joins, at most, where their number is known.
ROWS_PER_TASK = 500_000


def pin_session(spark: SparkSession) -> SparkSession:
    """Set the runtime options that change results. Sizing options stay with the cluster."""
    spark.conf.set("spark.sql.session.timeZone", SESSION_ZONE)
    return spark


def local_session(app: str = "lotwise", cpus: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and the bench; on a cluster use the session you are given."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("LOTWISE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", SESSION_ZONE)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return pin_session(spark)


def spread(df: DataFrame, rows: int | None, *columns: str) -> DataFrame:
    """Spread by columns over as many tasks as ``rows`` rows need, so that none has to spill.

    Left alone where the session's number of shuffle partitions is enough, or ``rows`` is not known.
    """
    tasks = tasks_for(df.sparkSession, rows)
    return df.repartition(tasks, *columns) if tasks else df


def tasks_for(spark: SparkSession, rows: int | None) -> int | None:
    """How many tasks so many rows need, if these are more than the session's shuffle partitions."""
    tasks = -(-(rows or 0) // ROWS_PER_TASK)
    return tasks if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else None


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, where every executor can read what others wrote.

    Where that is not set, a session of one process takes a temporary folder; a cluster has to set it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = os.path.join(tempfile.gettempdir(), "lotwise-shared")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
