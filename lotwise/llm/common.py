"""Shared helpers of the training-data operators: tables, checkpoints, spans, connected components."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of whole texts that one Arrow batch may hold in a Python worker.
TEXT_BATCH = 1000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def checkpoint_ready(spark: SparkSession) -> None:
    """Point checkpoints at the folder the cluster names; only a local session without one gets a folder of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = os.path.join(tempfile.gettempdir(), "lotwise-checkpoints")
    context.setCheckpointDir(shared)


def checkpointed(frame: DataFrame) -> DataFrame:
    """The same rows with their lineage cut by files in the shared checkpoint folder, so that lost executors lose nothing."""
    checkpoint_ready(frame.sparkSession)
    return frame.checkpoint(eager=True)


def ascii_lower(column: Column | str) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def free_name(frame: DataFrame, name: str) -> str:
    """`name`, or `name` with underscores so that it clashes with no column of the frame (case aside)."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def renamed_free(narrow: DataFrame, frame: DataFrame) -> DataFrame:
    """`narrow` with every column renamed to a name that `frame` doesn't have, in the same order."""
    return narrow.toDF(*[free_name(frame, f"_{c}") for c in narrow.columns])


def exact(frame: DataFrame) -> DataFrame:
    """Nullable integers as decimals, for Python workers: beside nulls, pandas holds integers as doubles, which round from 2^53 on."""
    whole = [f.name for f in frame.schema if isinstance(f.dataType, T.IntegralType) and f.nullable]
    return frame.withColumns({c: F.col(f"`{c}`").cast("decimal(20,0)") for c in whole})


def restored(frame: DataFrame, like: DataFrame) -> DataFrame:
    """`frame` with the types that its first columns, in order, have in `like`."""
    types = [f.dataType for f in like.schema] + [f.dataType for f in frame.schema.fields[len(like.columns) :]]
    return frame.select(*[F.col(f"`{c}`").cast(kind).alias(c) for c, kind in zip(frame.columns, types, strict=True)])


def schema_of(frame: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema)


def small_batches(frames: Iterator[pd.DataFrame], rows: int = TEXT_BATCH) -> Iterator[pd.DataFrame]:
    """Arrow batches cut into pieces of a bounded number of rows."""
    for frame in frames:
        for begin in range(0, len(frame), rows):
            yield frame.iloc[begin : begin + rows]


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Connected components of an undirected graph: (node, root), root being the smallest node of the component.

    Only nodes with an edge to another node are returned; repeated edges, self edges and edges with a null end change
    nothing, and an empty graph gives no rows. Minimum labels travel along edges and along labels (pointer jumping), so
    the rounds grow with the logarithm of a component's diameter. Neighbours are combined by `min` before each shuffle
    and never gathered; joins on a hot label are left to adaptive skew handling. Every round is checkpointed.
    """
    pairs = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a <> b")
    arcs = checkpointed(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpointed(arcs.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        # The smallest label around each node; it also reaches the node's present root, which may then be hooked lower.
        near = arcs.join(labels, arcs["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        seen = labels.join(near, labels["node"] == near["a"]).select("node", "label", "near")
        hooks = (
            seen.select(F.col("node").alias("to"), F.least("label", "near").alias("low"))
            .unionByName(seen.select(F.col("label").alias("to"), F.least("label", "near").alias("low")))
            .groupBy("to")
            .agg(F.min("low").alias("low"))
        )
        hooked = labels.join(hooks, labels["node"] == hooks["to"]).select("node", "label", "low")
        jump = hooked.select(F.col("node").alias("at"), F.col("low").alias("further"))
        moved = checkpointed(
            hooked.join(jump, hooked["low"] == jump["at"]).select(
                "node", F.least("low", "further").alias("label"), (F.col("label") != F.least("low", "further")).alias("changed")
            )
        )
        labels = moved.select("node", "label")
        if moved.where("changed").isEmpty():
            return labels.withColumnRenamed("label", "root")


def stored(frame: DataFrame, name: str, **options: str) -> DataFrame:
    """The same rows written as Parquet to a new path in the shared checkpoint folder, and read again."""
    checkpoint_ready(frame.sparkSession)
    path = f"{frame.sparkSession.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    frame.write.options(**options).parquet(path)
    return frame.sparkSession.read.parquet(path)
