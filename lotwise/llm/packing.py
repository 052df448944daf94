"""Best-fit packing of documents into sequences of fixed capacity, without two pieces of one source or one duplicate cluster in a sequence."""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import exact, restored

CAPACITY = 1024
# Documents that are packed together, on average: one in so many begins a shard.
SHARD_ROWS = 4096
# Parts of the range of hashes in which rows are put in order.
RANGES = 1 << 16
SHARD_BINS = 1 << 32


class Bins:
    """Open bins ordered by what is left in them; each carries the bitmaps of its sources and duplicate clusters."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, offset in it) of the tightest bin that holds the piece and neither its source nor its cluster."""
        for at in range(bisect_left(self.order, (size, -1)), len(self.order)):
            left, number = self.order[at]
            if not (self.sources[number] & source or self.clusters[number] & cluster):
                del self.order[at]
                break
        else:
            left, number = self.capacity, len(self.sources)
            self.sources.append(0)
            self.clusters.append(0)
        self.sources[number] |= source
        self.clusters[number] |= cluster
        if left > size:
            insort(self.order, (left - size, number))
        return number, self.capacity - left


def pack_shard(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(document, begin, end, bin, offset) of all pieces; documents longer than a bin are cut into full bins and a rest.

    Larger pieces come first, ties in the order given. A null source or cluster is in conflict with nothing.
    """
    pieces = []
    for n, size in enumerate(sizes):
        pieces += [(begin, min(size, begin + capacity), n) for begin in range(0, size, capacity)]
    pieces.sort(key=lambda p: (p[0] - p[1], p[2], p[0]))
    bins = Bins(capacity)
    source_bit, cluster_bit = _bits(sources), _bits(clusters)
    return [
        (n, begin, end, *bins.place(end - begin, source_bit.get(sources[n], 0), cluster_bit.get(clusters[n], 0)))
        for begin, end, n in pieces
    ]


def _bits(keys: list) -> dict[object, int]:
    """One bit of the bitmaps for each key; null has none."""
    return {key: 1 << n for n, key in enumerate(k for k in dict.fromkeys(keys) if k is not None)}


def _in_shards(rows: DataFrame, place: Column) -> DataFrame:
    """`rows` with `shard`, the number of rows that begin one, up to their own place.

    Rows are ordered in parts of the range of places; how many begin a shard in earlier parts is a table of RANGES rows.
    """
    first = F.pmod(F.xxhash64("place", F.lit(1)), F.lit(SHARD_ROWS)) == 0
    placed = rows.withColumn("place", place).withColumn("part", F.floor(F.col("place") / (2.0**64 / RANGES)))
    begun = placed.where(first).groupBy("part").agg(F.count(F.lit(1)).alias("begun"))
    every = rows.sparkSession.range(-RANGES // 2, RANGES // 2 + 1, numPartitions=1).select(F.col("id").alias("of_part"))
    before = F.coalesce(F.sum("begun").over(Window.orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    earlier = every.join(begun, F.col("of_part") == F.col("part"), "left").select("of_part", before.alias("before"))
    upto = Window.partitionBy("part").orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = placed.withColumn("here", F.sum(first.cast("long")).over(upto))
    met = numbered.join(F.broadcast(earlier), F.col("part") == F.col("of_part"))
    return met.select(*rows.columns, (F.col("before") + F.col("here")).alias("shard"))


def pack(
    docs: DataFrame, size: Column, cluster: Column, id: str = "doc_id", source: str = "source", capacity: int = CAPACITY
) -> DataFrame:
    """One row per piece: (id, copy, piece, piece_begin, piece_end, bin_id, bin_offset), all but the id long.

    `size` is a document's length, `cluster` its duplicate cluster. Documents in the order of a hash of theirs
    are cut into shards before those whose second hash says so, one in SHARD_ROWS, whatever the table's size. Each shard is packed by itself: largest piece first, into the tightest bin of its shard that
    has room and no piece of the same source or cluster, else into a new bin. Pieces of a document beyond the capacity
    are full bins and a rest. Null or zero sizes give one piece without length, bin_id and offset null. Repeated rows are told apart by `copy`,
    so they spread over shards like other rows. Null sources and clusters conflict with nothing. Only these columns are
    shuffled, never texts. An empty table gives no rows.
    """
    rows = docs.select(
        F.col(id).alias("id"),
        F.col(source).alias("source"),
        cluster.alias("cluster"),
        F.greatest(F.coalesce(size.cast("long"), F.lit(0)), F.lit(0)).alias("size"),
    )
    counted = exact(rows).groupBy("id", "source", "cluster", "size").agg(F.count(F.lit(1)).alias("copies"))
    single = counted.select("id", "source", "cluster", "size", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))
    place = F.xxhash64(F.col("id").cast(rows.schema["id"].dataType), F.col("source").cast(rows.schema["source"].dataType), "size", "copy")
    dealt = _in_shards(single.where("size > 0"), place)
    kind = dealt.schema["id"].dataType.simpleString()

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "id", "copy", "source", "cluster"], ascending=[False, True, True, True, True])
        sources = [None if pd.isna(x) else x for x in group["source"]]
        clusters = [None if pd.isna(x) else x for x in group["cluster"]]
        packed = pack_shard([int(x) for x in group["size"]], sources, clusters, capacity)
        at = [p[0] for p in packed]
        base = int(group["shard"].iloc[0]) * SHARD_BINS
        return pd.DataFrame(
            {
                "id": group["id"].iloc[at].array,
                "copy": group["copy"].iloc[at].array,
                "piece": [p[1] // capacity for p in packed],
                "piece_begin": [p[1] for p in packed],
                "piece_end": [p[2] for p in packed],
                "bin_id": [base + p[3] for p in packed],
                "bin_offset": [p[4] for p in packed],
            }
        )

    columns = "copy long, piece long, piece_begin long, piece_end long, bin_id long, bin_offset long"
    packed = dealt.groupBy("shard").applyInPandas(run, f"id {kind}, {columns}")
    none = single.where("size = 0").select(
        "id", "copy", *[F.lit(0).cast("long").alias(c) for c in ("piece", "piece_begin", "piece_end")],
        *[F.lit(None).cast("long").alias(c) for c in ("bin_id", "bin_offset")],
    )
    return restored(packed.unionByName(none), rows.select("id")).withColumnRenamed("id", id)


def pack_texts(docs: DataFrame, text: str = "text", **names) -> DataFrame:
    """`pack` by words between white space, where documents with equal texts are one duplicate cluster."""
    words = F.size(F.filter(F.split(F.coalesce(F.col(text), F.lit("")), r"\s+"), lambda w: w != ""))
    return pack(docs, words, F.xxhash64(text), **names)
