"""Embedding near-duplicates: a forest of random-projection trees with spill overlap, compared within leaves, verified and united."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import checkpointed, components

MIN_COSINE = 0.98
TREES = 4
LEAF_ROWS = 256
# The tops of the trees are fitted on at most this many vectors; every vector is routed through them.
SAMPLE_ROWS = 20_000
MIN_NODE_SAMPLE = 32
# Vectors that one task splits further in memory. A larger group, which no plane divides, is compared block by block.
GROUP_ROWS = 4096
# Vectors this near to a plane go to both sides, in standard deviations of the distance a linked pair can have along a
# random direction: a pair is parted only if it straddles the plane by more than twice that.
SPILL = 1.0
SEED = 20


def _spill(dims: int) -> float:
    return SPILL * math.sqrt(2 * (1 - MIN_COSINE)) / math.sqrt(dims)


def _plane(dims: int, *key: int) -> np.ndarray:
    """A random unit vector that depends on the key alone."""
    direction = np.random.default_rng([SEED, dims, *key]).standard_normal(dims)
    return direction / np.linalg.norm(direction)


def grow(sample: np.ndarray, tree: int, share: float, node: int = 1) -> dict[int, float]:
    """Thresholds of the top nodes of a tree, fitted on a sample of which each vector stands for `share` vectors.

    Nodes are numbered like a heap. A node is split at the sample's median along its plane until it stands for
    GROUP_ROWS vectors or has too few in the sample.
    """
    if len(sample) * share <= GROUP_ROWS or len(sample) < MIN_NODE_SAMPLE:
        return {}
    along = sample @ _plane(sample.shape[1], tree, node)
    cut = float(np.median(along))
    spill = _spill(sample.shape[1])
    left, right = along <= cut + spill, along >= cut - spill
    if left.all() or right.all():
        return {}
    own = {node: cut}
    own.update(grow(sample[left], tree, share, 2 * node))
    own.update(grow(sample[right], tree, share, 2 * node + 1))
    return own


def route(vectors: np.ndarray, cuts: dict[int, float], tree: int, node: int = 1, rows: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(bottom node, rows) of all vectors; those near a plane are in more than one."""
    rows = np.arange(len(vectors)) if rows is None else rows
    if node not in cuts:
        if len(rows):
            yield node, rows
        return
    along = vectors[rows] @ _plane(vectors.shape[1], tree, node)
    spill = _spill(vectors.shape[1])
    yield from route(vectors, cuts, tree, 2 * node, rows[along <= cuts[node] + spill])
    yield from route(vectors, cuts, tree, 2 * node + 1, rows[along >= cuts[node] - spill])


def leaf_links(vectors: np.ndarray, rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of unit vectors with MIN_COSINE or more, found in the leaves of one tree; a pair may come from several leaves."""
    todo = [np.arange(len(vectors))]
    while todo:
        rows = todo.pop()
        if len(rows) > LEAF_ROWS:
            direction = rng.standard_normal(vectors.shape[1])
            along = vectors[rows] @ (direction / np.linalg.norm(direction))
            cut, spill = np.median(along), _spill(vectors.shape[1])
            left, right = rows[along <= cut + spill], rows[along >= cut - spill]
            # A leaf that the plane hardly divides is a cluster: it's compared as it is.
            if max(len(left), len(right)) <= 0.8 * len(rows):
                todo += [left, right]
                continue
        own = vectors[rows]
        for begin in range(0, len(rows), LEAF_ROWS):
            near = own[begin : begin + LEAF_ROWS] @ own[begin:].T >= MIN_COSINE - 1e-9
            a, b = np.nonzero(near)
            later = a < b
            yield rows[a[later] + begin], rows[b[later] + begin]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows of a with rows of b in double precision, from the vectors as they are."""
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(list(column), np.float64)


def class_links(classes: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), a < b, of classes whose vectors have the same label and length, and MIN_COSINE or more.

    `classes` has key (long), label, dims and vector (array of doubles), no two with the same label and vector.
    """
    total = max(1, classes.count())
    fraction = min(1.0, SAMPLE_ROWS / total)
    sample = (
        classes.where(F.pmod(F.xxhash64("key", F.lit(SEED)), F.lit(1 << 30)) < int(fraction * (1 << 30)))
        .orderBy(F.xxhash64("key", F.lit(SEED))).limit(SAMPLE_ROWS).select("label", "dims", "vector").toPandas()
    )
    share = total / max(1, len(sample))
    cuts: dict[tuple[int, int], list[dict[int, float]]] = {}
    for (label, dims), own in sample.groupby(["label", "dims"]):
        unit = _unit(_matrix(own["vector"]))
        cuts[label, dims] = [grow(unit, tree, share) for tree in range(TREES)]
    label_kind = classes.schema["label"].dataType.simpleString()

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for (label, dims), own in frame.groupby(["label", "dims"], sort=False):
                unit = _unit(_matrix(own["vector"]))
                for tree in range(TREES):
                    for node, rows in route(unit, cuts.get((label, dims), [{}] * TREES)[tree], tree):
                        yield own.iloc[rows].assign(tree=tree, node=node)

    columns = f"key long, label {label_kind}, dims int, vector array<double>"
    placed = classes.select("key", "label", "dims", "vector").mapInPandas(place, f"{columns}, tree int, node long")
    group = ["label", "dims", "tree", "node"]
    # Groups beyond the bound are dealt into blocks, and every pair of blocks is a task.
    blocks = placed.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS / 2).cast("int").alias("blocks"))
    dealt = (
        placed.join(blocks, group)
        .withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
    )

    def link(own: pd.DataFrame) -> pd.DataFrame:
        vectors, keys = _matrix(own["vector"]), own["key"].to_numpy()
        order = np.argsort(keys)
        vectors, keys = vectors[order], keys[order]
        seed = [SEED, int(own["tree"].iloc[0]), int(own["node"].iloc[0]) & 0xFFFFFFFF, len(keys)]
        found = []
        for a, b in leaf_links(_unit(vectors), np.random.default_rng(seed)):
            sure = cosines(vectors[a], vectors[b]) >= MIN_COSINE
            found.append(np.stack([keys[a[sure]], keys[b[sure]]], axis=1))
        pairs = np.unique(np.sort(np.concatenate(found), axis=1), axis=0) if found else np.zeros((0, 2), np.int64)
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return dealt.groupBy(*group, "low", "high").applyInPandas(link, "a long, b long").distinct()


def near_duplicates(vectors: DataFrame, id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """One row per row of `vectors`: (id, n_links long, component_id, kept boolean).

    Vectors link if their labels are equal and not null, their lengths are equal and their cosine is MIN_COSINE or more.
    Null, empty and zero vectors, and those with null or non-finite components, link with nothing and are kept, as their
    own component. n_links counts the other rows linked directly, copies included; component_id is the smallest id
    reachable. Equal vectors of a label enter the forest as one, so copies are never paired. Links are found by the
    forest, whose recall the tests measure against brute force; none below the cosine is returned. Different vectors are
    told apart by a 64-bit hash; among 10^9 of them the odds that any two share one are below 3 %.
    """
    rows = vectors.select(
        F.col(id).alias("id"), F.col(label).alias("label"), F.transform(F.col(embedding), lambda x: x.cast("double")).alias("vector")
    )
    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    sound = (
        F.col("label").isNotNull()
        & F.coalesce(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
        & F.coalesce((length > 0) & (length < float("inf")), F.lit(False))
    )
    key = F.when(sound, F.xxhash64("label", "vector")).alias("key")
    keyed = rows.select("id", "label", "vector", key)
    classes = checkpointed(
        keyed.where("key is not null")
        .groupBy("key")
        .agg(F.min("id").alias("lowest"), F.count(F.lit(1)).alias("rows"), F.first("label").alias("label"), F.first("vector").alias("vector"))
        .withColumn("dims", F.size("vector"))
    )
    pairs = checkpointed(class_links(classes))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    sizes = classes.select(F.col("key").alias("b"), F.col("rows").alias("more"))
    direct = both.join(sizes, "b").groupBy(F.col("a").alias("key")).agg(F.sum("more").alias("more"))
    roots = components(pairs, "a", "b").select(F.col("node").alias("key"), "root")
    rooted = classes.select("key", "lowest", "rows").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    lowest = rooted.groupBy("root").agg(F.min("lowest").alias("component"))
    member = (
        rooted.join(lowest, "root")
        .join(direct, "key", "left")
        .select("key", "component", (F.col("rows") - 1 + F.coalesce("more", F.lit(0))).alias("n"))
    )
    return (
        keyed.select("id", "key")
        .join(member, "key", "left")
        .select(
            F.col("id").alias(id),
            F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
            F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"),
        )
    )
