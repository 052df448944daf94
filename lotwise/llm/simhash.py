"""SimHash near-duplicates: fingerprints, linked by a grid range-join over segment popcounts, then verified exactly."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import checkpointed, components, exact, free_name, renamed_free, restored, schema_of, small_batches

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
# The embedding counts the set bits of 32 segments of two bits. Its coordinates form this many groups; two fingerprints
# at Manhattan distance 4 or less agree on all groups but 4, so each grid keeps GROUPS - MAX_BITS of them as coordinates.
GROUPS = 7

_EVEN = 0x5555555555555555


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text, signed: a bit is set if it is set in over half the hashes of all shingles."""
    packed = b" ".join((text or "").encode().lower().split())
    if not packed:
        return 0
    spaces = np.flatnonzero(np.frombuffer(packed, np.uint8) == 32)
    beyond = len(spaces) + 1 - SHINGLE_WORDS
    if beyond <= 0:
        hashes = [xxhash.xxh64_intdigest(packed, SEED)]
    else:
        # Words are joined by one space, so a shingle is one slice of the packed text.
        begins = [0, *(spaces[:beyond] + 1).tolist()]
        ends = [*spaces[SHINGLE_WORDS - 1 :].tolist(), len(packed)]
        hashes = [xxhash.xxh64_intdigest(packed[i:j], SEED) for i, j in zip(begins, ends, strict=True)]
    octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for begin in range(0, len(octets), 1 << 16):
        ones += np.unpackbits(octets[begin : begin + (1 << 16)], axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, text: str, name: str) -> DataFrame:
    """`docs` without its text column and with `name`, the fingerprint (long). A null or blank text has fingerprint 0."""
    kept = [c for c in docs.columns if c != text]
    carried = exact(docs.select(*kept, text))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_batches(frames):
            out = frame[kept].copy()
            out[name] = np.array([fingerprint(x) for x in frame[text]], np.int64)
            yield out

    printed = carried.mapInPandas(run, f"{schema_of(carried.select(*kept))}, `{name}` long")
    return restored(printed, docs.select(*kept))


def embedding(bits: Column) -> Column:
    """The set bits of each two-bit segment, as 32 counts of two bits packed into one long."""
    upper = F.shiftrightunsigned(bits, 1)
    one = bits.bitwiseXOR(upper).bitwiseAND(F.lit(_EVEN))
    two = bits.bitwiseAND(upper).bitwiseAND(F.lit(_EVEN))
    return one.bitwiseOR(F.shiftleft(two, 1))


def manhattan(a: Column, b: Column) -> Column:
    """Manhattan distance of two embeddings: counts 0 to 2 differ by 2 where only the high bits differ, else by the low bit."""
    differ = a.bitwiseXOR(b)
    low = differ.bitwiseAND(F.lit(_EVEN))
    high = F.shiftrightunsigned(differ, 1).bitwiseAND(F.lit(_EVEN))
    return F.bit_count(low) + 2 * F.bit_count(high.bitwiseAND(F.bitwise_not(low)))


def _group_masks() -> list[int]:
    """The bits of the embedding that belong to each coordinate group, as signed longs."""
    edges = [2 * (32 * g // GROUPS) for g in range(GROUPS + 1)]
    masks = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:], strict=False)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(prints: DataFrame, bits: str) -> DataFrame:
    """All pairs (a, b), a < b, of distinct fingerprints that differ in MAX_BITS bits or fewer; no pair comes twice.

    Every grid has the embedding's counts of some groups as its cell. A pair within the distance shares a cell of at
    least one grid, and is emitted only in the first it shares; the Manhattan distance of the embeddings never exceeds
    the Hamming distance, so it rejects candidates before the exact count of differing bits. Nulls link with nothing.

    Spark sizes the cells as if there were one for each fingerprint, so below its limit it would broadcast all of them:
    the hint keeps the join a merge join.
    """
    masks = _group_masks()
    grids = list(combinations(range(GROUPS), GROUPS - MAX_BITS))
    point = F.col("bits")
    cells = F.array(
        *[
            F.struct(
                F.lit(n).cast("byte").alias("grid"),
                F.col("emb").bitwiseAND(F.lit(_signed(sum(_unsigned(masks[g]) for g in grid)))).alias("cell"),
            )
            for n, grid in enumerate(grids)
        ]
    )
    placed = (
        prints.select(F.col(bits).alias("bits"))
        .where("bits is not null")
        .distinct()
        .withColumn("emb", embedding(point))
        .select("bits", F.inline(cells))
    )
    left = placed.select("grid", "cell", F.col("bits").alias("a"))
    right = placed.select(F.col("grid").alias("grid_b"), F.col("cell").alias("cell_b"), F.col("bits").alias("b"))
    a, b = embedding(F.col("a")), embedding(F.col("b"))
    differ = a.bitwiseXOR(b)
    # Which groups agree, as a bitmap, tells the number of the first grid that both share.
    agree = F.lit(0)
    for g, mask in enumerate(masks):
        agree = agree + F.when(differ.bitwiseAND(F.lit(mask)) == 0, 1 << g).otherwise(0)
    shared = [next((n for n, grid in enumerate(grids) if all(m >> g & 1 for g in grid)), -1) for m in range(1 << GROUPS)]
    first = F.get(F.array(*[F.lit(n) for n in shared]), agree)
    near = (manhattan(a, b) <= MAX_BITS) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)
    met = left.join(right.hint("merge"), (F.col("grid") == F.col("grid_b")) & (F.col("cell") == F.col("cell_b")) & (F.col("a") < F.col("b")) & near)
    return met.where(F.col("grid") == first).select("a", "b")


def _unsigned(value: int) -> int:
    return value & ((1 << 64) - 1)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `docs`: (id, bits, root, component_id), without the other columns.

    component_id is the smallest id reachable over fingerprints that link (equal ones do), the row's own included.
    Null and blank texts share fingerprint 0, which links like any other. Null ids count for no minimum. Repeated rows
    stay. An empty table gives no rows. Groups of equal fingerprints enter the links as one point, so copies are never
    paired; their smallest id is combined before the shuffle.
    """
    return group_prints(checkpointed(with_fingerprints(docs.select(id, text), text, "bits")), id, "bits")


def group_prints(prints: DataFrame, id: str, bits: str) -> DataFrame:
    """`prints` with root, the smallest fingerprint of the component, and component_id, the component's smallest id."""
    classes = prints.groupBy(F.col(bits).alias("print")).agg(F.min(id).alias("lowest"))
    roots = components(links(classes, "print"), "a", "b")
    rooted = classes.join(roots, classes["print"] == roots["node"], "left").select(
        "print", "lowest", F.coalesce("root", "print").alias("root")
    )
    smallest = rooted.groupBy(F.col("root").alias("of")).agg(F.min("lowest").alias("component_id"))
    member = rooted.join(smallest, rooted["root"] == smallest["of"]).select("print", "root", "component_id")
    return prints.join(member, prints[bits] == member["print"], "left").drop("print")


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs`, columns unchanged, of which one of each group of near-duplicates stays: that of the smallest id.

    Of several rows with that id, the text with the smallest hash stays, and of equal texts the smallest row. A group in
    which all ids are null keeps one row likewise. Texts are shuffled once, to meet the narrow list of rows that stay.
    """
    digest = free_name(docs, "digest")
    marked = docs.withColumn(digest, F.xxhash64(text))
    prints = with_fingerprints(marked.select(id, text, F.col(digest).alias("digest")), text, "bits")
    grouped = group_prints(checkpointed(prints), id, "bits")
    first = (
        grouped.where(F.col(id).eqNullSafe(F.col("component_id")))
        .groupBy("root", "digest", F.col(id).alias("first_id"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .groupBy("root", "first_id")
        .agg(F.min(F.struct("digest", "rows")).alias("least"))
        .select("first_id", F.col("least.digest").alias("first_digest"), F.col("least.rows").alias("rows"))
    )
    first = renamed_free(first, marked)
    first_id, first_digest, rows = first.columns
    met = marked.join(first, marked[id].eqNullSafe(first[first_id]) & (marked[digest] == first[first_digest]))
    alone = met.where(F.col(rows) == 1).select(*docs.columns)
    # Rows with one id and text are combined to the smallest before the shuffle.
    least = F.min(F.struct(*docs.columns)).alias("row")
    repeated = met.where(F.col(rows) > 1).groupBy(first_id, digest).agg(least).select("row.*")
    return alone.unionByName(repeated)
