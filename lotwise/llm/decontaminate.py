"""Benchmark decontamination: Wu-Manber search of whole documents for windows of benchmark items, word by word.

Words are the letters of the search. A shift table says for each block of words how far the search may skip; where it
may not, the block picks a bucket of test windows, whose first words and then all words are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import checkpointed, exact, free_name, renamed_free, restored, small_batches

WINDOW_WORDS = 13
BLOCK_WORDS = 2
# A document is contaminated if at least one word in this many is part of a benchmark window.
HIT_SHARE = 20
# Benchmark words searched for in one pass; more take further passes, so a worker's tables stay bounded.
PASS_WORDS = 200_000

_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Runs of a-z (A-Z lower-cased), 0-9 and characters beyond ASCII, as UTF-8. Null has none."""
    return (text or "").encode().translate(_WORD_BYTES).split()


class Windows:
    """Search tables for all windows of one length."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.block = min(BLOCK_WORDS, size)
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, dict[bytes, list[tuple[list[bytes], int, list[int]]]]] = {}

    def add(self, words: list[bytes], begin: int, item: int) -> None:
        size, block = self.size, self.block
        for end in range(block, size + 1):
            key = b" ".join(words[begin + end - block : begin + end])
            self.shift[key] = min(self.shift.get(key, size), size - end)
        bucket = self.buckets.setdefault(b" ".join(words[begin + size - block : begin + size]), {})
        same_start = bucket.setdefault(b" ".join(words[begin : begin + block]), [])
        for other, at, items in same_start:
            if other[at : at + size] == words[begin : begin + size]:
                if items[-1] != item:
                    items.append(item)
                return
        same_start.append((words, begin, [item]))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """(first word, items) of every occurrence of a window."""
        size, block, shift, buckets = self.size, self.block, self.shift, self.buckets
        far, end, last = size - block + 1, size, len(words)
        while end <= last:
            key = words[end - 1] if block == 1 else words[end - 2] + b" " + words[end - 1]
            skip = shift.get(key, far)
            if skip:
                end += skip
                continue
            begin = end - size
            for other, at, items in buckets[key].get(b" ".join(words[begin : begin + block]), ()):
                if other[at : at + size] == words[begin:end]:
                    yield begin, items
                    break
            end += 1


def tables(items: list[tuple[str, str]]) -> list[Windows]:
    """Search tables, one for each window length that occurs. Items without words have none."""
    by_size: dict[int, Windows] = {}
    for n, (_, text) in enumerate(items):
        words = words_of(text)
        size = min(WINDOW_WORDS, len(words))
        for begin in range(len(words) - size + 1 if size else 0):
            by_size.setdefault(size, Windows(size)).add(words, begin, n)
    return list(by_size.values())


def search(text: str | None, windows: list[Windows]) -> tuple[int, list[tuple[int, int]], set[int]]:
    """Number of words; merged ranges of hit words; numbers of the items that occur."""
    words = words_of(text)
    found: list[tuple[int, int]] = []
    items: set[int] = set()
    for table in windows:
        for begin, own in table.search(words):
            found.append((begin, begin + table.size))
            items.update(own)
    return len(words), _merged(found), items


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for begin, end in sorted(ranges):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(b, e) for b, e in out]


def _passes(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[str, str]]]:
    """The benchmark in pieces of about PASS_WORDS words, streamed to the driver piece by piece. At least one, maybe empty."""
    piece: list[tuple[str, str]] = []
    size = pieces = 0
    named = benchmark.select(F.col(item_id).cast("string"), F.col(text)).where(F.col(item_id).isNotNull())
    for name, content in named.toLocalIterator():
        piece.append((name, content))
        size += len(words_of(content))
        if size >= PASS_WORDS:
            yield piece
            piece, size, pieces = [], 0, pieces + 1
    if piece or not pieces:
        yield piece


def contamination(
    docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row per row of `docs`: (id, digest long, n_words long, ranges array<struct<begin, end>>, items array<string>).

    `digest` is the xxhash64 of the text; `ranges` are the merged ranges of words inside any occurrence of a benchmark window, `items` the sorted distinct ids
    of the items with occurring windows. A window is WINDOW_WORDS consecutive words of an item; an item of fewer words,
    but not none, is one window. Null and empty texts have no words and no hits; items without words or id are nowhere;
    an empty benchmark hits nothing, an empty table gives no rows; repeated rows stay; other columns are ignored.

    A benchmark of up to PASS_WORDS words is one pass over the documents without any shuffle. A larger one takes more
    passes, whose ranges and items are brought together by row.
    """
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    found = [_one_pass(rows, piece) for piece in _passes(benchmark, item_id, item_text)]
    base = found[0]
    if len(found) > 1:
        # Rows with hits only, equal ones as one, which have equal hits: at most one row a pass meets in a group.
        more = [x.where(F.size("ranges") > 0).withColumn("pass", F.lit(n)) for n, x in enumerate(found) if n]
        hits = reduce(DataFrame.unionByName, more).groupBy("id", "digest", "pass").agg(F.any_value("ranges").alias("ranges"), F.any_value("items").alias("items"))
        later = hits.groupBy(F.col("id").alias("hit_id"), F.col("digest").alias("hit_digest")).agg(
            F.flatten(F.collect_list("ranges")).alias("more_ranges"), F.flatten(F.collect_list("items")).alias("more_items")
        )
        # Many equal rows meet one: adaptive execution splits them.
        met = base.join(later, base["id"].eqNullSafe(later["hit_id"]) & (base["digest"] == later["hit_digest"]), "left")
        both = lambda a, b: F.when(F.col(b).isNull(), F.col(a)).otherwise(F.concat(a, b))
        base = met.select(
            "id", "digest", "n_words", both("ranges", "more_ranges").alias("ranges"),
            F.array_sort(F.array_distinct(both("items", "more_items"))).alias("items"),
        )
    merged = F.aggregate(
        F.array_sort("ranges"),
        F.expr("cast(array() as array<struct<begin: bigint, end: bigint>>)"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= x["begin"]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(
                    F.struct(
                        F.try_element_at(done, F.lit(-1))["begin"].alias("begin"),
                        F.greatest(F.try_element_at(done, F.lit(-1))["end"], x["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    ranges = merged if len(found) > 1 else F.col("ranges")
    return base.select(F.col("id").alias(id), "digest", "n_words", ranges.alias("ranges"), "items")


def _one_pass(rows: DataFrame, items: list[tuple[str, str]]) -> DataFrame:
    names = [name for name, _ in items]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        windows = tables(items)
        for frame in small_batches(frames):
            found = [search(x, windows) for x in frame["text"]]
            yield pd.DataFrame(
                {
                    "id": frame["id"],
                    "digest": frame["digest"],
                    "n_words": [n for n, _, _ in found],
                    "ranges": [[{"begin": b, "end": e} for b, e in ranges] for _, ranges, _ in found],
                    "items": [sorted({names[i] for i in own}) for _, _, own in found],
                }
            )

    carried = exact(rows.withColumn("digest", F.xxhash64("text")))
    kind = carried.schema["id"].dataType.simpleString()
    found = carried.mapInPandas(
        run, f"id {kind}, digest long, n_words long, ranges array<struct<begin: bigint, end: bigint>>, items array<string>"
    )
    return restored(found, rows.select("id"))


def n_hit() -> Column:
    """Words inside any occurrence of a window."""
    return F.aggregate("ranges", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["begin"])


def is_contaminated() -> Column:
    return (n_hit() > 0) & (HIT_SHARE * n_hit() >= F.col("n_words"))


# Rows found contaminated that may be broadcast; more meet the documents by a shuffle.
BROADCAST_ROWS = 500_000


def clean(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs`, columns unchanged, that are not contaminated."""
    found = contamination(docs, benchmark, id, text).where(is_contaminated())
    digest = free_name(docs, "digest")
    marked = docs.withColumn(digest, F.xxhash64(text))
    bad = renamed_free(checkpointed(found.select(id, "digest").distinct()), marked)
    bad_id, bad_digest = bad.columns
    bad = F.broadcast(bad) if bad.count() <= BROADCAST_ROWS else bad
    same = marked[id].eqNullSafe(bad[bad_id]) & (marked[digest] == bad[bad_digest])
    return marked.join(bad, same, "left_anti").drop(digest)
