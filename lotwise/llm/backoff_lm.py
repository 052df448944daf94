"""Stupid-backoff scores: a count table of n-grams partitioned by hash, joined to the n-grams of the documents, summed per document.

Counts are taken over all documents. A document is scored with its own n-grams taken out of the counts, so that text
seen nowhere else backs off. Equal texts are one text with a number of copies; n-grams are rows, one for each block of
texts that they occur in, which travel as arrays. Orders are counted upwards: an n-gram can only occur in another block
if both (n-1)-grams in it do.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from zlib import compress, decompress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Words of the longest n-grams, unless the caller names another order.
ORDER = 3
BACKOFF = 0.4
# Text that one task explodes at once, on average.
BLOCK_BYTES = 8 << 20
# Text whose n-grams one task counts, on average.
TASK_BYTES = 8 << 20
# Parts of the range of hashes, at least: an array holds a block's n-grams of one part.
SLICES = 2048
# Counts that a task holds before it sends them back.
HELD = 1 << 21

_PIECE = 1 << 20
_WORD = np.array([48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 for c in range(256)])
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint64) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 ** 64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        row = np.full(size, base, np.uint64)
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    return out[0], out[1]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * _MIX
    return values ^ (values >> np.uint64(29))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts in order, and the number of its text.

    Words are runs of letters (A-Z lower-cased), digits and characters beyond ASCII. Null and empty texts have none.
    """
    raws = [(x or "").encode() for x in texts]
    starts = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raws], dtype=np.int64)])[:-1]
    raw = np.frombuffer(b"\n".join(raws), np.uint8)
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    at = 0
    while at < len(raw):
        end = min(len(raw), at + _PIECE)
        while end < len(raw) and _WORD[raw[end]]:
            end += 1
        piece = raw[at:end]
        up, down = _powers(1 << max(20, int(len(piece) + 1).bit_length()))
        edge = np.flatnonzero(np.diff(_WORD[piece].astype(np.int8), prepend=0, append=0))
        first, last = edge[::2], edge[1::2]
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LOWER[piece] * up[: len(piece)])])
        hashes.append(_mixed((running[last] - running[first]) * down[first]))
        places.append(first + at)
        at = end
    return np.concatenate(hashes), np.searchsorted(starts, np.concatenate(places), side="right") - 1


def grams(hashes: np.ndarray, owner: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the n-gram that ends at each word, and whether the text has that many words up to there."""
    out = _mixed(hashes + np.uint64(order))
    whole = np.ones(len(hashes), bool)
    for back in range(1, order):
        out[back:] = _mixed(out[back:] * np.uint64(_BASE) + hashes[:-back])
        whole[:back] = False
        whole[back:] &= owner[back:] == owner[:-back]
    return out, whole


class Level:
    """The n-grams of one order in some texts.

    By word: whether one ends there (`whole`). By word with one: its place among the distinct ones (`of`) and its
    occurrences in that text (`own`). By distinct one: its hash (`every`) and its occurrences in all copies (`often`).
    """

    def __init__(self, hashes: np.ndarray, owner: np.ndarray, copies: np.ndarray, order: int) -> None:
        found, self.whole = grams(hashes, owner, order)
        found, owner = found[self.whole], owner[self.whole]
        # Occurrences of an n-gram in order, so that those in one text lie together.
        by_gram = np.argsort(found, kind="stable")
        found, owner = found[by_gram], owner[by_gram]
        new = np.ones(len(found), bool)
        new[1:] = found[1:] != found[:-1]
        first = np.flatnonzero(new)
        self.every = found[first]
        self.often = np.add.reduceat(copies[owner], first) if len(first) else np.zeros(0, np.int64)
        self.of, self.own = np.empty(len(found), np.int32), np.empty(len(found), np.int32)
        self.of[by_gram] = np.cumsum(new, dtype=np.int32) - 1
        new[1:] |= owner[1:] != owner[:-1]
        sizes = np.diff(np.append(np.flatnonzero(new), len(found)))
        self.own[by_gram] = np.repeat(sizes, sizes)

    def within(self, shorter: Level, elsewhere: np.ndarray) -> np.ndarray:
        """The distinct n-grams, by place, of which both shorter ones are among the places `elsewhere` of theirs."""
        is_elsewhere = np.zeros(len(shorter.every), bool)
        is_elsewhere[elsewhere] = True
        ends = np.zeros(len(self.whole), bool)
        ends[shorter.whole] = is_elsewhere[shorter.of]
        ends[1:] &= ends[:-1].copy()
        possible = np.zeros(len(self.every), bool)
        possible[self.of[ends[self.whole]]] = True
        return np.flatnonzero(possible)


def _score(texts: int, owner: np.ndarray, left: list[np.ndarray], whole: list[np.ndarray], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Words and log10 score of each text, from the counts in the other documents at each word, by order."""
    size = np.bincount(owner, minlength=texts)
    others = np.maximum(words - size[owner], 0)
    # A word seen nowhere else has one chance in all other words and itself, once more backed off.
    level = np.where(left[0] > 0, left[0] / np.maximum(others, 1), BACKOFF / (others + 1.0))
    for n in range(1, len(left)):
        context = np.concatenate([np.zeros(1, np.int64), left[n - 1][:-1]]) if len(owner) else left[n - 1]
        seen = left[n] > 0
        level = np.where(seen, left[n] / np.maximum(context, 1), np.where(whole[n], BACKOFF * level, level))
    return size, np.bincount(owner, np.log10(level), texts)


def _packed(frames: Iterator[pd.DataFrame], order: int) -> Iterator[pd.DataFrame]:
    """Counts (at, total) as bytes, a row for each block and order among the counts held at once."""
    held: list[pd.DataFrame] = []

    def rows() -> pd.DataFrame:
        found = pd.concat(held).sort_values("at")
        at, total = found["at"].to_numpy(), found["total"].to_numpy()
        held.clear()
        lists, places = at >> 32, at & 0xFFFFFFFF
        cuts = np.flatnonzero(np.diff(lists, prepend=-1))
        # Differences have few digits that aren't zero; bytes of the same value lie together.
        both = np.stack([np.diff(places, prepend=0), total])
        both[0, cuts] = places[cuts]
        pack = lambda part: compress(np.ascontiguousarray(part).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)
        packs = [bytes([n]) + pack(x) for n, x in zip(lists[cuts] % order + 1, np.split(both, cuts[1:], axis=1), strict=True)]
        return pd.DataFrame({"block": lists[cuts] // order, "pack": packs})

    for frame in frames:
        held.append(frame)
        if sum(map(len, held)) >= HELD:
            yield rows()
    if sum(map(len, held)):
        yield rows()


def _unpacked(counted: pd.DataFrame, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the list that was sent, and totals there, from the packs of one block."""
    out = [np.zeros((2, 0), np.int64)]
    for raw in (x for packs in counted["packs"] for x in packs if x[0] == order):
        planes = np.frombuffer(decompress(raw[1:]), np.uint8).reshape(8, -1)
        steps, total = np.ascontiguousarray(planes.T).view(np.int64).reshape(2, -1)
        out.append(np.stack([np.cumsum(steps), total]))
    at, totals = np.concatenate(out, axis=1)
    return at, totals


class Block:
    """Distinct texts and the levels of their n-grams, one at a time, from the lowest order upwards."""

    def __init__(self, group: pd.DataFrame, bits: int, counted: pd.DataFrame | None = None) -> None:
        self.texts, self.bits, self.counted = _distinct(group), bits, counted
        self.hashes, self.owner = word_hashes([decompress(x).decode() for x in self.texts["text"]])
        self.level, self.places = None, None

    def climb(self, order: int) -> None:
        """The level above the present one, and the places of those of its n-grams that are sent, in order."""
        shorter, places = self.level, self.places
        level = self.level = Level(self.hashes, self.owner, self.texts["copies"].to_numpy(), order)
        if order <= 2:
            places = np.arange(len(level.every))
        else:
            places = level.within(shorter, places[_unpacked(self.counted, order - 1)[0]])
        # By slice, single ones first.
        self.places = places[np.argsort(2 * self._slices(places) + (level.often[places] > 1), kind="stable")]

    def _slices(self, places: np.ndarray) -> np.ndarray:
        return (self.level.every[places] >> np.uint64(64 - self.bits)).astype(np.int32)

    def sent(self, start: int) -> pd.DataFrame:
        """N-grams as arrays, one for each slice of the hashes, the very first numbered `start`: `ones` single ones, then others and their counts."""
        slices, every, often = self._slices(self.places), self.level.every[self.places], self.level.often[self.places]
        cuts = np.flatnonzero(np.diff(slices, prepend=-1))
        ends = np.append(cuts[1:], len(slices))
        ones = np.add.reduceat((often == 1).astype(np.int32), cuts) if len(cuts) else cuts
        lists = lambda begins, values: pd.Series([values[b:e] for b, e in zip(begins, ends, strict=False)], dtype=object)
        return pd.DataFrame(
            {"slice": slices[cuts], "start": start + cuts, "ones": ones, "grams": lists(cuts, every.view(np.int64)), "often": lists(cuts + ones, often)}
        )

    def left(self, order: int) -> np.ndarray:
        """How often the n-gram that ends at each word occurs in the other documents, from its corpus count."""
        totals = self.level.often.copy()
        at, total = _unpacked(self.counted, order)
        totals[self.places[at]] = total
        out = np.zeros(len(self.owner), np.int64)
        out[self.level.whole] = totals[self.level.of] - self.level.own
        return out


def scores(docs: DataFrame, id: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """One row per row of `docs`: (id, n_words long, log10_score double).

    N-grams have up to `order` words. Each word scores count(n-gram) / count(context), where the n-gram occurs in
    another document; else BACKOFF times its score with a shorter context, down to its share of all words of the other
    documents, or BACKOFF / (those + 1) for a word that occurs in no other document. At the start of a text shorter
    contexts cost no backoff. Null and empty texts have no words and score 0; repeated rows are different documents with
    equal words. An empty table gives no rows.

    Texts meet their copies in a block that follows from the text, after copies in a batch were combined, so that many
    copies are few rows. A block's distinct n-grams are sent as arrays, one for each slice of the hashes, shuffled once
    by slice and exploded to rows (gram, at, n) there; the counts of each n-gram, at most one a block, are added up and
    joined to these rows in place. Only n-grams that occur in other blocks, too, return to their block, as places in
    what it sent. Words and pairs are sent first, then for each longer order those n-grams of which both shorter ones
    have returned: others occur in no other block. The rows grow in proportion to the text; none depends on the order in
    which a table is read.
    """
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    digested = rows.withColumn("digest", F.md5("text"))

    def sizes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            raws = [np.frombuffer(x.encode() + b"\n", np.uint8) for x in frame["text"]]
            words = sum(int(np.count_nonzero(np.diff(_WORD[r].astype(np.int8)) == -1)) for r in raws)
            yield pd.DataFrame({"words": [words], "bytes": [sum(map(len, raws))]})

    words, size = rows.select("text").mapInPandas(sizes, "words long, bytes long").agg(F.sum("words"), F.sum("bytes")).first()
    words, size = words or 0, size or 0
    blocks, tasks = max(1, -(-size // BLOCK_BYTES)), max(1, -(-size // TASK_BYTES))
    bits = (max(SLICES, 2 * tasks) - 1).bit_length()

    def combine(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            one = _distinct(frame.assign(copies=1))
            yield one.assign(text=[compress(x.encode(), 1) for x in one["text"]])

    block = F.pmod(F.xxhash64("digest"), F.lit(blocks)).alias("block")
    combined = digested.select("digest", "text").mapInPandas(combine, "digest string, copies long, text binary")
    texts = combined.select(block, "*").groupBy("block")

    def start(group: pd.DataFrame, n: int) -> int:
        """The number of the first n-gram of a block and order."""
        return (int(group["block"].iloc[0]) * order + n - 1) << 32

    def send_lowest(group: pd.DataFrame) -> pd.DataFrame:
        one, out = Block(group, bits), []
        for n in range(1, min(order, 2) + 1):
            one.climb(n)
            out.append(one.sent(start(group, n)))
        return pd.concat(out)

    def sender(longest: int):
        def send(group: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
            one = Block(group, bits, counted)
            for n in range(2, longest + 1):
                one.climb(n)
            return one.sent(start(group, longest))

        return send

    def finish(group: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
        one, left, whole = Block(group, bits, counted), [], []
        for n in range(1, order + 1):
            one.climb(n)
            left.append(one.left(n))
            whole.append(one.level.whole)
        size, score = _score(len(one.texts), one.owner, left, whole, words)
        return pd.DataFrame({"digest": one.texts["digest"], "n_words": size, "log10_score": score})

    def returned(sent: DataFrame) -> DataFrame:
        at = sent.repartition(tasks, "slice").select("slice", "start", "ones", "often", F.posexplode("grams").alias("pos", "gram"))
        often = F.coalesce(F.get("often", F.col("pos") - F.col("ones")), F.lit(1))
        grams = at.select("slice", "gram", (F.col("start") + F.col("pos")).alias("at"), often.alias("n"))
        # Counts by n-gram, joined to the rows they were counted from in place, as a slice holds all rows of its n-grams.
        counted = grams.withColumn("total", F.sum("n").over(Window.partitionBy("gram", "slice")))
        elsewhere = counted.where(F.col("total") > F.col("n")).select("at", "total")
        packed = elsewhere.mapInPandas(lambda frames: _packed(frames, order), "block long, pack binary")
        return packed.groupBy("block").agg(F.collect_list("pack").alias("packs"))

    arrays = "slice int, start long, ones int, grams array<bigint>, often array<bigint>"
    counted = returned(texts.applyInPandas(send_lowest, arrays))
    for n in range(3, order + 1):
        # What returned is shuffled once; a block to which none of the shorter ones returned has sent no longer ones.
        longer = returned(texts.cogroup(counted.groupBy("block")).applyInPandas(sender(n), arrays)).withColumnRenamed("packs", "more")
        packs = F.concat("packs", F.coalesce("more", F.array().cast("array<binary>"))).alias("packs")
        counted = counted.join(longer.hint("merge"), "block", "left").select("block", packs)
    scored = texts.cogroup(counted.groupBy("block")).applyInPandas(finish, "digest string, n_words long, log10_score double")
    # Many rows of one text meet one row: adaptive execution splits them.
    met = digested.select(F.col("id").alias(id), "digest").join(scored.hint("merge"), "digest")
    return met.select(F.col(f"`{id}`"), "n_words", "log10_score")


def _distinct(frame: pd.DataFrame) -> pd.DataFrame:
    """(digest, copies, text), one row for each text."""
    return frame.groupby("digest", as_index=False, sort=False).agg({"copies": "sum", "text": "first"})
