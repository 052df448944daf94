"""Quality classifier: logistic regression on hashed word n-grams, trained with follow-the-regularised-leader updates.

Features come from whole texts only. Tokens are runs of letters and digits or runs of signs; n-grams are taken over the
tokens themselves and over their shapes (case, digits, the sign run itself, and whether a token repeats the one before).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import exact, restored, schema_of, small_batches

# The bound of the fit: this many labelled rows at most, those with the smallest hash of their id.
SAMPLE_ROWS = 6000
SHARDS = 4
EPOCHS = 4
BUCKET_BITS = 18
THRESHOLD = 0.7
# Each family of n-grams weighs as much as this many features of value 1, however long the text is.
FAMILY_WEIGHT = 8.0


@dataclass(frozen=True)
class Ftrl:
    """Step size, its offset, and the weights of the absolute and the squared penalty."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 0.005
    l2: float = 0.1


_BASE = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x100000001B3, -1, 1 << 64))
_PIECE = 1 << 18

# 0 white space and controls, 1 letters, digits and everything beyond ASCII, 2 signs.
_KIND = np.array([0 if c <= 32 or c == 127 else 1 if c >= 128 or chr(c).isalnum() else 2 for c in range(256)], np.uint8)
_UPPER = np.array([65 <= c <= 90 for c in range(256)], np.uint8)
_DIGIT = np.array([48 <= c <= 57 for c in range(256)], np.uint8)
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, _PIECE), _powers(_INVERSE, _PIECE)


def _tokens(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, shape and text number of each token of UTF-8 texts laid end to end, at most _PIECE bytes together.

    `starts` has where each text begins; texts are separated by white space.
    """
    kind = _KIND[raw]
    edge = np.flatnonzero(np.diff(kind, prepend=np.uint8(0), append=np.uint8(0)))
    begin, end = edge[:-1], edge[1:]
    token = kind[begin] > 0
    begin, end = begin[token], end[token]
    owner = np.searchsorted(starts, begin, side="right") - 1
    # Polynomial hashes of all tokens from one running sum; the inverse power takes a token's place out of its hash.
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * _UP[: len(raw)])])
    hashes = (running[end] - running[begin]) * _DOWN[begin] * _MIX
    uppers = np.concatenate([[0], np.cumsum(_UPPER[raw], dtype=np.int64)])
    digits = np.concatenate([[0], np.cumsum(_DIGIT[raw], dtype=np.int64)])
    upper, digit = uppers[end] - uppers[begin], digits[end] - digits[begin]
    shape = np.where(upper == 0, 1, np.where((upper > 1) & (2 * upper >= end - begin), 2, 3)).astype(np.uint64)
    shape[digit > 0] = 4
    shape = np.where(kind[begin] == 2, hashes >> np.uint64(40), shape)
    again = np.zeros(len(hashes), np.uint64)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    return hashes, shape + again * np.uint64(1 << 32), owner


def _families(hashes: np.ndarray, shape: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each family, the buckets of all n-grams and the number of the text each is from; no n-gram spans two texts."""
    for salt, (values, size) in enumerate(((hashes, 1), (hashes, 2), (shape, 1), (shape, 2), (shape, 3)), 1):
        count = max(0, len(values) - size + 1)
        mixed = np.full(count, salt, np.uint64)
        for i in range(size):
            mixed = (mixed ^ values[i : count + i]) * _MIX
            mixed ^= mixed >> np.uint64(29)
        whole = owner[:count] == owner[size - 1 : count + size - 1]
        buckets = (mixed * _BASE >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        yield buckets[whole], owner[:count][whole]


def features(text: str | None) -> list[np.ndarray]:
    """Buckets of all n-grams of a text by family, repeated as often as they occur; empty for a text without tokens."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    zero = np.zeros(1, np.int64)
    parts = [_tokens(piece, zero) for piece in _pieces(raw)]
    if not parts:
        return []
    return [buckets for buckets, _ in _families(*(np.concatenate(x) for x in zip(*parts, strict=True)))]


def _pieces(raw: np.ndarray) -> Iterator[np.ndarray]:
    """A text in pieces of at most _PIECE bytes, cut at white space where there is some."""
    at = 0
    while len(raw) - at > _PIECE:
        gaps = np.flatnonzero(raw[at : at + _PIECE] <= 32)
        cut = at + (int(gaps[-1]) + 1 if len(gaps) else _PIECE)
        yield raw[at:cut]
        at = cut
    if len(raw) > at:
        yield raw[at:]


def train(texts: list[str], labels: np.ndarray, penalties: Ftrl = Ftrl(), epochs: int = EPOCHS, seed: int = 7) -> np.ndarray:
    """Weights of all buckets, the last one being the intercept, after `epochs` passes in shuffled order."""
    size = (1 << BUCKET_BITS) + 1
    z, n, weights = np.zeros(size), np.zeros(size), np.zeros(size)
    examples = []
    for text in texts:
        index, value = [np.array([size - 1])], [np.ones(1)]
        for family in features(text):
            found, often = np.unique(family, return_counts=True)
            index.append(found)
            value.append(often * (FAMILY_WEIGHT / max(1, len(family))))
        index, value = np.concatenate(index), np.concatenate(value)
        found, place = np.unique(index, return_inverse=True)
        examples.append((found, np.bincount(place, value)))
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(examples)):
            index, value = examples[i]
            own = z[index]
            weight = np.where(
                np.abs(own) <= penalties.l1,
                0.0,
                -(own - np.sign(own) * penalties.l1) / ((penalties.beta + np.sqrt(n[index])) / penalties.alpha + penalties.l2),
            )
            gradient = (1 / (1 + np.exp(-np.clip(weight @ value, -35, 35))) - labels[i]) * value
            grown = n[index] + gradient * gradient
            z[index] += gradient - (np.sqrt(grown) - np.sqrt(n[index])) / penalties.alpha * weight
            n[index] = grown
    kept = np.abs(z) > penalties.l1
    weights[kept] = -(z[kept] - np.sign(z[kept]) * penalties.l1) / (
        (penalties.beta + np.sqrt(n[kept])) / penalties.alpha + penalties.l2
    )
    return weights


def scores(texts: list[str | None], weights: np.ndarray) -> np.ndarray:
    """Probabilities of label 1: sparse dot products of the whole texts' features with the weights.

    Texts are laid end to end up to _PIECE bytes and scored together; a text's sums don't depend on its neighbours.
    """
    raws = [(x or "").encode() for x in texts]
    out = np.full(len(raws), float(weights[-1]))
    block: list[int] = []
    size = 0
    for n, raw in enumerate(raws):
        if len(raw) >= _PIECE:
            for family in features(texts[n]):
                out[n] += FAMILY_WEIGHT * float(weights[family].mean(dtype=np.float64)) if len(family) else 0.0
            continue
        if size + len(raw) + 1 > _PIECE:
            _score_block(raws, block, weights, out)
            block, size = [], 0
        block.append(n)
        size += len(raw) + 1
    _score_block(raws, block, weights, out)
    return 1 / (1 + np.exp(-np.clip(out, -35, 35)))


def _score_block(raws: list[bytes], block: list[int], weights: np.ndarray, out: np.ndarray) -> None:
    if not block:
        return
    starts = np.concatenate([[0], np.cumsum([len(raws[n]) + 1 for n in block[:-1]], dtype=np.int64)])
    raw = np.frombuffer(b"\n".join(raws[n] for n in block), np.uint8)
    for buckets, owner in _families(*_tokens(raw, starts)):
        total = np.bincount(owner, weights[buckets], len(block))
        often = np.bincount(owner, minlength=len(block))
        out[block] += FAMILY_WEIGHT * total / np.maximum(often, 1)


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality") -> np.ndarray:
    """Weights learned from the labelled rows of `labels`, joined to their texts.

    At most SAMPLE_ROWS rows are used: those with the smallest hash of their id, so the choice doesn't depend on order
    or partitions; of several texts with one id the one with the smallest hash. Rows with a null id or label, or a label other than 0 and 1, are left out. SHARDS models are trained
    side by side on a share each and averaged. Without labelled rows all weights are 0 and every score is one half.
    """
    chosen = (
        labels.where(F.col(id).isNotNull() & F.col(label).isin(0, 1))
        .select(F.col(id).alias("id"), F.col(label).cast("int").alias("y"))
        .distinct()
        .orderBy(F.xxhash64("id"), "id", "y")
        .limit(SAMPLE_ROWS)
    )
    # The sample is bounded by its limit, so it may be broadcast. Texts go from the scan to their shard, never to one task.
    rows = (
        docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
        .join(F.broadcast(chosen), "id")
        .groupBy("id", "y")
        .agg(F.min_by("text", F.xxhash64("text")).alias("text"))
        .withColumn("shard", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(SHARDS)))
    )

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["id", "y"], kind="stable")
        own = train(list(group["text"]), group["y"].to_numpy(float))
        return pd.DataFrame({"rows": [len(group)], "weights": [own.astype("<f4").tobytes()]})

    models = rows.groupBy("shard").applyInPandas(run, "rows long, weights binary").collect()
    weights = np.zeros((1 << BUCKET_BITS) + 1)
    for rows_used, own in models:
        weights += np.frombuffer(own, "<f4") * (rows_used / sum(r for r, _ in models))
    return weights.astype(np.float32)


def with_scores(docs: DataFrame, weights: np.ndarray, name: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (default: all) and `name`, the score from 0 to 1 of each whole text.

    Null and empty texts get the score of the intercept alone. Rows and their number stay, repeated ones too.
    """
    keep = docs.columns if keep is None else keep
    carried = exact(docs.select(*dict.fromkeys([*keep, text])))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_batches(frames):
            out = frame[keep].copy()
            out[name] = scores(list(frame[text]), weights)
            yield out

    scored = carried.mapInPandas(run, f"{schema_of(carried.select(*keep))}, `{name}` double")
    return restored(scored, docs.select(*keep))


def score_of(text: Column, weights: np.ndarray) -> Column:
    """The score of a text column as an expression, for filters that leave the rows where they are."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(scores(list(texts), weights))

    return F.pandas_udf(run, "double")(text)


def is_held_out(id: str = "doc_id") -> Column:
    """Rows whose labels are never learned."""
    return F.coalesce(F.pmod(F.crc32(F.col(id).cast("string")), F.lit(4)) == 2, F.lit(False))
