"""Fill-in-the-middle transformation: texts are cut at two unit boundaries, which a wavelet matrix over character classes locates."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import exact, restored, schema_of, small_batches

OTHER, NEWLINE, STOP, BLANK = range(4)
CLASS_BITS = 2
# The characters that end a unit, by class. What follows the last of them is a unit, too.
UNITS = {"line": (NEWLINE,), "sentence": (NEWLINE, STOP), "word": (NEWLINE, BLANK)}
MARKERS = ("<P>", "<S>", "<M>")
# Characters of whole texts that one matrix is built over; a longer text has one of its own.
MATRIX_CHARS = 1 << 22

_CLASS = np.zeros(128, np.uint8)
_CLASS[ord("\n")] = NEWLINE
_CLASS[[ord(c) for c in ".!?"]] = STOP
_CLASS[[ord(c) for c in " \t"]] = BLANK


def classes_of(text: str) -> np.ndarray:
    """Class of every code point."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.where(points < 128, _CLASS[np.minimum(points, 127)], np.uint8(OTHER))


class Bits:
    """A bit vector with rank and select: 64-bit words and the ones before each of them."""

    def __init__(self, bits: np.ndarray) -> None:
        self.words = np.packbits(np.pad(bits, (0, 64 - len(bits) % 64)), bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.ones = int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below).astype(np.int64)

    def select(self, bit: int, number: np.ndarray) -> np.ndarray:
        """Place of the one (or zero) with each number, counted from 0."""
        before = self.before if bit else (np.arange(len(self.before), dtype=np.int64) << 6) - self.before
        word = np.searchsorted(before, number, side="right") - 1
        inside = self.words[word] if bit else ~self.words[word]
        upto = np.cumsum(np.unpackbits(inside.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"), axis=1, dtype=np.int64)
        return (word << 6) + (upto <= (number - before[word])[:, None]).sum(1)


class WaveletMatrix:
    """Rank and select of each class in a sequence of classes: one bit vector a bit, zeros sorted before ones each time."""

    def __init__(self, codes: np.ndarray, bits: int = CLASS_BITS) -> None:
        self.size = len(codes)
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in range(bits - 1, -1, -1):
            ones = (codes >> shift & 1).astype(bool)
            zeros = int(len(codes) - ones.sum())
            self.levels.append((shift, Bits(ones), zeros))
            codes = np.concatenate([codes[~ones], codes[ones]])

    def rank(self, code: int, at: np.ndarray) -> np.ndarray:
        """Occurrences of a class before each place."""
        low, high = np.zeros(1, np.int64), at
        for shift, bits, zeros in self.levels:
            if code >> shift & 1:
                low, high = zeros + bits.rank(low), zeros + bits.rank(high)
            else:
                low, high = low - bits.rank(low), high - bits.rank(high)
        return high - low

    def select(self, code: int, number: np.ndarray) -> np.ndarray:
        """Place of the occurrence of a class with each number, counted from 0."""
        low = np.zeros(1, np.int64)
        for shift, bits, zeros in self.levels:
            low = zeros + bits.rank(low) if code >> shift & 1 else low - bits.rank(low)
        place = low + number
        for shift, bits, zeros in reversed(self.levels):
            place = bits.select(1, place - zeros) if code >> shift & 1 else bits.select(0, place)
        return place


class Boundaries:
    """The ends of units in a sequence: their count before a place, and the place of each."""

    def __init__(self, codes: np.ndarray, ends: tuple[int, ...]) -> None:
        self.matrix, self.ends = WaveletMatrix(codes), ends

    def before(self, at: np.ndarray) -> np.ndarray:
        return sum(self.matrix.rank(code, at) for code in self.ends)

    def locate(self, number: np.ndarray) -> np.ndarray:
        """Place of the end with each number, counted from 0: by select, or by bisection on ranks where classes combine."""
        if len(self.ends) == 1:
            return self.matrix.select(self.ends[0], number)
        low, high = np.zeros(len(number), np.int64), np.full(len(number), self.matrix.size, np.int64)
        while (low < high).any():
            middle = (low + high) >> 1
            enough = self.before(np.minimum(middle + 1, self.matrix.size)) > number
            low, high = np.where(enough | (low >= high), low, middle + 1), np.where(enough, middle, high)
        return low


def draws(id: object, seed: int) -> tuple[int, int, int, int]:
    """Four numbers below 2 ** 32 that follow from the seed and a row's id; a null id is an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if pd.isna(id) else id}".encode()).digest()
    return tuple(int.from_bytes(digest[4 * n : 4 * n + 4], "big") for n in range(4))  # type: ignore[return-value]


def cut(texts: list[str], numbers: list[tuple[int, int, int, int]], unit: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text, and the two places at which it is cut."""
    size = np.array([len(t) for t in texts], np.int64)
    end = np.cumsum(size)
    begin = end - size
    codes = classes_of("".join(texts))
    bounds = Boundaries(codes, UNITS[unit])
    first = bounds.before(begin)
    closed = bounds.before(end) - first
    last = codes[np.maximum(end - 1, 0)] if len(codes) else np.zeros(len(texts), np.uint8)
    units = closed + ((size > 0) & ~np.isin(last, UNITS[unit]))
    picked = np.sort(np.array([x[:2] for x in numbers], np.int64).reshape(-1, 2) % (units + 1)[:, None], axis=1)
    places = []
    for k in picked.T:
        at = np.where(k > closed, size, 0)
        inner = (k > 0) & (k <= closed)
        at[inner] = bounds.locate((first + k - 1)[inner]) + 1 - begin[inner]
        places.append(at)
    return units, places[0], places[1]


def transform(
    docs: DataFrame, id: str = "doc_id", text: str = "text", unit: str = "line", seed: int = 7,
    rate: int = 100, suffix_first: int = 50, markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """One row per row of `docs`: (id, n long, form string, prefix_chars long, middle_chars long, output string).

    `n` counts the text's units (UNITS). Two numbers that follow from seed and id choose the units before which and
    after which the middle lies; a third whether the text stays plain (`rate` is the percentage that doesn't), a fourth
    whether the suffix comes first (`suffix_first`, a percentage). Empty texts and texts that hold a marker stay plain.
    Forms: `plain`, the text; `psm`, prefix, suffix, middle; `spm`, suffix, prefix, middle, each behind its marker
    (of prefix, suffix, middle). prefix_chars and middle_chars count code points and are null for plain ones.

    Null texts are empty, a null id draws like an empty one, repeated rows have equal results, other columns don't
    matter, an empty table gives no rows. One pass without a shuffle; a worker holds one matrix over whole texts.
    """
    if len(set(markers)) < 3 or any(len(m) < 2 or m[0] in m[1:] or m[-1] in m[:-1] or m[0] != markers[0][0] or m[-1] != markers[0][-1] for m in markers):
        raise ValueError("markers must share a first and a last character, which come nowhere else in them")
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    carried = exact(rows)
    before, after, between = markers

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _by_chars(small_batches(frames)):
            texts = list(frame["text"])
            numbers = [draws(i, seed) for i in frame["id"]]
            units, left, right = cut(texts, numbers, unit)
            forms, outputs = [], []
            for t, (_, _, h3, h4), p, q in zip(texts, numbers, left.tolist(), right.tolist(), strict=True):
                if not t or any(m in t for m in markers) or h3 % 100 >= rate:
                    forms.append("plain")
                    outputs.append(t)
                elif h4 % 100 < suffix_first:
                    forms.append("spm")
                    outputs.append(f"{after}{t[q:]}{before}{t[:p]}{between}{t[p:q]}")
                else:
                    forms.append("psm")
                    outputs.append(f"{before}{t[:p]}{after}{t[q:]}{between}{t[p:q]}")
            plain = np.array([f == "plain" for f in forms], bool)
            plain = np.array([f == "plain" for f in forms], bool)
            yield pd.DataFrame(
                {
                    "id": frame["id"].array,
                    "n": units,
                    "form": forms,
                    "prefix_chars": pd.arrays.IntegerArray(left, plain),
                    "middle_chars": pd.arrays.IntegerArray(right - left, plain.copy()),
                    "output": outputs,
                }
            )

    schema = f"{schema_of(carried.select('id'))}, n long, form string, prefix_chars long, middle_chars long, output string"
    return restored(carried.mapInPandas(run, schema), rows.select("id")).withColumnRenamed("id", id)


def _by_chars(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches cut where their texts reach the size of a matrix."""
    for frame in frames:
        piece = (frame["text"].str.len().cumsum() // MATRIX_CHARS).to_numpy()
        for n in np.unique(piece):
            yield frame[piece == n]


def restored_text(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that `transform` made an output of that form from. No part of it holds a marker, so each is found once."""
    before, after, between = markers

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        rest = F.substring(output, len(first) + 1, 2**31 - 1)
        behind = F.substring_index(rest, second, -1)
        return F.substring_index(rest, second, 1), F.substring_index(behind, between, 1), F.substring_index(behind, between, -1)

    prefix, suffix, middle = parts(before, after)
    suffix_, prefix_, middle_ = parts(after, before)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix)).when(form == "spm", F.concat(prefix_, middle_, suffix_)).otherwise(output)
    )
