"""Secret scans: fixed secret patterns, and values in credential contexts that would take too many guesses.

The guess cost of a value is the cheapest way to cut it into dictionary words, dates, repeats, keyboard walks and
brute-force spans, found by dynamic programming over its positions.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import exact, free_name, restored, schema_of, small_batches

# Kinds in the order they are listed in.
KINDS = ("assign", "access", "hex", "guess")
SPAN_TYPE = "array<struct<kind: string, begin: bigint, end: bigint, guess_log10: double>>"
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 6, 20, 24
# A credential-context value counts as a secret from this many guesses (power of ten) and characters on; a random value of
# that many characters takes as many guesses.
MIN_GUESS_LOG10, MIN_GUESS_CHARS = 8.0, 8

_ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# Runs are maximal either way; asking for the length at once skips the short ones.
_HEX = re.compile(r"[0-9a-f]{%d,}" % MIN_HEX)
_CONTEXT = re.compile(
    r"""(?i:pass(?:word|wd|phrase|code)|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?|bearer)"""
    r"""["']?[\x20\t]*(?:=>|:=|[:=])[\x20\t]*(?:"([^"\n]+)"|'([^'\n]+)'|([^\s"'<>(){}\[\],;]+))""",
    re.ASCII,
)
_CONTEXT_WORDS = (b"pass", b"pwd", b"secret", b"token", b"key", b"credential", b"bearer")

# Frequent words of passwords, the most frequent first; its rank is what a word costs.
COMMON_WORDS = (
    "password 123456 qwerty admin welcome letmein monkey dragon football baseball master login abc123 iloveyou sunshine "
    "princess shadow superman batman trustno1 hello freedom whatever secret summer winter spring autumn love test guest "
    "root user default changeme pass access money internet computer server system manager office company private public "
    "example sample demo dev prod admin123 temp temporary service account database backup oracle mysql postgres apple "
    "google amazon windows linux ubuntu orange banana cookie flower tiger eagle falcon soccer hockey hunter ranger "
    "killer jordan michael jennifer thomas robert daniel andrew charlie jessica ashley london paris berlin madrid "
    "january february march april june july august september october november december monday tuesday wednesday "
    "thursday friday saturday sunday red blue green black white silver gold star moon sun king queen happy lucky magic"
).split()
KEYBOARD_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
# Common substitutions of letters by signs.
LEET = {"4": "a", "@": "a", "8": "b", "3": "e", "1": "i", "!": "i", "0": "o", "5": "s", "$": "s", "7": "t", "+": "t"}

# Words that a dictionary may hold; it is held by the driver and every worker.
MAX_DICTIONARY = 200_000
_PLACE = {c: (y, x) for y, row in enumerate(KEYBOARD_ROWS) for x, c in enumerate(row)}
_DATES = (
    re.compile(r"(?:19|20)\d\d(?:[-/._]?)(?:0?[1-9]|1[0-2])(?:[-/._]?)(?:0?[1-9]|[12]\d|3[01])"),
    re.compile(r"(?:0?[1-9]|[12]\d|3[01])[-/._]?(?:0?[1-9]|[12]\d|3[01])[-/._]?(?:(?:19|20)\d\d|\d\d)"),
    re.compile(r"(?:19|20)\d\d"),
)
# A word of prose, with the punctuation around it, or a short number.
_PROSE = re.compile(r"""[("'\[\u201c\u2018]*(?:[^\W\d_]?[^\W\d_A-Z]*(?:['\u2019-][^\W\d_A-Z]+)*|[A-Z]{1,5}|\d{1,4})[)"'\]\u201d\u2019.,;:!?\u2026]*""")
_URL = re.compile(r"[a-z][a-z0-9+.-]*://[^\s@]*$", re.IGNORECASE)
_MIXED = re.compile(r"[A-Za-z]\d|\d[A-Za-z]")
_BRUTE_LOG10 = 1.0
_CUT_LOG10 = math.log10(2)


class Dictionary:
    """Words in lower case by their rank, from 1: how many guesses it takes to come to a word."""

    def __init__(self, ranked: Iterable[tuple[str, int]]) -> None:
        self.rank: dict[str, int] = {}
        for word, rank in ranked:
            if len(word) >= 3:
                self.rank[word.lower()] = min(max(rank, 1), self.rank.get(word.lower(), rank))
        self.longest = max(map(len, self.rank), default=0)


COMMON = Dictionary(zip(COMMON_WORDS, range(1, len(COMMON_WORDS) + 1), strict=True))


def frequent_words(docs: DataFrame, text: str = "text", size: int = 20_000) -> DataFrame:
    """(word, rank) of the `size` most frequent words of 3 to 20 letters in all texts, equal counts by word: a dictionary."""
    word = F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(r"(?<!\pL)\pL{3,20}(?!\pL)"), F.lit(0))).alias("word")
    most = docs.select(word).groupBy("word").count().orderBy(F.desc("count"), "word").limit(size)
    return most.select("word", F.row_number().over(Window.orderBy(F.desc("count"), "word")).alias("rank"))


def _known(dictionary: DataFrame | None) -> Dictionary:
    """A table (word, rank) as a dictionary; null words and ranks are left out, None is the list of COMMON_WORDS."""
    if dictionary is None:
        return COMMON
    rows = dictionary.select("word", "rank").where("word is not null and rank is not null").limit(MAX_DICTIONARY + 1).collect()
    if len(rows) > MAX_DICTIONARY:
        raise ValueError(f"a dictionary may hold {MAX_DICTIONARY} words")
    return Dictionary((r.word, r["rank"]) for r in rows)


def guess_log10(value: str, known: Dictionary = COMMON) -> float:
    """Power of ten of the guesses that the cheapest segmentation of a value takes; an empty value takes one guess."""
    n = len(value)
    starts: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for begin, end, cost in (*_words(value, known), *_dates(value), *_repeats(value), *_walks(value)):
        starts[begin].append((end, cost))
    # best: cheapest so far; brute: cheapest that ends in an open brute-force span, which pays its cut only once.
    best = [math.inf] * (n + 1)
    brute = [math.inf] * (n + 1)
    best[0] = 0.0
    for i in range(n):
        step = min(best[i] + _CUT_LOG10, brute[i]) + _BRUTE_LOG10
        if step < brute[i + 1]:
            brute[i + 1] = step
            best[i + 1] = min(best[i + 1], step)
        for end, cost in starts[i]:
            best[end] = min(best[end], best[i] + _CUT_LOG10 + cost)
    return max(0.0, best[n] - _CUT_LOG10 * (n > 0))


def _words(value: str, known: Dictionary = COMMON) -> Iterator[tuple[int, int, float]]:
    """Dictionary words in any case, also with substituted letters; capitals and substitutions multiply the guesses."""
    lower = value.lower() if len(value.lower()) == len(value) else value
    plain = "".join(LEET.get(c, c) for c in lower)
    for begin in range(len(value)):
        for end in range(begin + 3, min(len(value), begin + known.longest) + 1):
            for form in dict.fromkeys((lower[begin:end], plain[begin:end])):
                if form in known.rank:
                    capitals = sum(c.isupper() for c in value[begin:end])
                    changed = sum(a != b for a, b in zip(lower[begin:end], form, strict=True))
                    extra = min(capitals, end - begin - capitals, 2) + (capitals > 0) + changed
                    yield begin, end, math.log10(known.rank[form]) + extra * math.log10(2)


def _dates(value: str) -> Iterator[tuple[int, int, float]]:
    """Days of 200 years, four times as many with separators; years alone."""
    for pattern in _DATES:
        for begin in range(len(value)):
            if match := pattern.match(value, begin):
                days = 1 if match.end() - begin == 4 else 365 * (4 if re.search(r"\D", match[0]) else 1)
                yield begin, match.end(), math.log10(200 * days)


def _repeats(value: str) -> Iterator[tuple[int, int, float]]:
    """A unit of one to four characters, brute-forced once, times the number of its repetitions."""
    for size in range(1, 5):
        same = 0
        for i in range(size, len(value) + 1):
            if i < len(value) and value[i] == value[i - size]:
                same += 1
                continue
            if same >= max(2, size):
                yield i - size - same, i, size * _BRUTE_LOG10 + math.log10((same + size) / size)
            same = 0


def _walks(value: str) -> Iterator[tuple[int, int, float]]:
    """Three or more neighbouring keys, or a sequence of code points: guesses for the start, each turn and the length."""
    lower = [c.lower() for c in value]
    for keys in (True, False):
        begin, turns, last = 0, 0, None
        # Whether the run shares its first character with one before it, so that it counts without it, too.
        shared = 0
        for i in range(1, len(value) + 1):
            step = None
            if i < len(value):
                if keys and lower[i - 1] in _PLACE and lower[i] in _PLACE:
                    (y0, x0), (y1, x1) = _PLACE[lower[i - 1]], _PLACE[lower[i]]
                    step = (y1 - y0, x1 - x0) if max(abs(y1 - y0), abs(x1 - x0)) == 1 else None
                elif not keys and abs(ord(value[i]) - ord(value[i - 1])) == 1 and value[i].isalnum():
                    step = (0, ord(value[i]) - ord(value[i - 1]))
                    if last is not None and step != last:
                        # A sequence that turns round is two, which share the character between them.
                        for first in range(begin, begin + shared + 1):
                            if i - first >= 3:
                                yield first, i, math.log10(47 * (i - first))
                        begin, last, shared = i - 1, None, 1
            if step is None:
                for first in range(begin, begin + shared + 1):
                    if i - first >= 3:
                        yield first, i, math.log10(47 * (i - first)) + turns * math.log10(5)
                begin, turns, last, shared = i, 0, None, 0
                continue
            turns += last is not None and step != last
            last = step


def _telling(value: str) -> list[str]:
    """What could be secret of a context's value: of a URL its parts with digits among letters or of mixed case; of several
    words, half of them prose or more, those that aren't; else all of it. Phrases of plain words are taken for prose."""
    if _URL.match(value):
        return [x for x in re.split(r"[^A-Za-z0-9_]+", value) if not (x.isdigit() or x.islower() or x.isupper() or x.istitle()) or _MIXED.search(x)]
    words = value.split()
    prose = [bool(_PROSE.fullmatch(x)) for x in words]
    if len(words) > 1 and 2 * sum(prose) >= len(words):
        return [x for x, plain in zip(words, prose, strict=True) if not plain]
    return [value]


def scan(text: str | None, known: Dictionary = COMMON) -> list[tuple[str, int, int, float | None]]:
    """(kind, begin, end, guess cost) in code points, end exclusive, by begin and then kind; null and empty texts have none.

    assign, access and hex are the leftmost matches of their pattern, each kind for itself. guess is the value of a
    credential context that costs MIN_GUESS_LOG10 or more, prose and plain URLs aside, and isn't wholly inside one span of
    another kind.
    """
    if not text:
        return []
    low = text.encode().lower()
    found: list[tuple[str, int, int, float | None]] = []
    context = any(word in low for word in _CONTEXT_WORDS)
    if context:
        for m in _ASSIGN.finditer(text):
            if len(m[2]) >= MIN_ASSIGNED:
                found.append(("assign", m.start(), m.end(), guess_log10(m[2], known)))
    if b"akia" in low:
        found += [("access", m.start(), m.end(), None) for m in _ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [("hex", m.start(), m.end(), None) for m in _HEX.finditer(text)]
    if context:
        # Of the base spans that begin at or before a place, the furthest end.
        base = sorted((b, e) for _, b, e, _ in found)
        reach = list(accumulate((e for _, e in base), max))
        for m in _CONTEXT.finditer(text):
            begin, end = m.span(m.lastindex)
            before = bisect_right(base, begin, key=lambda span: span[0])
            if end - begin < MIN_GUESS_CHARS or (before and end <= reach[before - 1]):
                continue
            value = text[begin:end]
            # Sums of logarithms are off in their last digits.
            if any(round(guess_log10(x, known), 9) >= MIN_GUESS_LOG10 for x in _telling(value)):
                found.append(("guess", begin, end, guess_log10(value, known)))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def redacted(text: str | None, mark: str, known: Dictionary = COMMON) -> str | None:
    """The text with each range of touching or overlapping spans replaced by `mark`."""
    spans = scan(text, known)
    if not spans:
        return text
    out, at, until = [], 0, -1
    for _, begin, end, _ in spans:
        if begin > until:
            out += [text[at:begin], mark]
        until = max(until, end)
        at = until
    return "".join([*out, text[at:]])


def with_secrets(
    docs: DataFrame, text: str = "text", name: str = "secrets", keep: list[str] | None = None, dictionary: DataFrame | None = None
) -> DataFrame:
    """The columns `keep` (default: all but the text) and `name`, the spans found in the whole text, as SPAN_TYPE.

    Rows stay as they are, repeated ones too; null texts count as empty and have no spans. One pass, no shuffle. The
    words of a `dictionary`, a table (word, rank) of up to MAX_DICTIONARY rows, take the place of COMMON_WORDS.
    """
    known = docs.sparkSession.sparkContext.broadcast(_known(dictionary))
    kept = docs.select(*(keep if keep is not None else [c for c in docs.columns if c != text]))
    name = free_name(kept, name)
    inside = free_name(kept, "text")
    carried = exact(docs.select(*kept.columns, F.col(text).alias(inside)))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in small_batches(frames):
            out = frame.drop(columns=inside)
            out[name] = [
                [{"kind": k, "begin": b, "end": e, "guess_log10": g} for k, b, e, g in scan(x, known.value)] for x in frame[inside]
            ]
            yield out

    return restored(carried.mapInPandas(run, f"{schema_of(carried.drop(inside))}, `{name}` {SPAN_TYPE}"), kept)


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]", dictionary: DataFrame | None = None) -> DataFrame:
    """The same rows and columns with every span of a secret in `text` replaced by `mark`; null texts stay null."""
    known = docs.sparkSession.sparkContext.broadcast(_known(dictionary))

    def run(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in frames:
            yield texts.map(lambda x: redacted(x, mark, known.value))

    return docs.withColumn(text, F.pandas_udf(run, "string")(F.col(text)))
