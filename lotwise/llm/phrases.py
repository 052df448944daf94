"""Phrase collocation mining: counts of phrases by multikey three-way quicksort of suffixes, scored by their weakest cut."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import stored

MIN_WORDS, MAX_WORDS = 2, 3
MIN_COUNT = 10
# A candidate goes if a longer one around it has at least this percentage of its occurrences.
INSIDE_PERCENT = 50
SCALE = 1_000_000
TOP = 2000
# Parts in which a language's phrases are put in order before the best of each meet.
BEST_PARTS = 256
# Text whose suffixes a task combines before it sends them.
CHUNK_CHARS = 8 << 20
# Suffixes that one task sorts, on average. Leading words with more than HOT_SUFFIXES are dealt in up to HOT_PARTS parts
# by their second word, and such a part that still has more by all words.
TASK_SUFFIXES = 1 << 19
HOT_SUFFIXES = 1 << 19
HOT_PARTS = 64

# Numbers that can hold all words of a suffix are below.
KEYS = 1 << 62

# What picks the task of suffixes: their leading word, a part of its second words, or all words.
HEAD, SECOND, ALL = 1, 2, 3

_BREAK = b"\xff"
_LETTERS = {c: c + 32 for c in range(65, 91)}
_TABLE = bytes(0xFF if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else _LETTERS.get(c, c) for c in range(256))
_PIECE_END = re.compile(r"[.,;:!?\n\x0b\x0c\r]")


def _word_numbers(texts: list[str | None]) -> tuple[np.ndarray, pa.Array]:
    """All words of the texts as numbers, -1 after each piece, and the words by number."""
    data = np.frombuffer(_BREAK.join((t or "").encode().translate(_TABLE) for t in texts) + _BREAK, np.uint8)
    breaks = data == _BREAK[0]
    inside = ~breaks & (data != 32)
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    begins = edges[::2]
    ends = np.cumsum(edges[1::2] - begins)
    words = pa.Array.from_buffers(pa.large_string(), len(begins), [None, pa.py_buffer(np.append(0, ends).astype(np.int64)), pa.py_buffer(data[inside])])
    codes, names = _coded(words)
    piece = np.cumsum(breaks)
    numbers = np.full(len(begins) + piece[-1], -1)
    numbers[np.arange(len(begins)) + piece[begins]] = codes
    return numbers, names.cast(pa.string())


def suffixes(texts: list[str | None], words: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The distinct suffixes of all pieces, cut to `words` words, in order: their words' numbers (-1 beyond the end), how
    often each occurs, and the words by number."""
    numbers, names = _word_numbers(texts)
    begins = np.flatnonzero(numbers >= 0)
    base = len(names) + 1
    # Distinct suffixes to depth d are distinct pairs of one to depth d - 1 and a word.
    classes = numbers[begins]
    ended = np.zeros(len(begins), bool)
    short = base**words < KEYS
    for depth in range(1, words):
        following = numbers[np.minimum(begins + depth, len(numbers) - 1)]
        ended |= following < 0
        classes = classes * base + np.where(ended, 0, following + 1)
        if not short:
            _, classes = np.unique(classes, return_inverse=True)
    if short:
        # One number holds all words of a suffix, so it needs no pointer.
        classes.sort()
        first = np.flatnonzero(np.diff(classes, prepend=-1))
        often = np.diff(np.append(first, len(classes)))
        rest = classes[first]
        columns = []
        for _ in range(1, words):
            rest, word = np.divmod(rest, base)
            columns.append(word - 1)
        return np.stack([rest, *columns[::-1]]), often, names
    _, first, often = np.unique(classes, return_index=True, return_counts=True)
    columns = []
    ended = np.zeros(len(first), bool)
    for depth in range(words):
        word = numbers[np.minimum(begins[first] + depth, len(numbers) - 1)]
        ended |= word < 0
        columns.append(np.where(ended, -1, word))
    return np.stack(columns), often, names


def sorted_runs(keys: np.ndarray, weights: np.ndarray, least: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort of pointers to suffixes, to the maximum depth: (depth, pointer, size) of equal partitions.

    `keys` has a row for each depth and a column for each suffix, a negative key being the end of a suffix. Suffixes
    start in a partition for each first key. Each partition is split around a pivot at its depth into smaller, equal and
    greater suffixes; an equal partition's weight is the count of its prefix, and it goes on at the next depth.
    Partitions of less weight than `least` of their depth are abandoned. All partitions of the same round are split at
    once.
    """
    pointers = np.argsort(keys[0], kind="stable")
    values = keys[0][pointers]
    begins = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    size = np.diff(np.append(begins, len(pointers)))
    total = np.add.reduceat(weights[pointers], begins) if len(begins) else np.zeros(0, np.int64)
    found = (values[begins] >= 0) & (total >= least[0])
    if found.any():
        yield 1, pointers[begins[found]], total[found]
    pointers = pointers[np.repeat(found, size)] if len(keys) > 1 else pointers[:0]
    weights = weights.astype(np.float64)
    flat = keys.ravel()
    size = size[found]
    depth = np.ones(len(size), np.int64)
    while len(pointers):
        parts = len(size)
        begins = np.cumsum(size) - size
        of = np.repeat(np.arange(parts), size)
        values = flat.take(pointers + np.repeat(depth * keys.shape[1], size))
        sample = [values[begins], values[begins + size // 2], values[begins + size - 1]]
        pivot = np.maximum(np.minimum(sample[0], sample[1]), np.minimum(np.maximum(sample[0], sample[1]), sample[2]))
        beside = np.repeat(pivot, size)
        side = (values >= beside).view(np.int8) + (values > beside).view(np.int8)
        new = 3 * of + side
        total = np.bincount(new, weights.take(pointers), 3 * parts).astype(np.int64)
        equal = slice(1, None, 3)
        kept = total >= np.repeat(least[depth], 3)
        kept[equal] &= pivot >= 0
        found = kept[equal]
        some = np.zeros(parts, np.int64)
        same = np.flatnonzero(side == 1)
        some[of.take(same)] = pointers.take(same)
        for d in range(1, len(keys)):
            at = found & (depth == d)
            if at.any():
                yield d + 1, some[at], total[equal][at]
        depth = np.repeat(depth, 3)
        depth[equal] += 1
        kept &= depth < len(keys)
        stay = np.flatnonzero(kept.take(new))
        pointers, of, side, new = pointers.take(stay), of.take(stay), side.take(stay), new.take(stay)
        # Pointers stand by partition, so those of one side go to their places in order.
        count = np.bincount(new, minlength=3 * parts)
        place = np.cumsum(count) - count
        moved = np.empty_like(pointers)
        for s in range(3):
            own = np.flatnonzero(side == s)
            before = np.cumsum(count[s::3]) - count[s::3]
            moved[np.arange(len(own)) + (place[s::3] - before).take(of.take(own))] = pointers.take(own)
        pointers, size, depth = moved, count[count > 0], depth[count > 0]


def phrase_counts(docs: DataFrame, lang: str = "lang", text: str = "text", words: int = MAX_WORDS, least: int = MIN_COUNT) -> DataFrame:
    """(lang, words long, phrase string, f long): the phrases of up to `words` words that occur at least `least` times in
    their language, with all their occurrences; and for each language all its words, as an empty phrase of 0 words.

    Pieces of text send their suffixes, cut to `words` words, added up and put together by leading word, to the task of
    their leading word. Leading words with more than HOT_SUFFIXES of them are dealt in parts by their second word, and
    parts with more by all words; counts of what is spread over tasks are added up after. The suffixes are written to the shared folder
    before they are dealt, so lost executors repeat one step only. Those of one leading word are one string there, the
    words after it with their count where it isn't 1, for strings cost Spark less than arrays of strings and counts.
    """
    rows = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for code, texts in _chunks(batches):
            numbers, often, names = suffixes(texts, words)
            known = pa.concat_arrays([names, pa.nulls(1, pa.string())])
            heads = np.flatnonzero(np.diff(numbers[0], prepend=-1))
            for begin in range(0, len(heads), 1 << 14):
                head = heads[begin : begin + (1 << 14)]
                end = heads[begin + (1 << 14)] if begin + (1 << 14) < len(heads) else len(often)
                size = np.diff(np.append(head, end))
                after = [known.take(pa.array(n[head[0] : end] % len(known))) for n in numbers[1:]]
                more = [pc.fill_null(pc.binary_join_element_wise("", w, " "), "") for w in after[1:]]
                tails = pc.binary_join_element_wise(pc.fill_null(after[0], ""), *more, _counts(often[head[0] : end]), "")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([code] * len(head), pa.string()), known.take(pa.array(numbers[0][head])), _joined(tails, size), pa.array(size)],
                    ["lang", "head", "tails", "many"],
                )

    sent = stored(rows.mapInArrow(send, "lang string, head string, tails string, many long"), "suffixes", compression="zstd")
    every = sent.agg(F.sum("many")).first()[0] or 0
    tasks = max(sent.sparkSession.sparkContext.defaultParallelism, -(-every // TASK_SUFFIXES))
    routed = _dealt(sent, tasks).repartition(tasks, "lang", "head", "lead")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        table = pa.Table.from_batches(parts) if parts else None
        for deal in (HEAD, SECOND, ALL) if parts else ():
            part = table.filter(pc.equal(table["deal"], deal)).combine_chunks()
            if not part.num_rows:
                continue
            languages, lang_names = _coded(part["lang"])
            heads, head_names = _coded(part["head"])
            owner, tails = _split(part["tails"])
            tails, weights = _weighed(tails)
            total = np.bincount(languages[owner], weights, len(lang_names)).astype(np.int64)
            yield _found(lang_names, 0, pa.array([""] * len(lang_names), pa.string()), total)
            # Of shorter phrases this task has a part only, so none of them is abandoned here.
            together = {HEAD: 1, SECOND: 2, ALL: words}[deal]
            lowest = np.array([least if depth >= together else 1 for depth in range(1, words + 1)])
            leading = languages * len(head_names) + heads
            # Words after abandoned leading words need not be told apart.
            enough = np.bincount(leading[owner], weights, len(lang_names) * len(head_names)) >= lowest[0]
            used = enough[leading[owner]]
            owner, tails, weights = owner[used], tails.filter(pa.array(used)), weights[used]
            apart = _whole(pc.split_pattern(tails, " "))
            begin, size = apart.offsets.to_numpy()[:-1], pc.list_value_length(apart).to_numpy()
            following, tail_names = _coded(apart.values)
            following[tail_names.index("").as_py() == following] = -1
            following = np.append(following, -1)
            later = [np.where(size > d, following[np.minimum(begin + d, len(following) - 1)], -1) for d in range(words - 1)]
            keys = np.stack([leading[owner], *later])
            runs: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
            for depth, at, size in sorted_runs(keys, weights, lowest):
                runs.setdefault(depth, []).append((at, size))
            for depth, found in runs.items():
                at, size = (np.concatenate(x) for x in zip(*found, strict=True))
                code, head = np.divmod(keys[0][at], len(head_names))
                spoken = [head_names.take(pa.array(head)), *[tail_names.take(pa.array(keys[d][at])) for d in range(1, depth)]]
                yield _found(lang_names.take(pa.array(code)), depth, pc.binary_join_element_wise(*spoken, " "), size)

    counted = routed.mapInArrow(count, "lang string, words long, phrase string, f long")
    return counted.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f")).where((F.col("words") == 0) | (F.col("f") >= least))


def _dealt(sent: DataFrame, tasks: int) -> DataFrame:
    """The suffixes (lang, head, tails) with `deal`, what picks their task, and `lead`, what picks it beside the leading word.

    At most one in HOT_SUFFIXES suffixes' leading words are hot, so their lists are short; they are stored, for all
    tasks must deal alike. Chunks with few suffixes of a leading word don't count for its size: they can't add more to
    a task than a fraction of what it sorts anyway. Strings of hot leading words are cut in Python, each suffix looked
    at once however many parts there are.
    """
    as_is = lambda frame, deal, lead: frame.select("lang", "head", "tails", F.lit(deal).alias("deal"), lead.alias("lead"))
    none = F.lit(None).cast("long")
    some = F.col("many") * 4 * tasks > HOT_SUFFIXES
    sizes = sent.where(some).groupBy("lang", "head").agg(F.sum("many").alias("size")).where(F.col("size") > HOT_SUFFIXES)
    parts = F.ceil(2 * F.col("size") / HOT_SUFFIXES).cast("long")
    hot = stored(sizes.select("lang", "head", F.least(F.lit(HOT_PARTS), parts).cast("long").alias("parts")), "hot")
    if hot.isEmpty():
        return as_is(sent, HEAD, none)
    marked = sent.join(hot, ["lang", "head"], "left")
    whole = as_is(marked.where("parts is null"), HEAD, none)
    spread = stored(_cut(marked.where("parts is not null").withColumn("lead", F.lit(0).cast("long")), SECOND), "spread", compression="zstd")
    sizes = spread.groupBy("lang", "head", "lead").agg(F.sum("many").alias("size")).where(F.col("size") > HOT_SUFFIXES)
    hotter = stored(sizes.select("lang", "head", "lead", parts.alias("parts")), "hotter")
    if hotter.isEmpty():
        return whole.unionByName(as_is(spread, SECOND, F.col("lead")))
    marked = spread.join(hotter, ["lang", "head", "lead"], "left")
    single = _cut(marked.where("parts is not null"), ALL)
    return whole.unionByName(as_is(marked.where("parts is null"), SECOND, F.col("lead"))).unionByName(as_is(single, ALL, F.col("lead")))


def _cut(rows: DataFrame, deal: int) -> DataFrame:
    """(lang, head, lead, tails, many) of rows with `parts`: each row's suffixes in so many parts at most, by the hash of
    their second word or of all words. `lead` is the part, the earlier lead before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            owner, tails = _split(batch["tails"])
            by = _firsts(tails, "\t")
            codes, names = _coded(_firsts(by, " ") if deal == SECOND else by)
            hashes = np.array([xxhash.xxh64_intdigest(x) >> 1 for x in names.cast(pa.binary()).to_pylist()], np.int64)
            parts = batch["parts"].to_numpy()
            part = hashes[codes] % parts[owner]
            order = np.lexsort((part, owner))
            owner, part = owner[order], part[order]
            first = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(part, prepend=-1) != 0))
            size = np.diff(np.append(first, len(owner)))
            row = pa.array(owner[first])
            lead = batch["lead"].to_numpy()[owner[first]] * (1 if deal == SECOND else parts[owner[first]]) + part[first]
            yield pa.RecordBatch.from_arrays(
                [batch["lang"].take(row), batch["head"].take(row), pa.array(lead), _joined(tails.take(pa.array(order)), size), pa.array(size)],
                ["lang", "head", "lead", "tails", "many"],
            )

    given = rows.select("lang", "head", "lead", "tails", "parts")
    return given.mapInArrow(run, "lang string, head string, lead long, tails string, many long")


def _counts(often: np.ndarray) -> pa.Array:
    """What is written behind suffixes that occur so often: a tab, which no word has, and the count if it isn't 1."""
    several = often != 1
    different, at = np.unique(often[several], return_inverse=True)
    place = np.zeros(len(often), np.int64)
    place[several] = at + 1
    return pa.array(["", *[f"\t{n}" for n in different.tolist()]], pa.string()).take(pa.array(place))


def _weighed(tails: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Suffixes without their counts, and the counts."""
    weights = np.ones(len(tails), np.int64)
    several = pc.match_substring(tails, "\t")
    places = np.flatnonzero(several.to_numpy(zero_copy_only=False))
    if len(places):
        both = pc.split_pattern(tails.filter(several), "\t").values
        weights[places] = both.take(pa.array(np.arange(1, 2 * len(places), 2))).cast(pa.int64()).to_numpy()
        tails = pc.replace_with_mask(tails, several, both.take(pa.array(np.arange(0, 2 * len(places), 2))))
    return tails, weights


def _joined(tails: pa.Array, size: np.ndarray) -> pa.Array:
    """One string for each run of so many strings, with line breaks, which no word has, between them."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), tails), "\n")


def _split(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The strings that were put together, each with the number of its row."""
    lists = _whole(pc.split_pattern(_whole(column), "\n"))
    return np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy()), lists.flatten()


def _firsts(strings: pa.Array, mark: str) -> pa.Array:
    """What stands before the first mark."""
    return pc.list_element(pc.split_pattern(strings, mark, max_splits=1), 0)


def _found(codes: pa.Array, words: int, phrases: pa.Array, f: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([codes, pa.array(np.full(len(f), words)), phrases, pa.array(f)], ["lang", "words", "phrase", "f"])


def _whole(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _coded(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Numbers of the strings, -1 for nulls, and the strings by number."""
    coded = _whole(column).dictionary_encode()
    return coded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    """Texts by language, some CHUNK_CHARS at a time. A longer text is cut at the end of a piece."""
    waiting: dict[str, list[str]] = {}
    size = 0
    for batch in batches:
        for code, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            begin = 0
            while text and begin < len(text):
                end = _PIECE_END.search(text, begin + CHUNK_CHARS) if len(text) - begin > CHUNK_CHARS else None
                part = text[begin : end.end()] if end else text[begin:]
                begin += len(part)
                waiting.setdefault(code, []).append(part)
                size += len(part)
                if size >= CHUNK_CHARS:
                    yield from waiting.items()
                    waiting, size = {}, 0
    yield from waiting.items()


def _cuts(words: int) -> list[tuple[int, Column, Column]]:
    """(k, first k words, rest) of a phrase, for every cut of a phrase of up to `words` words."""
    return [(k, F.substring_index("phrase", " ", k), F.expr(f"substr(phrase, char_length(substring_index(phrase, ' ', {k})) + 2)")) for k in range(1, words)]


def collocations(
    docs: DataFrame, lang: str = "lang", text: str = "text", words: int = MAX_WORDS, least: int = MIN_COUNT,
    inside_percent: int = INSIDE_PERCENT, top: int = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of each language by score, count and text.

    Texts, A-Z lower-cased, are split at `. , ; : ! ?` and line breaks into pieces, and those into words at spaces and
    tabs. Phrases of 2 to `words` words with a = f(phrase) >= `least` are candidates. A cut after k words gives
    l = f(first part), r = f(rest) and floor(1000000 a a / (l r)); the cut with the lowest score counts, the smallest k
    of equal ones. Candidates inside a longer one with at least `inside_percent` of their count go. n counts all words
    of the language. Products are decimals of 38 digits, exact for counts up to 10^15.

    Null texts are empty, a null language is `und`, repeated rows count each, other columns don't matter, an empty
    table gives no rows.
    """
    counts = stored(phrase_counts(docs, lang, text, words, least), "phrases")
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    frequent = counts.where("words > 0")
    candidate = frequent.where(F.col("words") >= MIN_WORDS)
    split = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), x.alias("first"), y.alias("rest")) for k, x, y in _cuts(words)]))
    cuts = candidate.select("lang", "words", "phrase", F.col("f").alias("a"), split.alias("cut")).where("cut.k < words")
    of = frequent.select(F.col("lang").alias("of_lang"), F.col("phrase").alias("part"), "f")
    left = of.toDF("left_lang", "left", "l")
    right = of.toDF("right_lang", "right", "r")
    exact_ = lambda c: F.col(c).cast("decimal(16,0)")
    scored = (
        cuts.select("lang", "phrase", "a", "cut.k", "cut.first", "cut.rest")
        .join(left, (F.col("lang") == F.col("left_lang")) & (F.col("first") == F.col("left")))
        .join(right, (F.col("lang") == F.col("right_lang")) & (F.col("rest") == F.col("right")))
        .withColumn("top", exact_("a") * exact_("a") * F.lit(SCALE).cast("decimal(7,0)"))
        .withColumn("score", F.expr("top div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))"))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("weakest"))
        .select("lang", "phrase", "a", "weakest.score", "weakest.l", "weakest.r")
    )
    spans = [(begin, size) for size in range(MIN_WORDS, words) for begin in range(words - size + 1)]
    apart = F.split("phrase", " ")
    part = [F.when(F.col("words") >= max(size + 1, begin + size), F.array_join(F.slice(apart, begin + 1, size), " ")) for begin, size in spans]
    within = (
        candidate.select("lang", F.col("f").alias("longer"), F.explode(F.array(*part, F.lit(None).cast("string"))).alias("phrase"))
        .where("phrase is not null")
        .groupBy("lang", "phrase")
        .agg(F.max("longer").alias("longer"))
    )
    alone = scored.join(within, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("longer") < inside_percent * F.col("a"), F.lit(True)))
    # What isn't among the best of its part isn't among the best of its language, whose task gets the best of all parts only.
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    parted = alone.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(BEST_PARTS)))
    near = parted.withColumn("near", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("near") <= top)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
