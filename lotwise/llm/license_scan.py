"""License scans in DataFrame functions: MinHash bands over overlapping windows retrieve templates, shingles verify them."""

from __future__ import annotations

import re
from collections.abc import Callable

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm.license_texts import TEMPLATES

SHINGLE_WORDS = 5
MIN_CONTAINMENT = 0.8
# A window is as long as a template; windows that are retrieved move by this part of their length.
STEPS_PER_WINDOW = 8
# A copy with words put in may reach over a stretch longer than the template by this part of its length.
STRETCH_PART = 2
# Templates whose bands may be broadcast; more meet the windows by a shuffle, unless Spark finds them small enough.
BROADCAST_TEMPLATES = 1000
# Where a stretch holds 0.8 of a template's shingles, a window on the grid inside it holds half of them, 0.4, and has a Jaccard
# similarity of at least 0.4 / 1.6; all BANDS miss it with probability (1 - 0.25 ** BAND_ROWS) ** BANDS, one in a million.
BANDS, BAND_ROWS = 48, 1

# Words too common to tell license texts from others; a run of words has one as its anchor only if it
# has no other word.
COMMON_WORDS = frozenset("a all an and any are as at be by for from if in is it may not of on or that the this to was with you".split())

_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Lower-case runs of letters, digits and characters beyond ASCII. Null has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _GAPS), lambda w: w != "")


def shingles_of(words: Column) -> Column:
    """Distinct hashes of all runs of SHINGLE_WORDS words; of fewer words, all together; none for no words."""
    last = F.greatest(F.size(words) - (SHINGLE_WORDS - 1), F.lit(1))
    runs = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.array_join(F.slice(words, i, SHINGLE_WORDS), " ")))
    return F.when(F.size(words) > 0, F.array_distinct(runs)).otherwise(F.array().cast("array<bigint>"))


def bands_of(shingles: Column) -> Column:
    """One key for each band: a hash of BAND_ROWS minima of the shingles under hash functions of its own."""
    least = lambda seed: F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, seed)))
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda band: F.xxhash64(band, *[least(band * BAND_ROWS + row) for row in range(BAND_ROWS)]),
    )


def _plain_words(text: str) -> list[str]:
    return [w for w in re.split(_GAPS, text.lower()) if w]


def anchors_of(templates: dict[str, str]) -> list[str]:
    """Words of which every shingle of every template has at least one: the longest uncommon word of those that had none yet.

    A text without any of them shares no shingle with any template.
    """
    chosen: set[str] = set()
    for text in templates.values():
        words = _plain_words(text)
        for i in range(max(1, len(words) - SHINGLE_WORDS + 1)):
            run = words[i : i + SHINGLE_WORDS]
            if run and chosen.isdisjoint(run):
                chosen.add(min(run, key=lambda w: (w in COMMON_WORDS, -len(w), w)))
    return sorted(chosen)


def _hashes(templates: dict[str, str], length: int) -> list[int]:
    """Shingle hashes of the templates of a length, as the engine's xxhash64 gives them."""
    found = set()
    for words in map(_plain_words, templates.values()):
        if len(words) == length:
            for i in range(max(1, length - SHINGLE_WORDS + 1)):
                value = xxhash.xxh64_intdigest(" ".join(words[i : i + SHINGLE_WORDS]).encode(), 42)
                found.add(value - (1 << 64) if value >> 63 else value)
    return sorted(found)


def template_rows(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """(license, template_shingles, length) of each template that has words."""
    rows = spark.createDataFrame([(k, v) for k, v in templates.items()], "license string, text string")
    return rows.withColumn("words", words_of(F.col("text"))).where(F.size("words") > 0).select(
        "license", shingles_of(F.col("words")).alias("template_shingles"), F.size("words").alias("length")
    )


def scan(
    docs: DataFrame, id: str = "doc_id", text: str = "text", templates: dict[str, str] | None = None
) -> DataFrame:
    """(id, digest, license, containment double, first_word long): each template found in each text, at its best window.

    A template is found where a stretch of one and a half times its length, in words, has MIN_CONTAINMENT or more of its
    distinct shingles, so that copies with words put in are whole. Windows of the template's own length come first where
    they have as many. Both start at every word, up to the window that ends with the text; shorter texts are one window.
    Bands retrieve windows that move by an eighth of their length; around these, every start is verified whose stretch
    can reach over them. `first_word` counts from 0; of equally good windows the first counts, of equally good
    stretches the first that begins with a shingle of the template, or the last of all. `digest` is the xxhash64 of the text: rows with
    the same id and text are one, null and empty texts have no result. Templates are a list given by the caller; the bands
    of BROADCAST_TEMPLATES or fewer are broadcast. Texts aren't shuffled, only what was found in them. Windows without any shingle of
    a template of their length can't match and aren't hashed: they are told by anchor words, of which every shingle of
    every template has one, and the shingles around these.
    """
    templates = TEMPLATES if templates is None else templates
    known = template_rows(docs.sparkSession, templates)
    anchors = F.array(*[F.lit(w) for w in anchors_of(templates)]).cast("array<string>")
    lengths = sorted({len(_plain_words(t)) for t in templates.values()} - {0})
    if not lengths:
        return docs.limit(0).select(
            id, F.lit(0).cast("long").alias("digest"), F.lit("").alias("license"), F.lit(0.0).alias("containment"), F.lit(0).cast("long").alias("first_word")
        )
    # Anchors inside a shingle of a template of the window's length; where there is none, no window can match.
    shared = F.create_map(*[x for n in lengths for x in (F.lit(n), F.array(*[F.lit(h) for h in _hashes(templates, n)]))])
    run = F.least(F.col("length"), F.lit(SHINGLE_WORDS))

    def in_template(place: Column) -> Column:
        starts = F.sequence(F.greatest(place - (SHINGLE_WORDS - 1), F.lit(0)), place)
        return F.exists(starts, lambda i: F.array_contains(F.col("hashes"), F.xxhash64(F.array_join(F.slice("words", i + 1, run), " "))))

    near = (
        docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("digest"), words_of(F.col(text)).alias("words"))
        .where(F.arrays_overlap("words", anchors))
        .withColumn("anchored", F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.array_contains(anchors, F.get("words", i))))
        .withColumn("length", F.explode(F.array(*[F.lit(n) for n in lengths])))
        .withColumn("hashes", shared[F.col("length")])
        .withColumn("places", F.filter("anchored", in_template))
        .where(F.size("places") > 0)
    )
    step = F.greatest(F.floor(F.col("length") / STEPS_PER_WINDOW), F.lit(1)).cast("int")
    last = F.greatest(F.size("words") - F.col("length"), F.lit(0))
    # Starts on the grid of windows that reach over an anchor, and that of the last window.
    around = F.flatten(
        F.transform(
            "places",
            lambda p: F.filter(
                F.transform(F.sequence(F.lit(0), F.floor(F.col("length") / F.col("step"))), lambda back: (F.floor(p / F.col("step")) - back) * F.col("step")),
                lambda s: (s >= 0) & (s <= F.col("last")) & (s + F.col("length") > p),
            ),
        )
    )
    # Hashes of the runs of words that start at each place of the text, and those of a number of words from a start on.
    ends = F.greatest(F.size("words") - run, F.lit(0))
    hashed = F.transform(F.sequence(F.lit(0), ends), lambda i: F.xxhash64(F.array_join(F.slice("words", i + 1, run), " ")))
    more = F.floor(F.col("length") / STRETCH_PART).cast("int")
    low = F.greatest(F.col("start") - F.col("step") - more, F.lit(0))

    def held(hashes: str, start: Column, words: Column) -> Column:
        return F.slice(hashes, start + 1, F.greatest(words - run + 1, F.lit(1)))

    windows = (
        near.withColumn("step", step)
        .withColumn("last", last)
        .withColumn("runs", hashed)
        .withColumn("start", F.explode(F.array_distinct(F.concat(around.cast("array<int>"), F.array("last")))))
        .where(F.arrays_overlap(F.slice("words", F.col("start") + 1, F.col("length")), anchors))
        .withColumn("low", low)
        .withColumn("high", F.least(F.col("start") + F.col("step"), F.col("last")))
        .select(
            "id", "digest", "length", "low", "high", "last",
            held("runs", F.col("low"), F.col("high") - F.col("low") + F.col("length") + more).alias("region"),
            held("runs", F.col("start"), F.col("length")).alias("shingles"),
        )
    )
    bands = known.select("license", "template_shingles", F.col("length").alias("own_length"), bands_of(F.col("template_shingles")).alias("own_keys"))
    bands = bands.select("*", F.posexplode("own_keys").alias("own_band", "own_key"))
    bands = F.broadcast(bands) if len(templates) <= BROADCAST_TEMPLATES else bands
    keyed = windows.select("id", "digest", "length", "low", "high", "last", "region", bands_of(F.col("shingles")).alias("keys"))
    met = keyed.select("*", F.posexplode("keys").alias("band", "key")).join(
        bands, (F.col("band") == F.col("own_band")) & (F.col("key") == F.col("own_key")) & (F.col("length") == F.col("own_length"))
    )
    share = lambda hashes: F.size(F.array_intersect("template_shingles", hashes)) / F.size("template_shingles")

    def at(wide: bool, words: Column) -> Callable[[Column], Column]:
        """Minus the share of the words from a start on, so that the least is the best."""
        found = lambda s: -share(held("region", s - F.col("low"), words))
        return lambda s: F.struct(found(s).alias("share"), F.lit(wide).alias("wide"), s.cast("long").alias("start"))

    starts = F.sequence("low", "high")
    begins = lambda s: (s == F.col("last")) | F.array_contains("template_shingles", F.get("region", s - F.col("low")))
    best = F.array_min(
        F.concat(F.transform(starts, at(False, F.col("length"))), F.transform(F.filter(starts, begins), at(True, F.col("length") + more)))
    )
    # A window that meets a template in several bands is verified in the first, and only where enough is around it.
    first = F.array_position(F.zip_with("keys", "own_keys", lambda a, b: a == b), True) == F.col("band") + 1
    return (
        met.where(first & (share(F.col("region")) >= MIN_CONTAINMENT))
        .groupBy("id", "digest", "license")
        .agg(F.min(best).alias("best"))
        .where(F.col("best.share") <= -MIN_CONTAINMENT)
        .select(F.col("id").alias(id), "digest", "license", (-F.col("best.share")).alias("containment"), F.col("best.start").alias("first_word"))
    )
