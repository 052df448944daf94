"""URL filters: allow and block rules by host and path, else association rules mined from labelled URLs by FP-growth."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import ascii_lower, checkpointed

# (verdict, host, path) of fixed rules.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# A token combination must occur in this share of labelled URLs, and be bad in this share of its URLs.
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.7
# Tokens of mined rules, and frequent tokens, that may be broadcast; more meet the URLs by a shuffle.
BROADCAST_RULES = 20_000

_BAD = "\x00bad"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"


def host_of(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty for null or without `://`."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, _PARTS, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty for null or without `://`."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def fixed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits: same host or a subdomain, path with the rule's in front; else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        verdict = F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a URL: whole host, its labels, path segments and ending, query keys with values, fragment.

    Runs of digits are one and the same, so numbers don't tell URLs apart. Null or no `://`: no tokens.
    """
    numbers = lambda c: F.regexp_replace(c, r"[0-9]+", "0")
    some = lambda prefix, column, pattern: F.transform(
        F.filter(F.split(column, pattern), lambda t: t != ""), lambda t: F.concat(F.lit(prefix), numbers(t))
    )
    host, path = host_of(url), path_of(url)
    query = F.coalesce(F.regexp_extract(url, _PARTS, 3), F.lit(""))
    return F.array_distinct(
        F.concat(
            F.filter(F.array(F.concat(F.lit("host="), numbers(host))), lambda t: t != "host="),
            some("label=", host, r"\."),
            some("path=", path, "/"),
            F.filter(F.array(F.concat(F.lit("ending="), F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1))), lambda t: t != "ending="),
            some("query=", query, r"[?&;]"),
            some("fragment=", F.coalesce(F.regexp_extract(url, _PARTS, 4), F.lit("")), "#"),
        )
    )


def _classes(rows: DataFrame, least: float) -> DataFrame:
    """(token, class, freq) of the tokens in at least `least` rows; tokens of the very same rows share a class, the smallest of them.

    The rows of a token are told by their number and two hashes of 64 bits over its distinct baskets. The result has at
    most 1 / support times the tokens of an average URL.
    """
    baskets = rows.groupBy("tokens").agg(F.count("*").alias("n"))
    signs = [F.bit_xor(F.xxhash64(F.lit(seed), "tokens")).alias(f"sign{seed}") for seed in (1, 2)]
    single = (
        baskets.select("n", "tokens", F.explode("tokens").alias("token"))
        .groupBy("token")
        .agg(F.sum("n").alias("freq"), *signs)
        .where(F.col("freq") >= least)
    )
    same = Window.partitionBy("freq", "sign1", "sign2")
    return checkpointed(single.select("token", F.min("token").over(same).alias("class"), "freq"))


def mine(labelled: DataFrame, url: str, bad: str, support: float = MIN_SUPPORT, confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(tokens, any_of, rarest, confidence, support) of the token combinations that mark bad URLs.

    `labelled` has a URL and a boolean a row; null labels and URLs without tokens are left out. FP-growth counts the
    combinations in at least `support` of the URLs, whole table; a rule is kept if at least `confidence` of its URLs are
    bad and no part of it is as sure. No labelled rows give no rules.

    Tokens of the same labelled URLs (a host and its labels, the fixed parts of a path) are one class to FP-growth, so
    they don't double its combinations. A rule stands for all rules with one token of each of its classes: `any_of` lists
    the classes, `tokens` their smallest tokens, `rarest` the class in the fewest labelled URLs, its place in the index.
    """
    own = F.col(bad).alias("bad")
    rows = checkpointed(labelled.where(F.col(bad).isNotNull()).select(tokens_of(F.col(url)).alias("tokens"), own).where(F.size("tokens") > 0))
    every = rows.count()
    known = _classes(rows, support * every)
    few = F.broadcast(known) if known.count() <= BROADCAST_RULES else known
    # One basket of classes for each basket of tokens; their many rows meet it by a join that adaptive execution splits.
    short = (
        rows.select("tokens").distinct().select("tokens", F.explode("tokens").alias("token")).join(few, "token")
        .groupBy("tokens").agg(F.collect_set("class").alias("classes"))
    )
    met = rows.join(short.hint("merge"), "tokens", "left").withColumn("classes", F.coalesce("classes", F.array().cast("array<string>")))
    baskets = checkpointed(met.select(F.when(F.col("bad"), F.concat("classes", F.array(F.lit(_BAD)))).otherwise(F.col("classes")).alias("items")))
    found = FPGrowth(itemsCol="items", minSupport=support).fit(baskets).freqItemsets
    itemsets = checkpointed(found.select(F.array_sort("items").alias("items"), "freq"))
    # The mark sorts before all tokens, so it comes first.
    with_bad = itemsets.where((F.get("items", F.lit(0)) == _BAD) & (F.size("items") > 1))
    marked = with_bad.select(F.slice("items", 2, F.size("items") - 1).alias("items"), F.col("freq").alias("bad_freq"))
    sure = marked.join(itemsets, "items").select(
        F.col("items").alias("tokens"), (F.col("bad_freq") / F.col("freq")).alias("confidence"), (F.col("bad_freq") / F.lit(every)).alias("support")
    )
    members = known.groupBy("class").agg(F.array_sort(F.collect_set("token")).alias("members"), F.first("freq").alias("freq"))
    members = F.broadcast(members) if known.count() <= BROADCAST_RULES else members
    one = F.struct("freq", "class", "members").alias("one")
    rules = checkpointed(
        sure.where(F.col("confidence") >= confidence)
        .select("*", F.explode("tokens").alias("class"))
        .join(members, "class")
        .groupBy("tokens", "confidence", "support")
        .agg(F.array_sort(F.collect_list(one)).alias("by_freq"))
        .select("tokens", "by_freq.members", F.col("by_freq")[0]["members"].alias("rarest"), "confidence", "support")
        .withColumnRenamed("members", "any_of")
    )
    # A rule is redundant if a smaller one within it is as sure; the smaller one's rarest class is one of its classes.
    least = F.get("rarest", F.lit(0))
    within = rules.select(F.col("tokens").alias("part"), least.alias("part_rarest"), F.col("confidence").alias("part_confidence"))
    redundant = (
        rules.select("tokens", "confidence", F.explode("tokens").alias("token"))
        .join(within, F.col("token") == F.col("part_rarest"))
        .where((F.size("part") < F.size("tokens")) & (F.col("part_confidence") >= F.col("confidence")))
        .where(F.size(F.array_except("part", "tokens")) == 0)
        .select("tokens")
        .distinct()
    )
    return checkpointed(rules.join(redundant, "tokens", "left_anti"))


def judge(pages: DataFrame, rules: DataFrame, id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per row of `pages`: (id, host, path, rule, verdict, mined). Repeated rows stay; null URLs are allowed.

    The longest fixed rule decides; without one, a URL is blocked if it holds a token of every class of a mined rule.
    Rules are found by an inverted index: each is listed under the tokens of its rarest class, to which the tokens of the
    URLs are joined.
    """
    rows = pages.select(F.col(id).alias("id"), F.col(url).alias("url"))
    index = rules.select("any_of", F.explode("rarest").alias("rare"))
    listed = index.agg(F.sum(F.size(F.flatten("any_of")))).first()[0] or 0
    index = F.broadcast(index) if listed <= BROADCAST_RULES else index
    hit = (
        rows.where(F.col("url").isNotNull())
        .select("url", tokens_of(F.col("url")).alias("own"))
        .select("url", "own", F.explode("own").alias("token"))
        .join(index, F.col("token") == F.col("rare"))
        .where(F.forall("any_of", lambda one: F.arrays_overlap(one, "own")))
        .select(F.col("url").alias("hit_url"))
        .distinct()
    )
    rule, verdict = fixed_rule(F.col("host"), F.col("path"))
    return (
        rows.join(hit, rows["url"] == hit["hit_url"], "left")
        .select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("hit_url").isNotNull().alias("mined"))
        .select(
            F.col("id").alias(id), "host", "path", rule.alias("rule"),
            F.coalesce(verdict, F.when(F.col("mined"), "block").otherwise("allow")).alias("verdict"), "mined",
        )
    )


def labelled_urls(pages: DataFrame, labels: DataFrame, url: str = "url") -> DataFrame:
    """(url, bad) of the pages whose document is labelled: a page shows the document numbered in its path; bad is low quality or toxic."""
    marks = labels.groupBy("doc_id").agg((F.min("quality") == 0).alias("low"), (F.max("toxic") == 1).alias("toxic"))
    number = F.regexp_extract(path_of(F.col(url)), r"/([0-9]{1,18})(?:\.[A-Za-z0-9]+)?/?$", 1).try_cast("long")
    shown = pages.select(F.col(url).alias("url"), number.alias("number")).where("number is not null")
    return shown.join(marks, shown["number"] == marks["doc_id"]).select("url", F.coalesce(F.col("low") | F.col("toxic"), F.lit(False)).alias("bad"))
