import time
from itertools import combinations, product

from pyspark.sql import functions as F

from lotwise.llm import queries, url_rules


def _judge(url):
    """(host, path, rule, verdict) by plain string work; the verdict is None where no rule fits."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "?#" if c in rest] + [len(rest)])
        head = rest[:end]
        slash = head.find("/") if "/" in head else len(head)
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in head[:slash]), head[slash:]
    fits = [(len(h + p), h + p, v) for v, h, p in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.com/en/1?x=http://b/", "http://www.example.com/en/", "https://a.www.example.com/en/x",
    "http://example.com/EN/", "http://notexample.com/en/", "http://a.net/es/1", "http://net/es/", "http://a.net/fr", "http://com",
    "ftp://x.com/?q", "http://x.com#frag/", "http://x.com?a/b", "://com/", "a://b://com/", "http://a.net/fr/\nnext", "http://Ünï.net/es/",
]


def test_parts_and_fixed_rules(spark):
    pages = spark.createDataFrame([(i, u, 1, "x") for i, u in enumerate(URLS)], "page_id long, url string, host int, token string")
    rules = url_rules.mine(pages.select("url", F.lit(True).alias("bad")).limit(0), "url", "bad")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(pages, rules).collect()}
    for i, url in enumerate(URLS):
        host, path, rule, verdict = _judge(url)
        assert got[i] == (host, path, rule, verdict or "allow"), url
    assert url_rules.judge(pages.limit(0), rules).count() == 0


def _mined(rows):
    """All combinations of tokens with the support and confidence, less those with a part as sure."""
    need = url_rules.MIN_SUPPORT * len(rows)
    sure = {}
    tokens = {t for own, _ in rows for t in own}
    frequent = [t for t in tokens if sum(t in own for own, _ in rows) >= need]
    for size in range(1, 4):
        for combo in combinations(sorted(frequent), size):
            has = [bad for own, bad in rows if set(combo) <= own]
            if sum(has) >= need and sum(has) / len(has) >= url_rules.MIN_CONFIDENCE:
                sure[combo] = sum(has) / len(has)
    return {c for c, conf in sure.items() if not any(set(d) < set(c) and sure[d] >= conf for d in sure)}


def test_mined_rules_and_their_matches(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "MIN_SUPPORT", 0.05)
    urls = [(f"https://spam{i}.org/win/{i}", True) for i in range(12)] + [(f"http://ok.org/win/{i}?ref=x", i % 5 == 0) for i in range(30)]
    urls += [(f"http://ok.org/read/{i}?ref=y", i % 4 != 0) for i in range(8)] + [(None, True), ("x", False)]
    labelled = spark.createDataFrame(urls, "url string, bad boolean")
    rules = url_rules.mine(labelled, "url", "bad", support=0.05)
    rows = [(set(r.t), r.bad) for r in labelled.select(url_rules.tokens_of(F.col("url")).alias("t"), "bad").collect() if r.t]
    want = _mined(rows)
    got = {tuple(sorted(c)) for r in rules.collect() for c in product(*r.any_of)}
    assert {c for c in got if len(c) <= 3} == want and want
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls)] * 2, "page_id long, url string")
    blocked = {r.page_id for r in url_rules.judge(pages, rules).where("mined").collect()}
    tokens = {i: set(r.t) for i, r in enumerate(labelled.select(url_rules.tokens_of(F.col("url")).alias("t")).collect())}
    assert blocked == {i for i, own in tokens.items() if any(set(c) <= own for c in got)}
    assert url_rules.judge(pages, rules).count() == 2 * len(urls)


def test_query_judges_every_page(spark, small):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url").collect()}
    got = queries.op9_url_filter(spark, small).collect()
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        host, path, rule, verdict = _judge(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.mined else "allow"))


def test_many_fixed_parts_of_a_path_are_one_class(spark):
    path = "/".join(f"part{chr(97 + i)}" for i in range(25))
    urls = [(f"https://one.example.org/{path}/{i}", i % 10 != 0) for i in range(200)] + [(f"https://two.org/{i}/parta", False) for i in range(200)]
    labelled = spark.createDataFrame(urls, "url string, bad boolean")
    begin = time.monotonic()
    rules = url_rules.mine(labelled, "url", "bad").collect()
    assert time.monotonic() - begin < 60
    # The host, its first two labels but "org", and all parts but the first, which the other host has too.
    assert [len(r.any_of) for r in rules] == [1]
    assert rules[0].any_of[0] == sorted(["host=one.example.org", "label=one", "label=example", *[f"path=part{chr(98 + i)}" for i in range(24)]])
    assert rules[0].rarest == rules[0].any_of[0] and abs(rules[0].confidence - 0.9) < 1e-9 and rules[0].support == 180 / 400
    pages = spark.createDataFrame([(1, "http://x.org/partb"), (2, "http://x.org/parta"), (3, "http://one.x/")], "page_id long, url string")
    mined = url_rules.mine(labelled, "url", "bad")
    assert {r.page_id: r.verdict for r in url_rules.judge(pages, mined).collect()} == {1: "block", 2: "allow", 3: "block"}


def test_query_blocks_by_rules_that_the_labels_give(spark, small, tmp_path):
    """Pages of their own, whose bad documents share a path: the registered query blocks just the URLs with that path."""
    rows = [(i, f"https://h{i % 7}.org/{'cheap/deals' if i % 3 == 0 else 'read/on'}/{i}") for i in range(300)]
    rows += [(i, f"https://other{i % 5}.org/{'cheap' if i % 2 else 'fine'}/index") for i in range(300, 320)] + [(400, None)]
    spark.createDataFrame(rows, "page_id long, url string").withColumn("html", F.lit("")).write.parquet(f"{tmp_path}/pages.parquet")
    labels = [(i, int(i % 3 != 0 or i % 30 == 0), 0) for i in range(300)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.page_id: r for r in queries.op9_url_filter(spark, str(tmp_path)).collect()}
    assert set(got) == {i for i, _ in rows}
    for i, url in rows:
        assert got[i].mined == bool(url and ("/cheap/" in url)), url
        assert got[i].verdict == ("block" if got[i].mined else "allow")
