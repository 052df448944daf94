import random
import re

from pyspark.sql import functions as F

from lotwise.llm import decontaminate


def _words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _brute(text, items):
    words, hit, found = _words(text), set(), set()
    for name, content in items:
        own = _words(content)
        size = min(13, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            for j in range(len(words) - size + 1):
                if words[j : j + size] == own[i : i + size]:
                    hit.update(range(j, j + size))
                    found.add(str(name))
    return len(words), len(hit), sorted(found)


def _cases():
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "b", "the", "Ünder", "x1"])
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 2, 5, 13, 14, 30])))) for i in range(12)]
    items += [(50, None), (None, "the a"), (51, items[5][1])]
    texts = [" ".join(word() for _ in range(rng.choice([0, 3, 20, 60]))) for _ in range(30)]
    texts += [f"{texts[1]}! {items[i][1]} ;; {texts[2]}".upper() for i in range(12)] + [None, "", "...", "zz " * 5000]
    return [(n % 40, t) for n, t in enumerate(texts)], items


def _benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_matches_brute_force_in_one_and_more_passes(spark, documents, monkeypatch):
    rows, items = _cases()
    named = [(n, t) for n, t in items if n is not None]
    want = sorted((i, *_brute(t, named)) for i, t in rows)
    for words in (200_000, 40):
        monkeypatch.setattr(decontaminate, "PASS_WORDS", words)
        found = decontaminate.contamination(documents(*rows), _benchmark(spark, items))
        got = found.select("doc_id", "n_words", decontaminate.n_hit().alias("n"), "items").collect()
        assert sorted((r.doc_id, r.n_words, r.n, r["items"]) for r in got) == want


def test_repeated_rows_stay_over_passes(spark, documents, monkeypatch):
    monkeypatch.setattr(decontaminate, "PASS_WORDS", 1)
    found = decontaminate.contamination(documents((1, "a b"), (1, "a b"), (None, None)), _benchmark(spark, [(1, "a"), (2, "b"), (3, "c")]))
    assert sorted((r.doc_id or 0, r["items"]) for r in found.collect()) == [(0, []), (1, ["1", "2"]), (1, ["1", "2"])]


def test_empty_tables(spark, documents):
    nothing = _benchmark(spark, [])
    assert decontaminate.contamination(documents(), nothing).count() == 0
    only = decontaminate.contamination(documents((1, "a b c")), nothing).select("n_words", decontaminate.is_contaminated().alias("bad"))
    assert only.first() == (3, False)


def test_clean_drops_contaminated_rows_alone(spark, documents):
    item = " ".join(f"w{i}" for i in range(20))
    filler = " ".join(f"f{i}" for i in range(500))
    docs = documents((1, item), (2, f"{item} {filler}"), (3, filler), (4, None), (4, ""), (None, item), (3, filler))
    kept = decontaminate.clean(docs, _benchmark(spark, [(9, item)]))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 3, 4, 4]
    assert kept.where(F.col("digest") != 1).count() == 0


def test_no_pass_for_nothing(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PASS_WORDS", 2)
    pieces = lambda *items: [len(p) for p in decontaminate._passes(_benchmark(spark, list(items)).coalesce(1), "item_id", "text")]
    assert pieces((1, "a b"), (2, "c d")) == [1, 1]
    assert pieces((1, "a b"), (2, "c")) == [1, 1]
    assert pieces() == [0]
