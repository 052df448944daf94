import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lotwise.llm import phrases as op


def _pieces(rows):
    for lang, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            yield lang or "und", re.findall("[^\x20\x09]+", piece)


def _counts(rows, words):
    f = defaultdict(Counter)
    for lang, w in _pieces(rows):
        for size in range(1, words + 1):
            for i in range(len(w) - size + 1):
                f[lang][tuple(w[i : i + size])] += 1
    return f


def _brute(rows, words, least, percent, top):
    out = []
    for lang, f in _counts(rows, words).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            around = [b for q, b in candidates.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= percent * a for b in around):
                continue
            score, k = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(kept)[:top], 1):  # noqa: E741
            out.append((lang, rank, p.decode(), -a, l, r, n, -score))
    return sorted(out)


def _random_rows(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "cc", "dé", "ee\x1cx", "日本", "the", "the", "the", "of"]
    rows = []
    for _ in range(120):
        text = "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "en", "fr", None]), text))
    return [*rows, ("de", None), ("de", ""), ("es", " . ,"), ("en", "same words again " * 400), *[("fr", "one two three four five")] * 12]


def test_quicksort_of_suffixes():
    rng = np.random.default_rng(2)
    for size in (0, 1, 5, 400):
        keys = rng.integers(-1, 4, (3, size))
        for d in (1, 2):
            keys[d][keys[d - 1] < 0] = -1
        weights = rng.integers(1, 5, size)
        least = np.array([1, 6, 9])
        got = {}
        for depth, at, total in op.sorted_runs(keys, weights, least):
            for a, t in zip(at, total, strict=True):
                prefix = tuple(keys[:depth, a].tolist())
                assert prefix not in got
                got[prefix] = int(t)
        want = Counter()
        for j in range(size):
            for depth in (1, 2, 3):
                prefix = tuple(keys[:depth, j].tolist())
                if min(prefix) >= 0:
                    want[prefix] += int(weights[j])
        enough = lambda p: all(want[p[:d]] >= least[d - 1] for d in range(1, len(p) + 1))
        assert got == {p: c for p, c in want.items() if enough(p)}


@pytest.mark.parametrize("short", [True, False])
@pytest.mark.parametrize("words", [2, 3, 4])
def test_distinct_suffixes(monkeypatch, words, short):
    monkeypatch.setattr(op, "KEYS", 1 << 62 if short else 1)
    rows = _random_rows(words)
    keys, often, names = op.suffixes([text for _, text in rows], words)
    spoken = names.to_pylist()
    assert len(set(spoken)) == len(spoken)
    got = [tuple(spoken[i] for i in column if i >= 0) for column in keys.T.tolist()]
    want = Counter(tuple(w[i : i + words]) for _, w in _pieces(rows) for i in range(len(w)))
    assert dict(zip(got, often.tolist(), strict=True)) == want and len(got) == len(want)
    assert keys.T.tolist() == sorted(keys.T.tolist())


def test_hot_suffixes_are_cut_once(spark):
    """However many parts there are, each suffix goes to one of them, with all others of its second word."""
    tails = ["", "a", "a b\t12", "a c", "b\t3", *[f"w{i % 40} x{i}" for i in range(200)]]
    rows = [("en", "the", 5, "\n".join(tails), 7), ("en", "the", 5, "a z\nb", 7), ("fr", "le", 0, "seul", 1)]
    given = spark.createDataFrame(rows, "lang string, head string, lead long, tails string, parts long").repartition(1)
    for deal in (op.SECOND, op.ALL):
        got = op._cut(given, deal).collect()
        assert len(got) <= 7 + 2 + 1 and all(len(r.tails.split("\n")) == r.many for r in got)
        assert Counter((r.lang, r.head, t) for r in got for t in r.tails.split("\n")) == Counter((*r[:2], t) for r in rows for t in r[3].split("\n"))
        leads = defaultdict(set)
        for r in got:
            for t in r.tails.split("\n"):
                words = t.partition("\t")[0]
                leads[r.lang, words.split(" ")[0] if deal == op.SECOND else words].add(r.lead)
        assert all(len(x) == 1 for x in leads.values()) and len(set.union(*leads.values())) > 5


@pytest.mark.parametrize(("words", "least", "hot"), [(3, 10, 1 << 17), (3, 2, 20), (4, 3, 3), (2, 4, 5), (4, 2, 1)])
def test_against_brute_force(spark, monkeypatch, words, least, hot):
    monkeypatch.setattr(op, "HOT_SUFFIXES", hot)
    monkeypatch.setattr(op, "TASK_SUFFIXES", 100)
    rows = _random_rows(words)
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "lang string, text string, f int, phrase string, n int").repartition(3)
    got = op.phrase_counts(docs, words=words, least=least).collect()
    f = _counts(rows, words)
    want = [(lang, len(p), " ".join(p), c) for lang, known in f.items() for p, c in known.items() if c >= least]
    want += [(lang, 0, "", sum(c for p, c in known.items() if len(p) == 1)) for lang, known in f.items()]
    assert sorted(map(tuple, got)) == sorted(want)
    got = op.collocations(docs, words=words, least=least, top=40).collect()
    assert sorted(map(tuple, got)) == _brute(rows, words, least, 50, 40)


def test_best_phrases_meet_after_their_parts(spark, documents):
    docs = documents((1, "one two three. " * 20), (2, "four five. " * 12))
    found = op.collocations(docs)
    assert len(found.collect()) == 2
    windows = re.findall(r"Window \[row_number\(\).*?\], \[(.*?)\], \[score", found._jdf.queryExecution().optimizedPlan().toString())
    assert [re.sub(r"#\d+L?", "", x) for x in windows] == ["lang", "lang, part"]


def test_long_texts_are_cut_at_pieces(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(op, "CHUNK_CHARS", 10)
    text = "one two three four. five six seven; eight nine ten eleven twelve"
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "fr"]), pa.array([text, None])], ["lang", "text"])
    parts = [t for _, texts in op._chunks(iter([batch])) for t in texts]
    assert "".join(parts) == text and len(parts) == 3


def test_empty_tables(spark, documents):
    docs = documents((1, None), (2, ""))
    assert op.collocations(docs).collect() == [] and op.collocations(docs.limit(0)).collect() == []
