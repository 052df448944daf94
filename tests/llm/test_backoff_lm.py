import math
import random
import re
from collections import Counter
from zlib import compress

import pandas as pd
import pytest
from conftest import plan

from lotwise.llm import backoff_lm, queries


def _brute(texts):
    words = [re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    ones, twos = Counter(w for own in words for w in own), Counter(p for own in words for p in zip(own, own[1:], strict=False))
    total = sum(ones.values())
    out = []
    for own in words:
        mine, pairs, score = Counter(own), Counter(zip(own, own[1:], strict=False)), 0.0
        others = total - len(own)
        for i, w in enumerate(own):
            left = ones[w] - mine[w]
            level = left / others if left else 0.4 / (others + 1)
            if i:
                before = own[i - 1]
                both = twos[before, w] - pairs[before, w]
                level = both / (ones[before] - mine[before]) if both else 0.4 * level
            score += math.log10(level)
        out.append((len(own), score))
    return out


@pytest.mark.parametrize("block", [8 << 20, 64])
def test_matches_counters(documents, monkeypatch, block):
    monkeypatch.setattr(backoff_lm, "BLOCK_BYTES", block)
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["the", "The", "a", "b", "Ünd", "x9", f"w{rng.randrange(60)}"]) for _ in range(rng.choice([0, 1, 2, 9, 40]))) for _ in range(40)]
    texts += [texts[5], texts[5], None, "", "!!", "once only", "the " * 3000]
    got = backoff_lm.scores(documents(*[(i, t) for i, t in enumerate(texts)]), order=2).collect()
    assert len(got) == len(texts)
    want = _brute(texts)
    for r in got:
        assert r.n_words == want[r.doc_id][0]
        assert abs(r.log10_score - want[r.doc_id][1]) < 1e-6


def test_small_tables(documents):
    assert backoff_lm.scores(documents()).count() == 0
    alone = backoff_lm.scores(documents((None, "one word"))).first()
    assert (alone.doc_id, alone.n_words) == (None, 2) and alone.log10_score < 0
    rows = backoff_lm.scores(documents((1, "same text here"), (1, "same text here"))).collect()
    assert rows[0] == rows[1]


def _brute_of_order(texts, order):
    """Scores straight from the definition: the longest n-gram that other texts have, backed off one word at a time."""
    words = [re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for t in texts]
    grams = lambda own: Counter(tuple(own[i : i + n]) for n in range(1, order + 1) for i in range(len(own) - n + 1))
    every, total = Counter(), sum(map(len, words))
    for own in words:
        every.update(grams(own))
    out = []
    for own in words:
        mine, score = grams(own), 0.0
        left = lambda gram: every[gram] - mine[gram]
        for i in range(len(own)):
            factor = 1.0
            for n in range(min(order, i + 1), 0, -1):
                gram = tuple(own[i - n + 1 : i + 1])
                if left(gram):
                    level = left(gram) / (left(gram[:-1]) if n > 1 else total - len(own))
                    break
                factor *= 0.4
            else:
                level = 1 / (total - len(own) + 1)
            score += math.log10(factor * level)
        out.append((len(own), score))
    return out


@pytest.mark.parametrize("order", [1, 2, 3, 5])
def test_any_order(documents, monkeypatch, order):
    monkeypatch.setattr(backoff_lm, "BLOCK_BYTES", 200)
    rng = random.Random(order)
    texts = [" ".join(rng.choice("a b c d e F".split()) for _ in range(rng.choice([0, 1, 2, 3, 9, 40]))) for _ in range(40)]
    texts += [texts[5], None, "", "once only here", "a b c new a b c"]
    want = _brute_of_order(texts, order)
    got = backoff_lm.scores(documents(*enumerate(texts)), order=order).collect()
    assert len(got) == len(texts)
    for r in got:
        assert r.n_words == want[r.doc_id][0]
        assert abs(r.log10_score - want[r.doc_id][1]) < 1e-6


def test_query_counts_trigrams(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r.doc_id, n, score) for r, (n, score) in zip(rows, _brute_of_order([r.text for r in rows], 3), strict=True))
    got = sorted((r.doc_id, r.n_words, r.log10_score) for r in queries.op8_backoff_lm(spark, small).collect())
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert all(abs(g[2] - w[2]) < 1e-5 for g, w in zip(got, want, strict=True))


def _block(texts, counted=None):
    rows = pd.DataFrame({"digest": [str(i) for i in range(len(texts))], "copies": 1, "text": [compress(t.encode()) for t in texts]})
    return backoff_lm.Block(rows, 11, counted)


def _every(texts, order):
    one = _block(texts)
    return backoff_lm.Level(one.hashes, one.owner, one.texts["copies"].to_numpy(), order).every


def test_ngrams_are_shuffled_as_arrays_by_slice(documents):
    shuffled = [x for x in plan(backoff_lm.scores(documents((1, "a b c d"), (2, "b c d e")))).split("\n\n") if "Exchange" in x]
    assert any("slice" in x and "grams" in x for x in shuffled) and not any("hashpartitioning(gram" in x for x in shuffled)


def test_a_slice_sends_hashes_and_only_counts_above_one():
    one = _block(["a b a c", "a b"])
    one.climb(1)
    sent = one.sent(5 << 32)
    assert sorted(n for x in sent["often"] for n in x) == [2, 3] and sent["ones"].sum() == 1
    assert sum(map(len, sent["grams"])) == 3 and sent["start"].is_monotonic_increasing
    assert all((g % 2**64) >> 53 == s for s, x in zip(sent["slice"], sent["grams"], strict=True) for g in x.tolist())


@pytest.mark.parametrize("held", [1, 2, 1 << 21])
def test_only_ngrams_of_returned_shorter_ones_are_sent(monkeypatch, held):
    monkeypatch.setattr(backoff_lm, "HELD", held)
    text = "a b c d e f"
    two = _block([text])
    two.climb(1)
    two.climb(2)
    pairs = two.level.every[two.places]
    known = {g: n for n, g in enumerate(_every(["b c d x e f"], 2).tolist(), 7)}
    counts = [(1 << 32 | at, known[g]) for at, g in enumerate(pairs.tolist()) if g in known]
    assert len(counts) == 3
    frames = [pd.DataFrame([x], columns=["at", "total"]) for x in counts[::-1]]
    packs = pd.concat(backoff_lm._packed(iter(frames), 3))
    assert set(packs["block"]) == {0}
    again = _block([text], pd.DataFrame({"block": [0], "packs": [list(packs["pack"])]}))
    again.climb(2)
    assert sorted(again.left(2).tolist()) == sorted([0, 0, 0, *(n - 1 for _, n in counts)])
    again.climb(3)
    # Of a b c, b c d, c d e and d e f only b c d holds two known pairs.
    assert len(again.places) == 1 and again.level.every[again.places[0]] == _every(["b c d"], 3)[0]
