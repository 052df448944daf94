import random
import re

from lotwise.llm import license_scan
from lotwise.llm.license_texts import TEMPLATES


def _runs(words, size=5):
    return {" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def _brute(text, templates):
    """Best containment and its first word, over every window of each template's length and every stretch of one and a
    half times that which begins with a shingle of the template or is the last."""
    words = [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").lower()) if w]
    out = {}
    for name, content in templates.items():
        own = [w for w in re.split(r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+", content.lower()) if w]
        if not own or not words:
            continue
        size = min(5, len(own))
        known, last = _runs(own), max(0, len(words) - len(own))
        share = lambda s, n: len(known & _runs(words[s : s + n], size)) / len(known)
        tried = [(-share(s, len(own)), False, s) for s in range(last + 1)]
        tried += [(-share(s, len(own) + len(own) // 2), True, s) for s in range(last + 1) if s == last or " ".join(words[s : s + size]) in known]
        best = min(tried)
        if best[0] <= -0.8:
            out[name] = (-best[0], best[2])
    return out


def _texts():
    filler = " ".join(f"filler{i}" for i in range(400))
    texts = [None, "", "license", filler, "Released under the MIT License."]
    for n, text in enumerate(TEMPLATES.values()):
        words = text.split()
        texts += [f"{filler[: 37 * n]} {text.upper()} {filler}", text, " ".join(words[: len(words) // 2])]
        if len(words) > 30:
            texts.append(" ".join([*words[:12], "changed", *words[13:]]) + " " + filler)
    return texts


def _got(frame):
    out = {}
    for r in frame.collect():
        out.setdefault(r.doc_id, {})[r.license] = (r.containment, r.first_word)
    return out


def test_matches_every_window(documents):
    texts = _texts()
    got = _got(license_scan.scan(documents(*enumerate(texts))))
    assert got == {i: found for i, t in enumerate(texts) if (found := _brute(t, TEMPLATES))}


def test_short_templates_and_repeated_rows(spark, documents):
    templates = {"short": "All rights", "one": "proprietary", "none": "..."}
    texts = ["all rights reserved here", "Proprietary!", "nothing", "all", "proprietary " * 50]
    docs = documents(*enumerate(texts), (0, texts[0]), (None, texts[1]))
    got = _got(license_scan.scan(docs, templates=templates))
    want = {i: found for i, t in enumerate(texts) if (found := _brute(t, templates))}
    assert got == want | {None: want[1]}
    assert license_scan.scan(docs, templates={}).count() == 0
    assert license_scan.scan(documents()).count() == 0


def test_no_python_in_the_plan(documents):
    frame = license_scan.scan(documents((1, "x")))
    shown = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", shown)


def test_every_shingle_has_an_anchor():
    anchors = set(license_scan.anchors_of(TEMPLATES))
    for text in TEMPLATES.values():
        words = license_scan._plain_words(text)
        assert all(anchors & set(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def _marked(words, places):
    return [f"changed{i}" if i in places else w for i, w in enumerate(words)]


def test_found_wherever_the_text_puts_it(documents):
    """Copies with words changed are found at every offset, with the containment of the aligned copy."""
    texts, want = [], []
    for name, number in (("BSD-3-Clause#1", 1), ("MIT#2", 2), ("GPL-3.0#2", 1)):
        words = license_scan._plain_words(TEMPLATES[name])
        # Changed runs in the middle, as many words as leave just enough of the template.
        changed = _marked(words, set(range(10, 10 + number)))
        while len(_runs(words) & _runs(_marked(changed, {10 + number}))) >= 0.8 * len(_runs(words)):
            changed, number = _marked(changed, {10 + number}), number + 1
        share = len(_runs(words) & _runs(changed)) / len(_runs(words))
        assert 0.8 <= share < 0.83
        for offset in range(9):
            texts.append(" ".join([*(f"before{i}" for i in range(offset)), *changed, *(f"after{i}" for i in range(80))]))
            want.append((name, (share, offset)))
    got = _got(license_scan.scan(documents(*enumerate(texts))))
    assert [got.get(i, {}).get(name) for i, (name, _) in enumerate(want)] == [found for _, found in want]


def _best_of_every_start(words, own):
    """Best containment over every window of the template's length and every stretch of one and a half times that."""
    last = max(0, len(words) - len(own))
    parts = (words[s : s + n] for s in range(last + 1) for n in (len(own), len(own) + len(own) // 2))
    return max(len(_runs(own) & _runs(part)) for part in parts) / len(_runs(own)) if words else 0.0


def test_copies_with_words_put_in(documents):
    rng = random.Random(3)
    texts = []
    for name, number in (("MIT#2", 16), ("GPL-2.0#1", 10)):
        words = license_scan._plain_words(TEMPLATES[name])
        for offset in (0, 1, 5, 11):
            put = [*words[: len(words) // 2], *(f"new{i}" for i in range(number)), *words[len(words) // 2 :]]
            texts.append([*(f"before{i}" for i in range(offset)), *put, *(f"after{i}" for i in range(rng.choice([0, 3, 90])))])
    planted = len(texts)
    for text in TEMPLATES.values():
        for _ in range(3):
            # Words put in, changed and left out anywhere.
            words = license_scan._plain_words(text)
            for _ in range(rng.randrange(6)):
                at = rng.randrange(len(words))
                words[at : at + rng.randrange(2)] = [f"new{i}" for i in range(rng.randrange(8))]
                words = words or ["none"]
            texts.append([*["before"] * rng.randrange(40), *words, *["after"] * rng.randrange(40)])
    got = _got(license_scan.scan(documents(*[(i, " ".join(t)) for i, t in enumerate(texts)])))
    assert all(name in got.get(i, {}) for i, name in enumerate(["MIT#2"] * 4 + ["GPL-2.0#1"] * 4)) and planted == 8
    for i, words in enumerate(texts):
        every = {name: _best_of_every_start(words, license_scan._plain_words(text)) for name, text in TEMPLATES.items()}
        assert {name: share for name, (share, _) in got.get(i, {}).items()} == {name: share for name, share in every.items() if share >= 0.8}
