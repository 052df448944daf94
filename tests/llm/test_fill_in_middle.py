import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import fill_in_middle as op

ENDS = {"line": "\n", "sentence": "\n.!?", "word": "\n \t"}


def _units(text: str, unit: str) -> list[str]:
    ends = re.escape(ENDS[unit])
    return re.findall(f"[^{ends}]*[{ends}]|[^{ends}]+", text)


def test_rank_and_select():
    rng = np.random.default_rng(1)
    for size in (0, 1, 63, 64, 65, 1000):
        codes = rng.integers(0, 4, size).astype(np.uint8)
        matrix = op.WaveletMatrix(codes)
        for code in range(4):
            places = np.flatnonzero(codes == code)
            assert matrix.rank(code, np.arange(size + 1)).tolist() == [int((codes[:i] == code).sum()) for i in range(size + 1)]
            assert matrix.select(code, np.arange(len(places))).tolist() == places.tolist()


@pytest.mark.parametrize("unit", ENDS)
def test_cuts_against_plain_splitting(unit):
    rng = random.Random(3)
    for _ in range(80):
        texts = ["".join(rng.choice("ab\n. é😀\t?") for _ in range(rng.choice([0, 1, 3, 70, 300]))) for _ in range(rng.randint(0, 12))]
        numbers = [tuple(rng.randrange(1 << 32) for _ in range(4)) for _ in texts]
        for text, drawn, n, p, q in zip(texts, numbers, *op.cut(texts, numbers, unit), strict=True):
            units = _units(text, unit)
            low, high = sorted(x % (len(units) + 1) for x in drawn[:2])
            assert (n, p, q) == (len(units), len("".join(units[:low])), len("".join(units[:high])))


ROWS = [
    (1, None), (None, "a\nb\nc"), (2, ""), (3, "one line"), (3, "one line"), (4, "\n\n\n"), (5, "has <P> in it\nyes"), (6, "<S\nP>\n<M\n"),
    (7, "é😀\nß" * 20_000), (2**60 + 1, "a\r\nb\x0bc\n"), (8, "<<\n>>\nP>\n<"),
]


@pytest.mark.parametrize("options", [{}, {"unit": "word", "rate": 60, "suffix_first": 0}, {"unit": "sentence", "seed": 9, "markers": ("<|a|>", "<|b|>", "<|c|>")}])
def test_rows_against_plain_version(spark, documents, options):
    unit, seed = options.get("unit", "line"), options.get("seed", 7)
    before, after, between = options.get("markers", op.MARKERS)
    want = []
    for i, t in ROWS:
        t = t or ""
        h = op.draws(i, seed)
        units = _units(t, unit)
        low, high = sorted(x % (len(units) + 1) for x in h[:2])
        p, m, s = ("".join(units[b:e]) for b, e in ((0, low), (low, high), (high, None)))
        if not t or before in t or after in t or between in t or h[2] % 100 >= options.get("rate", 100):
            want.append((i, len(units), "plain", None, None, t, t))
        elif h[3] % 100 < options.get("suffix_first", 50):
            want.append((i, len(units), "spm", len(p), len(m), after + s + before + p + between + m, t))
        else:
            want.append((i, len(units), "psm", len(p), len(m), before + p + after + s + between + m, t))
    made = op.transform(documents(*ROWS), **options)
    back = op.restored_text(F.col("output"), F.col("form"), (before, after, between))
    got = made.withColumn("restored", back).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_empty_table_and_markers(spark, documents):
    docs = documents((1, "a"))
    assert op.transform(docs.limit(0)).collect() == []
    for markers in [("<P>", "<P>", "<M>"), ("<P>", "[S]", "<M>"), ("<<>", "<S>", "<M>")]:
        with pytest.raises(ValueError):
            op.transform(docs, markers=markers)
