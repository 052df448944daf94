import numpy as np
import pytest

from lotwise.llm import embedding_dedup


def _vectors(seed=1, n=400, dims=24):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dims))
    near = [base[i] + rng.standard_normal(dims) * 0.2 * rng.random() for i in range(0, n, 4)]
    cluster = [base[0] + rng.standard_normal(dims) * 0.03 for _ in range(150)]
    return [*base, *near, *cluster]


def _rows(vectors):
    rows = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(vectors)]
    rows += [(9000, rows[5][1], rows[5][2]), (9001, rows[5][1], rows[5][2]), (9002, rows[5][1], None), (9003, None, 1), (9004, [0.0] * 24, 1)]
    rows += [(9005, [float("nan")] * 24, 1), (9006, [1.0, None], 1), (9007, [], 1), (9008, [2.0] * 3, 1), (9009, [1.0] * 3, 1), (9010, [float("inf")] * 24, 0)]
    return rows


def _brute(rows):
    root, links = {i: i for i, _, _ in rows}, {i: set() for i, _, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sound = [(i, np.array(v), g) for i, v, g in rows if v and g is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for n, (i, a, g) in enumerate(sound):
        for j, b, h in sound[:n]:
            if g == h and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.98:
                links[i].add(j)
                links[j].add(i)
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: (len(links[i]), find(i), find(i) == i) for i in root}


@pytest.mark.parametrize("group", [4096, 100])
def test_forest_finds_all_links_and_no_other(spark, monkeypatch, group):
    monkeypatch.setattr(embedding_dedup, "GROUP_ROWS", group)
    rows = _rows(_vectors())
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, label int, key int, rows int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(frame).collect()}
    want = _brute(rows)
    assert got == want
    assert sum(w[0] for w in want.values()) > 1000


def test_recall_of_one_tree_with_spill():
    """Pairs of a cosine just above the bound, in leaves far smaller than the data."""
    rng = np.random.default_rng(3)
    a = rng.standard_normal((4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.standard_normal((4000, 64))
    side -= np.einsum("ij,ij->i", side, a)[:, None] * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    b = 0.981 * a + np.sqrt(1 - 0.981**2) * side
    found = set()
    for i, j in embedding_dedup.leaf_links(np.concatenate([a, b]), np.random.default_rng(1)):
        found.update(zip(i.tolist(), j.tolist(), strict=True))
    assert len({(i, i + 4000) for i in range(4000)} & found) >= 0.95 * 4000


def test_empty_and_repeated(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.001], 1), (3, [-1.0, 0.0], 1)]
    got = sorted(tuple(r) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, schema)).collect())
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]
