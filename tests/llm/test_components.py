import random

from lotwise.llm.common import components


def test_random_graphs_match_union_find(spark):
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, 500 + i) for i in range(1, 80)]
    noise = [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(90)]
    edges = chain + star + noise + [(7, 7), (8, None), (None, 9), (1, 2), (1, 2), (2, 1)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    got = components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()
    assert {r.node: r.root for r in got} == {x: find(x) for x in root}
    assert len(got) == len(root)


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").collect() == []
