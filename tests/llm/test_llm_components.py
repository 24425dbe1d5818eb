import random

import numpy as np

from feedloom.llm.components import components, forest


def brute(edges):
    root = {}
    for a, b in edges:
        if a != b:
            root.setdefault(a, a), root.setdefault(b, b)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def graphs():
    rng = random.Random(1)
    yield [(i, i + 1) for i in range(120)]
    yield [(0, i) for i in range(1, 300)] + [(299, 1000), (1000, 5000)]
    yield [(rng.randrange(200), rng.randrange(200)) for _ in range(130)] * 2
    yield [(5, 5)]


def test_components_equal_brute_force(spark):
    for edges in graphs():
        shuffled = [(b, a) if i % 2 else (a, b) for i, (a, b) in enumerate(edges)]
        df = spark.createDataFrame(shuffled, "a bigint, b bigint")
        got = components(df, "a", "b").collect()
        want = {x: r for x, r in brute(edges).items() if x != r}
        assert {r.node: r.root for r in got} == want and len(got) == len(want)
    assert components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0


def test_forest_keeps_connections():
    for edges in graphs():
        a, b = np.array(edges, np.int64).T
        node, root = forest(a, b)
        assert dict(zip(node.tolist(), root.tolist())) == {x: r for x, r in brute(edges).items() if x != r}
