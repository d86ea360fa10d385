import random

from lading.llm.graph import components


def test_components_of_chains_stars_and_noise(spark):
    r = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 400)] + [(500, 500 + k) for k in range(1, 200)] + [(7, 7), (None, 3), (4, None)]
    edges += [(r.randrange(1000, 1400), r.randrange(1000, 1400)) for _ in range(250)] + [(-5, 900), (900, -5)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            i, j = sorted((root(a), root(b)))
            parent[j] = i
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
