import random

from strataframe.operators.graph import connected_components


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(7, 7), (5000, 5000)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == brute(edges)


def test_components_empty_and_null(spark):
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0
    assert connected_components(spark.createDataFrame([(None, 1)], "src long, dst long")).count() == 0
