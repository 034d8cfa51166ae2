import random

from stratus.llm import graph


def _brute(edges):
    root = {}
    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for u, v in edges:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components_match_union_find(spark, scratch):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)]  # a chain
    edges += [(100, i) for i in range(101, 160)]  # a star
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(50)]
    df = spark.createDataFrame(edges + edges[:5], "u long, v long")
    got = {r["node"]: r["component"] for r in graph.components(df, scratch).collect()}
    assert got == _brute([e for e in edges if e[0] != e[1]])


def test_no_edges(spark, scratch):
    df = spark.createDataFrame([(1, 1)], "u long, v long")
    assert graph.components(df, scratch).count() == 0
