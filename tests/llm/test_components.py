import random

from casegrid.llm import common
from casegrid.llm.components import components


def test_against_union_find(spark):
    common.prepare(spark)
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(160)] + [(1000 + i, 1001 + i) for i in range(70)] + [(5000, 5000 + i) for i in range(1, 200)] + [(7, 7), (None, 3), (4, None)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent}


def test_no_edges(spark):
    common.prepare(spark)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
