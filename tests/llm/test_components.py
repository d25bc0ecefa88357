import random

from trestle.llm.components import components


def expected(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


def same_parts(spark, edges):
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = expected(edges)
    assert got.keys() == want.keys()
    parts = {}
    for node, root in got.items():
        parts.setdefault(root, set()).add(node)
        assert root in got
    assert sorted(map(sorted, parts.values())) == sorted(
        map(sorted, [{n for n in want if want[n] == r} for r in set(want.values())]))


def test_random_graphs_chains_stars_and_loops(spark):
    rng = random.Random(4)
    same_parts(spark, [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)])
    same_parts(spark, [(i, i + 1) for i in range(400)])
    same_parts(spark, [(0, i) for i in range(1, 400)] + [(999, 999), (5, 0), (5, 0)])


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
