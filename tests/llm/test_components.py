import random

from utterflow.llm.common import connected_components


def slow(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        if a is not None and b is not None:
            ra, rb = find(a), find(b)
            root[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in root if find(x) != x}


def test_chains_hubs_cycles_and_random_graphs(spark):
    rng = random.Random(9)
    chain = [(i, i + 1) for i in range(300)]
    rng.shuffle(chain)
    hub = [(5000, 6000 + i) for i in range(500)]
    cycle = [(7000 + i, 7000 + (i + 1) % 50) for i in range(50)]
    loose = [(rng.randint(10_000, 11_000), rng.randint(10_000, 11_000)) for _ in range(600)]
    odd = [(1, 1), (None, 3), (4, None), (-7, 2), (-7, 2), (2, -7)]
    edges = chain + hub + cycle + loose + odd
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == slow(edges) and len(got) == len(slow(edges))


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
