from __future__ import annotations

import random

from waybill.llm.components import components


def test_least_reachable_node(spark, space):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(300, i) for i in range(301, 380)]
    loose = [(rng.randrange(500, 600), rng.randrange(500, 600)) for _ in range(70)]
    edges = chain + star + loose + [(7, 7), (9, 8), (8, 9), (-5, 7)]
    rng.shuffle(edges)
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(edges, "a long, b long"), space).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.root for r in got} == {x: find(x) for x in root if find(x) != x}


def test_no_edges(spark, space):
    assert components(spark.createDataFrame([], "a long, b long"), space).collect() == []
