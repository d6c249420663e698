from __future__ import annotations

import random

from llm_support import union_find

from tallyloom.llm.components import connected_components


def labels(spark, edges):
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    return dict(map(tuple, connected_components(frame).collect()))


def test_random_graph_chain_and_star(spark):
    random.seed(3)
    edges = [(random.randrange(400), random.randrange(400)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 80)]
    edges += [(-5, 3000), (7, None), (9, 9), (3000, -5)]
    real = [(a, b) for a, b in edges if b is not None and a != b]
    assert labels(spark, edges) == union_find({n for e in real for n in e}, real)


def test_no_edges(spark):
    assert labels(spark, []) == {}
