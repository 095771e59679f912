import random

import pytest

from colfit.llm import components as module
from colfit.llm.components import components


def plain(edges):
    label = {x: x for e in edges for x in e}
    while True:
        before = dict(label)
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return label


@pytest.mark.parametrize("limit", [1_000_000, 30])
def test_components(spark, monkeypatch, limit):
    monkeypatch.setattr(module, "FOREST_EDGES", limit)
    chosen = random.Random(1)
    edges = [(i, i + 1) for i in range(1000, 1060)]  # a long chain
    edges += [(5, 2000 + i) for i in range(200)]  # a star
    edges += [(3000 + chosen.randrange(40), 3000 + chosen.randrange(40)) for _ in range(300)]  # a dense group
    edges = [e for e in edges if e[0] != e[1]]
    chosen.shuffle(edges)
    df = spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)
    found = components(df).collect()
    assert {r["node"]: r["component"] for r in found} == plain(edges)
    assert len(found) == len(plain(edges))


def test_no_edges_and_other_types(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
    found = components(spark.createDataFrame([("b", "a"), ("c", "b")], "a string, b string")).collect()
    assert {tuple(r) for r in found} == {("a", "a"), ("b", "a"), ("c", "a")}
