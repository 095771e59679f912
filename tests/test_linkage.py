"""Spanning trees and cuts against plain versions, and components."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from colfit.models import linkage
from colfit.models.linkage import fit_single_linkage
from colfit.operators import connected as module
from colfit.operators.connected import connected


def points_of(seed, n, step=None):
    chosen = random.Random(seed)
    value = (lambda: float(chosen.randrange(step))) if step else (lambda: chosen.gauss(0, 1))
    return [(7 * i + 3, value(), value(), value()) for i in range(n)]


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "k bigint, x double, y double, z double").repartition(parts)


class Sets:
    def __init__(self, nodes):
        self.parent = {x: x for x in nodes}

    def top(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.top(a), self.top(b)))
        self.parent[b] = a
        return a != b

    def named(self):
        least = {}
        for x in sorted(self.parent):
            least.setdefault(self.top(x), x)
        return {x: least[self.top(x)] for x in self.parent}


def plain_tree(rows):
    """All pairs in order, those that join two sets."""
    pairs = sorted((sum((p - q) ** 2 for p, q in zip(a[1:], b[1:], strict=True)), a[0], b[0]) for a in rows for b in rows if a[0] < b[0])
    sets = Sets(r[0] for r in rows)
    return [(a, b, math.sqrt(d)) for d, a, b in pairs if sets.join(a, b)]


def found_tree(model):
    return sorted(((r["distance"], r["a"], r["b"]) for r in model.edges.collect()))


@pytest.mark.parametrize(("n", "step"), [(1, None), (2, None), (60, None), (60, 3), (40, 1)])
@pytest.mark.parametrize("tile", [2000, 13])
def test_tree_and_cuts(spark, monkeypatch, n, step, tile):
    monkeypatch.setattr(linkage, "TILE_ROWS", tile)
    monkeypatch.setattr(linkage, "BLOCK_ROWS", 5)
    rows = points_of(n, n, step)
    model, tree = fit_single_linkage(frame(spark, rows), ["x", "y", "z"], "k"), plain_tree(rows)
    found = found_tree(model)
    assert [e[1:] for e in found] == [e[:2] for e in sorted(tree, key=lambda e: (e[2], e[0], e[1]))]
    assert [e[0] for e in found] == pytest.approx([e[2] for e in tree])
    for height in (0.0, 0.8, 10.0):
        sets = Sets(r[0] for r in rows)
        for a, b, d in tree:
            if d <= height:
                sets.join(a, b)
        assert {r["key"]: r["cluster"] for r in model.cut(height).collect()} == sets.named()
    for k in (1, 3, 100):
        sets = Sets(r[0] for r in rows)
        for a, b, _ in tree[: max(0, len(tree) - k + 1)]:
            sets.join(a, b)
        assert {r["key"]: r["cluster"] for r in model.cut_into(k).collect()} == sets.named()


def test_whatever_the_partitions(spark, monkeypatch):
    rows = points_of(5, 50, 4)
    whole = found_tree(fit_single_linkage(frame(spark, rows, 1), ["x", "y"], "k"))
    monkeypatch.setattr(linkage, "TILE_ROWS", 7)
    monkeypatch.setattr(module, "FEW_EDGES", 0)
    assert found_tree(fit_single_linkage(frame(spark, rows[::-1], 7), ["x", "y"], "k")) == whole


def test_invalid(spark):
    rows = points_of(6, 10)
    holes = frame(spark, [*rows, (900, None, 1.0, 1.0), (901, math.nan, 1.0, 1.0), (902, math.inf, 1.0, 1.0)])
    with pytest.raises(ValueError, match="nulls"):
        fit_single_linkage(holes, ["x"], "k")
    skipped = fit_single_linkage(holes, ["x", "y"], "k", handle_invalid="skip")
    assert found_tree(skipped) == found_tree(fit_single_linkage(frame(spark, rows), ["x", "y"], "k"))
    for bad in ([*rows, rows[0]], [*rows, (None, 1.0, 1.0, 1.0)]):
        with pytest.raises(ValueError, match="unique"):
            fit_single_linkage(frame(spark, bad), ["x"], "k")
    with pytest.raises(ValueError, match="no rows"):
        fit_single_linkage(frame(spark, rows).limit(0), ["x"], "k")
    with pytest.raises(ValueError, match="not found"):
        fit_single_linkage(frame(spark, rows), ["w"], "k")
    with pytest.raises(ValueError, match="cluster"):
        skipped.cut_into(0)


def test_names_that_clash(spark):
    rows = points_of(7, 30)
    odd = frame(spark, rows).selectExpr("k AS b", "x AS component", "y AS a", "1 AS x", "2 AS tile")
    assert found_tree(fit_single_linkage(odd, ["component", "a"], "b")) == found_tree(fit_single_linkage(frame(spark, rows), ["x", "y"], "k"))


@pytest.mark.parametrize("few", [100_000, 0])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(module, "FEW_EDGES", few)
    chosen = random.Random(few)
    edges = [(chosen.randrange(200), chosen.randrange(200)) for _ in range(90)] + [(300 + i, 301 + i) for i in range(40)] + [(9, 9)]
    sets = Sets({x for e in edges for x in e})
    for a, b in edges:
        sets.join(a, b)
    df = spark.createDataFrame(edges, "a bigint, b bigint").repartition(4)
    assert {r["node"]: r["component"] for r in connected(df).collect()} == sets.named()
    assert connected(df.limit(0)).count() == 0


def shaped(shape, n=110):
    chosen = random.Random(shape)
    if shape == "lines":  # on which tiles are of one component for rounds
        return [(7 * i + 3, chosen.randrange(200) / 16, float(i % 3), 0.0) for i in range(n)]
    if shape == "clusters":
        return [(7 * i + 3, *(100.0 * (i % 4 == 1) + chosen.gauss(0, 1) for _ in range(3))) for i in range(n)]
    return [(3 * i - 50, float(chosen.randrange(4)), -0.0 if i % 5 else 0.0, float(chosen.randrange(9))) for i in range(n)]


@pytest.mark.parametrize(("shape", "few"), [("lines", 1_000_000), ("clusters", 0), ("equal", 1_000_000)])
def test_tree_over_many_tiles(spark, monkeypatch, shape, few):
    for name, value in {"TILE_ROWS": 6, "REGION_TILES": 2, "LEAST_SAMPLED": 5, "BLOCK_ROWS": 4, "BATCH_PAIRS": 20, "BROADCAST_PARTS": few}.items():
        monkeypatch.setattr(linkage, name, value)
    rows = shaped(shape)
    model, tree = fit_single_linkage(frame(spark, rows), ["x", "y", "z"], "k"), plain_tree(rows)
    found = found_tree(model)
    assert [e[1:] for e in found] == [e[:2] for e in sorted(tree, key=lambda e: (e[2], e[0], e[1]))]
    assert [e[0] for e in found] == pytest.approx([e[2] for e in tree])


def test_points_ask_only_tiles_within_their_bound():
    side = 10  # a square of square tiles, one component each but in the last, which has two
    corners = np.array([(i, j) for i in range(side) for j in range(side)], float)
    tile, whole = np.arange(side * side), np.arange(side * side) < side * side - 1
    x = np.concatenate([corners + 0.5, corners + 0.99])
    own = np.tile(tile, 2)
    columns = [pa.array(own), pa.array(np.arange(len(x))), linkage._arrays(x), pa.array(own), pa.array(np.full(len(x), 0.16))]
    batch = pa.RecordBatch.from_arrays(columns, ["tile", "a", "x", "component", "bound"])
    first, *more = linkage._asked(batch, tile, corners, corners + 1, tile, whole, 64)
    assert first.num_rows == len(x) and not any(first.column("asked").to_pylist())
    asked = {(a, met) for b in more for a, met in zip(b.column("a").to_pylist(), b.column("met").to_pylist(), strict=True)}
    expected = set()  # points in the middle ask none, those in a corner the three tiles beyond it
    for t, (i, j) in enumerate(corners.astype(int).tolist()):
        expected |= {(side * side + t, u * side + v) for u in (i, i + 1) for v in (j, j + 1) if (u, v) != (i, j) and u < side and v < side}
    assert asked == expected


def test_components_of_a_chain_keep_their_size(spark, monkeypatch):
    monkeypatch.setattr(module, "FEW_EDGES", 20)
    ids = list(range(600))
    random.Random(4).shuffle(ids)
    edges = [(ids[i], ids[i + 1]) for i in range(599) if i % 200 != 199] + [(700, 700)]
    found = connected(spark.createDataFrame(edges, "a bigint, b bigint").repartition(3))
    least = {x: min(ids[i : i + 200]) for i in range(0, 600, 200) for x in ids[i : i + 200]} | {700: 700}
    assert {r["node"]: r["component"] for r in found.collect()} == least
    guessed = found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert guessed < 1e9  # that of joins of checkpoints gets more digits with every round
