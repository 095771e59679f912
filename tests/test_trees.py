"""Trees and forests against a plain recursive version, and their edge cases."""

import math
import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from colfit.functions.uniform import uniform_value
from colfit.models import CLASSIFICATION, REGRESSION, fit_forest, fit_tree, tree
from colfit.models.tree import POISSON, equal_edges, node_features

UNIT = 1e-3


def rows_of(seed, n, kind):
    chosen = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = (round(chosen.uniform(-2, 2), 2) for _ in range(3))
        if kind == CLASSIFICATION:
            y = float(chosen.choice([0, 1, 2]) if chosen.random() < 0.2 else (a > 0.3) + (b > 0) * (a <= 0.3))
        else:
            y = round(math.sin(a) + (b > 0.5) + chosen.gauss(0, 0.1), 3)
        out.append((i, a, b, c, y))
    return out


def purity(ys, kind):
    if kind == CLASSIFICATION:
        return Fraction(sum(v * v for v in Counter(ys).values()), len(ys))
    return Fraction(sum(ys) ** 2, len(ys))


def plain_tree(rows, edges, kind, depth, least_rows, allowed):
    """``node: (feature, threshold, rows, value)`` of rows ``(features, y, times)``, grown one node after the other."""
    out = {}

    def grow(node, rows, left):
        ys = [y for _, y, times in rows for _ in range(times)]
        if kind == CLASSIFICATION:
            value = min(Counter(ys).items(), key=lambda x: (-x[1], x[0]))[0] if ys else 0.0
        else:
            value = sum(ys) / len(ys) * UNIT if ys else 0.0
        best = None
        if left and ys:
            for f in allowed(node):
                for e in edges[f]:
                    parts = [[y for x, y, times in rows for _ in range(times) if (x[f] >= e) == side] for side in (False, True)]
                    if min(map(len, parts)) < max(1, least_rows):
                        continue
                    score = sum(purity(p, kind) for p in parts)
                    if best is None or score > best[0]:
                        best = (score, f, e)
            if best and not best[0] > purity(ys, kind) * Fraction(1 + tree.LEAST_GAIN):
                best = None
        out[node] = (best[1] if best else None, best[2] if best else None, len(ys), value)
        if best:
            grow(2 * node, [r for r in rows if not r[0][best[1]] >= best[2]], left - 1)
            grow(2 * node + 1, [r for r in rows if r[0][best[1]] >= best[2]], left - 1)

    grow(1, rows, depth)
    return out


def plain_predict(nodes, x):
    node = 1
    while nodes[node][0] is not None:
        node = 2 * node + (x[nodes[node][0]] >= nodes[node][1])
    return nodes[node][3]


def edges_of(rows, bins):
    return [equal_edges(min(r[i] for r in rows), max(r[i] for r in rows), bins) for i in (1, 2, 3)]


def whole(y, kind):
    return y if kind == CLASSIFICATION else int(np.rint(y / UNIT))


def found_nodes(spark, model):
    names = list(model.features)
    found = {}
    for r in model.to_df(spark).collect():
        feature = None if r["feature"] is None else names.index(r["feature"])
        found.setdefault(r["tree"], {})[r["node"]] = (feature, r["threshold"], r["rows"], r["value"])
    return found


def same(found, expected):
    assert set(found) == {n for n, e in expected.items() if e[2]}
    for node, (feature, threshold, rows, value) in expected.items():
        if rows:
            assert found[node][:3] == (feature, threshold, rows)
            assert found[node][3] == pytest.approx(value, abs=1e-12)


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "key bigint, a double, b double, c double, y double").repartition(parts)


@pytest.mark.parametrize("kind", [CLASSIFICATION, REGRESSION])
@pytest.mark.parametrize(("depth", "least_rows"), [(0, 1), (4, 1), (4, 15)])
def test_tree_equals_plain(spark, kind, depth, least_rows):
    rows = rows_of(depth, 250, kind)
    model = fit_tree(frame(spark, rows), ["a", "b", "c"], "y", kind, depth=depth, bins=8, least_rows=least_rows, resolution=UNIT)
    plain = plain_tree([(r[1:4], whole(r[4], kind), 1) for r in rows], edges_of(rows, 8), kind, depth, least_rows, lambda n: range(3))
    same(found_nodes(spark, model)[0], plain)
    predicted = {r["key"]: r["prediction"] for r in model.predict(frame(spark, rows)).collect()}
    assert predicted == pytest.approx({r[0]: plain_predict(plain, r[1:4]) for r in rows})


@pytest.mark.parametrize("kind", [CLASSIFICATION, REGRESSION])
def test_forest_equals_plain_loop(spark, kind):
    rows, seed, trees, depth = rows_of(5, 200, kind), 3, 4, 3
    model = fit_forest(
        frame(spark, rows), ["a", "b", "c"], "y", kind, key="key", trees=trees, features_per_node=2, seed=seed, depth=depth, bins=8, resolution=UNIT
    )
    found, plain = found_nodes(spark, model), []
    for t in range(trees):
        drawn = [(r[1:4], whole(r[4], kind), sum(uniform_value(0, 1, seed, "row", t, r[0]) >= c for c in POISSON)) for r in rows]
        plain.append(plain_tree(drawn, edges_of(rows, 8), kind, depth, 1, lambda n, t=t: node_features(seed, t, n, 3, 2)))
        same(found[t], plain[t])
    predicted = {r["key"]: r["prediction"] for r in model.predict(frame(spark, rows)).collect()}
    for r in rows:
        each = [plain_predict(p, r[1:4]) for p in plain]
        if kind == CLASSIFICATION:
            assert predicted[r[0]] == min(Counter(each).items(), key=lambda x: (-x[1], x[0]))[0]
        else:
            assert predicted[r[0]] == pytest.approx(sum(each) / trees)


def test_draws():
    drawn = Counter(sum(uniform_value(0, 1, 0, "row", 1, i) >= c for c in POISSON) for i in range(20_000))
    for k, n in drawn.items():
        assert n / 20_000 == pytest.approx(math.exp(-1) / math.factorial(k), abs=0.012)
    assert node_features(1, 0, 1, 5, 5) == [0, 1, 2, 3, 4]
    seen = {tuple(node_features(1, 0, n, 5, 2)) for n in range(200)}
    assert len(seen) == 10  # every pair comes up


@pytest.mark.parametrize("kind", [CLASSIFICATION, REGRESSION])
def test_whatever_the_partitions(spark, kind, monkeypatch):
    rows = rows_of(8, 400, kind)
    models = [
        fit_forest(frame(spark, chosen, parts), ["a", "b", "c"], "y", kind, key="key", trees=3, depth=4)
        for chosen, parts in ((rows, 1), (rows[::-1], 7), (rows, 16))
    ]
    assert models[0] == models[1] == models[2]
    monkeypatch.setattr(tree, "CELLS_AT_ONCE", 300)  # a few nodes a pass
    assert fit_forest(frame(spark, rows), ["a", "b", "c"], "y", kind, key="key", trees=3, depth=4) == models[0]


def test_ties_take_the_first_feature_and_bin(spark):
    rows = [(i, float(i), float(i), 0.0, float(i >= 5)) for i in range(10)]
    model = fit_tree(frame(spark, rows), ["b", "a", "c"], "y", depth=2, edges=[[4.5, 5.0], [4.5, 5.0], []])
    assert found_nodes(spark, model)[0][1][:2] == (0, 4.5)
    assert set(found_nodes(spark, model)[0]) == {1, 2, 3}  # pure leaves aren't split
    even = [(i, 1.0, 0.0, 0.0, float(i % 2)) for i in range(10)]
    assert found_nodes(spark, fit_tree(frame(spark, even), ["a"], "y"))[0] == {1: (None, None, 10, 0.0)}


def test_invalid_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1.0, nan, 0.0, 0.0), (1, 2.0, inf, 0.0, 1.0), (2, 3.0, -inf, 0.0, 0.0), (3, 4.0, 5.0, 0.0, 1.0)]
    holes = frame(spark, [*rows, (4, None, 1.0, 0.0, 1.0), (5, 1.0, 1.0, 0.0, None)])
    with pytest.raises(ValueError, match="nulls"):
        fit_tree(holes, ["a", "b"], "y")
    model = fit_tree(holes, ["a", "b"], "y", handle_invalid="skip", depth=3)
    assert model == fit_tree(frame(spark, rows), ["a", "b"], "y", depth=3)
    predicted = {r["key"]: r["prediction"] for r in model.predict(holes).collect()}
    assert predicted[4] is None and predicted[3] == 1.0
    by_b = fit_tree(frame(spark, rows), ["b"], "y", CLASSIFICATION, depth=1, edges=[[6.0]])
    assert {r["key"]: r["prediction"] for r in by_b.predict(frame(spark, rows)).collect()} == {0: 0.0, 1: 0.0, 2: 0.0, 3: 0.0}
    with pytest.raises(ValueError, match="finite"):
        fit_tree(frame(spark, [(0, 1.0, 1.0, 1.0, inf)]), ["a"], "y", REGRESSION)
    with pytest.raises(ValueError, match="no rows"):
        fit_tree(frame(spark, rows).limit(0), ["a"], "y")
    with pytest.raises(ValueError, match="classes"):
        fit_tree(frame(spark, [(i, 1.0, 1.0, 1.0, float(i)) for i in range(101)]), ["a"], "y")
    with pytest.raises(ValueError, match="not found"):
        fit_tree(frame(spark, rows), ["z"], "y")
    for wrong in ({"depth": 21}, {"bins": 1}, {"least_rows": 0}, {"edges": [[2.0, 1.0]]}):
        with pytest.raises(ValueError, match="need"):
            fit_tree(frame(spark, rows), ["a"], "y", **wrong)


def test_names_that_clash_and_repeated_rows(spark):
    rows = rows_of(2, 60, CLASSIFICATION)
    plain = fit_tree(frame(spark, rows), ["a", "b"], "y", depth=3)
    odd = frame(spark, rows).select(
        F.col("a").alias("bins"), F.col("b").alias("slot.s0"), F.col("y").alias("weights"), F.lit("x").alias("y"), F.lit(1).alias("f0"), F.lit(2).alias("key")
    )
    model = fit_tree(odd, ["bins", "slot.s0"], "weights", depth=3)
    assert model.trees == plain.trees
    assert model.accuracy(odd).first()[0] == plain.accuracy(frame(spark, rows)).first()[0]
    twice = fit_tree(frame(spark, rows + rows), ["a", "b"], "y", depth=3)
    assert [t.feature for t in twice.trees] == [t.feature for t in plain.trees]


def test_accuracy_of_values(spark):
    rows = rows_of(4, 300, REGRESSION)
    model = fit_tree(frame(spark, rows), ["a", "b", "c"], "y", REGRESSION, depth=6)
    assert 0.85 < model.accuracy(frame(spark, rows)).first()[0] < 1
    level = [(i, float(i), 0.0, 0.0, 2.5) for i in range(5)]
    constant = fit_tree(frame(spark, level), ["a"], "y", REGRESSION)
    assert constant.accuracy(frame(spark, level)).first()[0] == 1.0
    assert constant.accuracy(frame(spark, level).limit(0)).first()[0] is None
