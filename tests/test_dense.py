"""Dense networks against numeric differentiation and plain loops."""

import random
from dataclasses import replace

import numpy as np
import pytest

from colfit.functions.activations import IDENTITY, SIGMOID, SOFTMAX, LeakyReLU, ReLU
from colfit.functions.uniform import uniform_value
from colfit.models import Adam, DenseLayer, DenseNetwork, Descent, dense, random_layer, zero_layer
from colfit.models.dense import CROSS_ENTROPY, HINGE, SQUARED

FEATURES = ("a", "b", "c")


def rows_of(seed, n):
    chosen = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = (round(chosen.gauss(0, 1), 3) for _ in range(3))
        y = float(a - b + chosen.gauss(0, 0.3) > 0)
        out.append((i, a, b, c, y, 1.0 - y, round(0.5 * a + b * b, 3)))
    return out


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, "key bigint, a double, b double, c double, y double, z double, v double").repartition(parts)


def network(kinds, labels, loss, seed=1):
    sizes = [3, *(4 - i for i in range(len(kinds) - 1)), len(labels)]
    layers = [random_layer(m, n, kind, seed, k) for k, (m, n, kind) in enumerate(zip(sizes, sizes[1:], kinds, strict=False))]
    return DenseNetwork(FEATURES, labels, tuple(layers), loss)


CASES = [
    ((IDENTITY,), ("v",), SQUARED),
    ((SIGMOID, IDENTITY), ("v", "y"), SQUARED),
    ((SIGMOID, LeakyReLU(0.1), SIGMOID), ("y", "z"), SQUARED),
    ((SIGMOID, SIGMOID, SIGMOID), ("y", "z"), CROSS_ENTROPY),
    ((ReLU(), SOFTMAX), ("y", "z"), CROSS_ENTROPY),
    ((SIGMOID, IDENTITY), ("y",), HINGE),
]


def plain_loss(net, rows):
    """Mean loss, one row and one unit at a time."""
    names = ["key", "a", "b", "c", "y", "z", "v"]
    total = 0.0
    for row in rows:
        values = [row[names.index(f)] for f in net.features]
        for layer in net.layers:
            sums = [sum(w * x for w, x in zip(ws, values, strict=True)) + b for ws, b in zip(layer.weights, layer.biases, strict=True)]
            if layer.activation == SOFTMAX:
                values = [np.exp(s) / sum(np.exp(sums)) for s in sums]
            else:
                values = [layer.activation.value(s) for s in sums]
        ys = [row[names.index(c)] for c in net.labels]
        if net.loss_function == SQUARED:
            total += sum((p - y) ** 2 for p, y in zip(values, ys, strict=True)) / len(ys)
        elif net.loss_function == HINGE:
            total += sum(max(0.0, 1 - (2 * y - 1) * p) for p, y in zip(values, ys, strict=True)) / len(ys)
        elif net.layers[-1].activation == SOFTMAX:
            total -= sum(y * np.log(p) for p, y in zip(values, ys, strict=True))
        else:
            total -= sum(y * np.log(p) + (1 - y) * np.log(1 - p) for p, y in zip(values, ys, strict=True)) / len(ys)
    return total / len(rows)


@pytest.mark.parametrize(("kinds", "labels", "loss"), CASES)
def test_gradients_agree_with_differences(spark, kinds, labels, loss):
    rows = rows_of(1, 40)
    net = network(kinds, labels, loss)
    found, flat, step = net.gradients(frame(spark, rows)).flat(), net.flat(), 1e-6
    for i in range(len(flat)):
        up, down = flat.copy(), flat.copy()
        up[i] += step
        down[i] -= step
        assert found[i] == pytest.approx((plain_loss(net.with_flat(up), rows) - plain_loss(net.with_flat(down), rows)) / (2 * step), abs=2e-6)
    assert net.loss(frame(spark, rows)).first()[0] == pytest.approx(plain_loss(net, rows))


def plain_fit(net, rows, epochs, optimiser, batches=None, lanes=1, seed=0):
    """Numpy on all rows, lane after lane."""
    names = ["key", "a", "b", "c", "y", "z", "v"]
    x = np.array([[r[names.index(f)] for f in net.features] for r in rows])
    y = np.array([[r[names.index(c)] for c in net.labels] for r in rows])
    keys = [r[0] for r in rows]
    shapes, kinds = dense._shapes(net), [layer.activation for layer in net.layers]
    weights = np.concatenate([np.repeat([True, False], [n * m, n]) for n, m in shapes])
    values, first, second, t = net.flat(), np.zeros(len(net.flat())), np.zeros(len(net.flat())), 0

    def step(values, first, second, t, chosen):
        g = dense.back_propagated(dense._matrices(values, shapes), kinds, net.loss_function, x[chosen], y[chosen]) / len(chosen)
        g = g + np.where(weights, optimiser.l2 * values, 0)
        if isinstance(optimiser, Adam):
            first = optimiser.beta1 * first + (1 - optimiser.beta1) * g
            second = optimiser.beta2 * second + (1 - optimiser.beta2) * g**2
            g = first / (1 - optimiser.beta1**t) / (np.sqrt(second / (1 - optimiser.beta2**t)) + optimiser.epsilon)
        values = values - optimiser.rate * g
        near = np.sign(values) * np.maximum(abs(values) - optimiser.rate * optimiser.l1, 0)
        return np.where(weights, near, values), first, second

    for epoch in range(epochs):
        if not batches:
            t += 1
            values, first, second = step(values, first, second, t, range(len(rows)))
            continue
        ends = []
        for lane in range(lanes):
            own = [i for i, k in enumerate(keys) if int(uniform_value(0, lanes, seed, "lane", k)) == lane]
            end = (values, first, second, t)
            for b in range(batches):
                chosen = [i for i in own if int(uniform_value(0, batches, seed, "batch", epoch, keys[i])) == b]
                if chosen:
                    end = (*step(*end[:3], end[3] + 1, chosen), end[3] + 1)
            if own:
                ends.append(end)
        values, first, second = (np.mean([e[i] for e in ends], axis=0) for i in range(3))
        t = max(e[3] for e in ends)
    return values


@pytest.mark.parametrize(
    ("kinds", "labels", "loss", "optimiser"),
    [(*c, Descent(0.2, l1=0.01, l2=0.05)) for c in CASES[:3]] + [(*c, Adam(0.03, l1=0.01, l2=0.05)) for c in CASES[2:]],
)
def test_fit_equals_plain(spark, kinds, labels, loss, optimiser):
    rows, net = rows_of(2, 60), network(kinds, labels, loss)
    fitted = net.fit(frame(spark, rows), 3, optimiser)
    assert fitted.flat() == pytest.approx(plain_fit(net, rows, 3, optimiser), abs=1e-12)


@pytest.mark.parametrize("optimiser", [Descent(0.2, l1=0.01), Adam(0.03, l2=0.05)])
@pytest.mark.parametrize(("batches", "lanes"), [(1, 1), (4, 3), (50, 7)])
def test_mini_batches_equal_plain(spark, optimiser, batches, lanes):
    rows, net = rows_of(3, 120), network((SIGMOID, SIGMOID), ("y",), CROSS_ENTROPY)
    fitted = net.fit(frame(spark, rows), 2, optimiser, batches=batches, lanes=lanes, key="key", seed=4)
    assert fitted.flat() == pytest.approx(plain_fit(net, rows, 2, optimiser, batches, lanes, 4), abs=1e-12)


def test_whatever_the_partitions(spark, monkeypatch):
    rows, net = rows_of(4, 300), network((SIGMOID, IDENTITY), ("v",), SQUARED)
    options = {"batches": 6, "lanes": 3, "key": "key"}
    found = [net.fit(frame(spark, r, parts), 2, Adam(0.01), **options) for r, parts in ((rows, 1), (rows[::-1], 8))]
    assert (found[0].flat() == found[1].flat()).all()  # to the last digit
    monkeypatch.setattr(dense, "ROWS_AT_ONCE", 7)
    assert net.fit(frame(spark, rows), 2, Adam(0.01), **options).flat() == pytest.approx(found[0].flat(), abs=1e-12)


@pytest.mark.parametrize("options", [{}, {"batches": 4, "lanes": 2, "key": "key"}])
def test_state_is_carried(spark, options):
    rows, net = frame(spark, rows_of(5, 80)), network((SIGMOID, SIGMOID), ("y",), CROSS_ENTROPY)
    once = net.fit(rows, 4, Adam(0.05), **options)
    twice = net.fit(rows, 1, Adam(0.05), **options).fit(rows, 3, Adam(0.05), **options)
    assert twice.flat() == pytest.approx(once.flat(), abs=1e-12)
    assert twice.state.steps == once.state.steps and twice.state.epochs == 4
    forgotten = replace(net.fit(rows, 1, Adam(0.05), **options), state=dense.OptimiserState()).fit(rows, 3, Adam(0.05), **options)
    assert np.abs(forgotten.flat() - once.flat()).max() > 1e-3
    with pytest.raises(ValueError, match="another optimiser"):
        once.fit(rows, 1, Descent(0.1))


def test_l1_gives_exact_zeros(spark):
    rows = frame(spark, rows_of(6, 200))
    plain = DenseNetwork(FEATURES, ("v",), (zero_layer(3),), SQUARED).fit(rows, 200, Descent(0.1))
    lasso = DenseNetwork(FEATURES, ("v",), (zero_layer(3),), SQUARED).fit(rows, 200, Descent(0.1, l1=0.5))
    assert all(plain.layers[0].weights[0])
    assert lasso.layers[0].weights[0][2] == 0.0 and lasso.layers[0].weights[0][0] > 0
    ridge = DenseNetwork(FEATURES, ("v",), (zero_layer(3),), SQUARED).fit(rows, 200, Descent(0.1, l2=1.0))
    assert 0 < ridge.layers[0].weights[0][0] < plain.layers[0].weights[0][0]


def test_learns(spark):
    rows = frame(spark, rows_of(7, 400))
    for net in (
        network((SIGMOID, SIGMOID), ("y",), CROSS_ENTROPY),
        network((LeakyReLU(0.1), SOFTMAX), ("y", "z"), CROSS_ENTROPY),
        DenseNetwork(FEATURES, ("y",), (zero_layer(3),), HINGE),
    ):
        fitted = net.fit(rows, 4, Adam(0.1), batches=20, lanes=2, key="key")
        assert fitted.accuracy(rows).first()[0] > 0.9
        assert fitted.loss(rows).first()[0] < net.loss(rows).first()[0]


def test_invalid_rows_and_networks(spark):
    rows = rows_of(8, 20)
    holes = frame(spark, [*rows, (90, None, 1.0, 1.0, 1.0, 0.0, 0.0), (91, 1.0, 1.0, 1.0, None, 0.0, 0.0), (None, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0)])
    net = network((SIGMOID, SIGMOID), ("y",), CROSS_ENTROPY)
    with pytest.raises(ValueError, match="nulls"):
        net.fit(holes, 1, Descent(0.1))
    skipped = net.fit(holes, 2, Descent(0.1), batches=2, key="key", handle_invalid="skip")
    assert skipped == net.fit(frame(spark, rows), 2, Descent(0.1), batches=2, key="key")
    outputs = {r["key"]: r["output"] for r in net.predict(holes).collect()}
    assert outputs[90] is None and 0 < outputs[91][0] < 1
    with pytest.raises(ValueError, match="no rows"):
        net.fit(holes.limit(0), 1, Descent(0.1))
    with pytest.raises(ValueError, match="key"):
        net.fit(holes, 1, Descent(0.1), batches=2)
    with pytest.raises(ValueError, match="not found"):
        net.fit(holes, 1, Descent(0.1), batches=2, key="nothing")
    assert net.loss(holes.limit(0)).first()[0] is None
    for layers, labels, loss in (
        ((), ("y",), SQUARED),
        ((zero_layer(2),), ("y",), SQUARED),
        ((zero_layer(3),), ("y", "z"), SQUARED),
        ((zero_layer(3),), ("y",), CROSS_ENTROPY),
        ((zero_layer(3, 2, SOFTMAX), zero_layer(2)), ("y",), SQUARED),
        ((zero_layer(3, 1, SIGMOID),), ("y",), HINGE),
    ):
        with pytest.raises(ValueError):
            DenseNetwork(FEATURES, labels, layers, loss)
    with pytest.raises(ValueError):
        DenseLayer(((1.0,), (1.0, 2.0)), (0.0, 0.0))


def test_names_that_clash_and_repeated_keys(spark):
    rows = rows_of(9, 60)
    net = network((SIGMOID, SIGMOID), ("y",), CROSS_ENTROPY)
    options = {"batches": 3, "lanes": 2}
    plain = net.fit(frame(spark, rows), 2, Descent(0.2), key="key", **options)
    odd = frame(spark, rows).selectExpr("a AS x", "b AS lane", "c AS `missing`", "y AS batch", "key AS found", "1 AS key", "2 AS pos")
    other = replace(net, features=("x", "lane", "missing"), labels=("batch",)).fit(odd, 2, Descent(0.2), key="found", **options)
    assert other.layers == plain.layers
    twice = net.fit(frame(spark, rows + rows), 2, Descent(0.2), key="key", **options)
    assert twice.flat() == pytest.approx(plain.flat(), abs=1e-12)  # means stay the same
