import math

import pytest
from pyspark.sql import functions as F

from colfit.functions.activations import IDENTITY, RELU, SIGMOID, SOFTMAX, LeakyReLU
from colfit.functions.losses import BCE, HINGE, MSE
from colfit.models import ColumnNetwork, Layer, Network, layer_random, layer_zeroes, positions
from colfit.models.layers import layer_backward, layer_forward


def approx(values, tol=1e-9):
    return pytest.approx(values, abs=tol, nan_ok=True)


def sig(x):
    return 1 / (1 + math.exp(-x))


ACTS = {
    IDENTITY: lambda v: v,
    SIGMOID: lambda v: [sig(x) for x in v],
    RELU: lambda v: [max(x, 0.0) for x in v],
    LeakyReLU(0.1): lambda v: [x if x > 0 else 0.1 * x for x in v],
    SOFTMAX: lambda v: [math.exp(x) / sum(map(math.exp, v)) for x in v],
}


class Plain:
    """One sample, lists only: layers are (weights, biases, activation)."""

    def __init__(self, layers, loss):
        self.layers, self.loss = layers, loss

    def layer(self, i, x):
        w, b, act = self.layers[i]
        dot = sum(a * c for a, c in zip(x, w, strict=True))
        return ACTS[act]([dot + c for c in b])

    def forward(self, x):
        for i in range(len(self.layers)):
            x = self.layer(i, x)
        return x

    def updated(self, x, y, rate):
        gaps = [a - p for a, p in zip(y, self.forward(x), strict=True)]
        if self.loss == HINGE:
            down = [sum(g > 0 for g in gaps) / len(gaps)]
        else:
            down = [-2 * sum(gaps) / len(gaps)]
        layers = []
        for i in reversed(range(len(self.layers))):
            w, b, act = self.layers[i]
            below = x if i == 0 else self.layer(i - 1, x)
            g = down * len(w) if len(down) == 1 else down
            shift = sum(down)
            w = [a - c * d * rate for a, c, d in zip(w, below, g, strict=True)]
            layers.append((w, [a - shift * rate for a in b], act))
            down = w
        return Plain(layers[::-1], self.loss)

    def fit(self, x, y, epochs, rate):
        network = self
        for _ in range(epochs):
            network = network.updated(x, y, rate)
        return network


@pytest.fixture
def layer(spark):
    def make(weights, biases):
        rows = [(i, float(w), float(b)) for i, (w, b) in enumerate(zip(weights, biases))]
        return spark.createDataFrame(rows, "pos bigint, weight double, bias double")

    return make


@pytest.fixture
def vec(spark):
    def make(x, label=None, **more):
        columns = {"value": x, **({"label": label} if label else {}), **more}
        rows = [(i, *map(float, r)) for i, r in enumerate(zip(*columns.values(), strict=True))]
        return spark.createDataFrame(
            rows, "pos bigint, " + ", ".join(f"{c} double" for c in columns)
        )

    return make


def read(df, *names):
    rows = df.orderBy("pos").collect()
    return [[r[n] for r in rows] for n in names] if len(names) > 1 else [r[names[0]] for r in rows]


# ---- layers -------------------------------------------------------------------


def test_layer_zeroes(spark):
    assert read(layer_zeroes(positions(spark, 3)), "pos", "weight", "bias") == [[0, 1, 2], [0] * 3, [0] * 3]


def test_layer_random(spark):
    first = layer_random(positions(spark, 5), (1.0, -1.0), 3)
    weights, biases = read(first, "weight", "bias")
    assert len(weights) == 5
    assert all(-1 <= v <= 1 for v in weights + biases)
    assert len(set(weights + biases)) == 10
    again = layer_random(positions(spark, 50), (-1.0, 1.0), 3).filter("pos < 5")
    assert read(again, "weight", "bias") == [weights, biases]
    assert read(layer_random(positions(spark, 5), (-1.0, 1.0), 4), "weight") != weights


def test_layer_forward(layer, vec):
    out = layer_forward(layer([1, 2, 3], [4, 5, 6]), vec([7, 8, 9]), SIGMOID)
    assert read(out, "value") == approx([sig(54), sig(55), sig(56)])
    out = layer_forward(layer([0.1, 0.2, 0.3], [0.4, 0.5, 0.6]), vec([1, 2, 3]), SOFTMAX)
    assert read(out, "value") == approx(ACTS[SOFTMAX]([1.8, 1.9, 2.0]))


def test_layer_backward(layer, vec):
    start = layer([1, 2, 3], [4, 5, 6])
    new = layer_backward(start, vec([7, 8, 9], g=[2, 2, 2]), "g", 0.01)
    weights, biases = read(new, "weight", "bias")
    assert weights == approx([0.86, 1.84, 2.82])
    assert biases == approx([3.94, 4.94, 5.94])
    weights, biases = read(layer_backward(start, vec([7, 8, 9]), 2.0, 0.01), "weight", "bias")
    assert weights == approx([0.86, 1.84, 2.82])
    assert biases == approx([3.98, 4.98, 5.98])


def test_positions_must_match(layer, vec, spark):
    good = layer([1, 2, 3], [4, 5, 6])
    for bad in (
        vec([1, 2]),
        vec([1, 2, 3, 4]),
        vec([1, 2, 3]).withColumn("pos", F.col("pos") + 1),
        vec([1, 2, 3]).withColumn("pos", F.lit(0).cast("bigint")),
    ):
        with pytest.raises(ValueError, match="unique positions"):
            layer_forward(good, bad, SIGMOID)
    with pytest.raises(ValueError, match="null"):
        null = vec([1, 2, 3]).withColumn("value", F.when(F.col("pos") > 0, F.col("value")))
        layer_forward(good, null, SIGMOID)
    with pytest.raises(ValueError, match="not found"):
        layer_forward(good, vec([1, 2, 3]).drop("pos"), SIGMOID)


# ---- building -------------------------------------------------------------------


def test_building_networks(layer):
    table = layer([1], [2])
    empty = ColumnNetwork()
    assert (len(empty.layers), empty.loss_function) == (0, MSE)
    added = empty.add_layer(table, SIGMOID)
    assert (len(empty.layers), len(added.layers)) == (0, 1)
    changed = added.set_layer(0, layer([1, 2, 3, 4], [0] * 4), RELU)
    assert changed.layers[0].count() == 4
    assert (added.activations, changed.activations) == ((SIGMOID,), (RELU,))
    assert len(ColumnNetwork((table,) * 3, (SIGMOID,) * 3).layers) == 3
    with pytest.raises(ValueError, match="activations"):
        ColumnNetwork((table,), ())
    with pytest.raises(IndexError):
        added.set_layer(1, table, RELU)

    small = Layer((1.0,), (2.0,), SIGMOID)
    network = Network().add_layer(small)
    assert network.set_layer(0, Layer((3.0,), (2.0,), RELU)).layers[0].activation == RELU
    with pytest.raises(IndexError):
        network.set_layer(1, small)
    with pytest.raises(ValueError, match="biases"):
        Layer((1.0, 2.0), (1.0,), RELU)
    with pytest.raises(ValueError, match="width"):
        network.add_layer(Layer((1.0, 2.0), (1.0, 2.0), RELU))


def test_no_layers(vec, spark):
    assert read(ColumnNetwork().forward(vec([1, 2])), "value") == [1, 2]
    df = spark.createDataFrame([([1.0, 2.0],)], "x array<double>")
    assert Network().forward(df, "x").first()["output"] == [1.0, 2.0]


# ---- forward --------------------------------------------------------------------


BIG = [([1, 2, 3], [4, 5, 6], SIGMOID)] * 3
SMALL = [
    ([0.1, -0.2, 0.3], [0.2, -0.1, 0.05], SIGMOID),
    ([0.5, 0.4, -0.6], [-0.3, 0.1, 0.2], LeakyReLU(0.1)),
    ([-0.2, 0.7, 0.3], [0.1, 0.0, -0.4], SIGMOID),
]
SOFT = [
    ([0.1, -0.2, 0.3], [0.2, -0.1, 0.05], SOFTMAX),
    ([0.5, 0.4, -0.6], [-0.3, 0.1, 0.2], SOFTMAX),
]
ONE = [([0.3, 0.1, -0.5], [0.1, 0.2, 0.3], IDENTITY)]
X, Y = [0.5, -1.0, 2.0], [0.3, 0.9, 0.1]


def column_network(layer, layers, loss=MSE):
    return ColumnNetwork(
        tuple(layer(w, b) for w, b, _ in layers), tuple(a for _, _, a in layers), loss
    )


def row_network(layers, loss=MSE):
    return Network(
        tuple(Layer(tuple(map(float, w)), tuple(map(float, b)), a) for w, b, a in layers), loss
    )


def test_forward_golden(layer, vec):
    out = column_network(layer, BIG).forward(vec([1, 2, 3]))
    assert read(out, "value") == approx([0.999954598, 0.999983297, 0.999993855])


@pytest.mark.parametrize("layers", [BIG, SMALL, SOFT, ONE])
def test_forward_both_forms(spark, layer, vec, layers):
    expected = Plain(layers, MSE).forward(X)
    assert read(column_network(layer, layers).predict(vec(X)), "value") == approx(expected)
    samples = [(0, X), (1, [1.0, 1.0, 1.0]), (2, None)]
    df = spark.createDataFrame(samples, "id int, x array<double>")
    rows = row_network(layers).forward(df, "x").orderBy("id").collect()
    assert rows[0]["output"] == approx(expected)
    assert rows[1]["output"] == approx(Plain(layers, MSE).forward([1.0] * 3))
    assert rows[2]["output"] is None


def test_array_of_wrong_length(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "x array<double>")
    with pytest.raises(Exception, match="expected an array of 3 values"):
        row_network(SMALL).forward(df, "x").collect()


def test_exploding_the_output_stays_cheap(spark):
    """A filter inferred by explode must not multiply the layers."""
    df = spark.createDataFrame([(X,)], "x array<double>")
    deep = row_network(SMALL * 4).forward(df, "x").select(F.posexplode("output"))
    plan = deep._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("zip_with") <= 3 * 12
    assert deep.count() == 3


# ---- training -------------------------------------------------------------------


def check_layers(got, expected):
    for (w, b), (ew, eb, _) in zip(got, expected, strict=True):
        assert list(w) == approx(ew)
        assert list(b) == approx(eb)


def column_parameters(network):
    return [read(t, "weight", "bias") for t in network.layers]


def test_fit_golden(layer, vec):
    data = vec([1, 2, 3], [1, 2, 3])
    fitted = column_network(layer, BIG).fit(data, 1, 1e-4)
    expected = [
        ([0.999900010, 1.999600040, 2.999100090], [3.999400060, 4.999400060, 5.999400060], None),
        ([0.999899980, 1.999799980, 2.999699980], [3.999399940, 4.999399940, 5.999399940], None),
        ([1.000200005, 2.000200005, 3.000200005], [4.000200005, 5.000200005, 6.000200005], None),
    ]
    check_layers(column_parameters(fitted), expected)


@pytest.mark.parametrize("loss", [MSE, BCE, HINGE])
@pytest.mark.parametrize("layers", [SMALL, SOFT, ONE])
def test_fit_column_form(layer, vec, layers, loss):
    data = vec(X, Y)
    expected = Plain(layers, loss).fit(X, Y, 2, 0.1).layers
    fitted = column_network(layer, layers, loss).fit(data, 2, 0.1)
    check_layers(column_parameters(fitted), expected)


@pytest.mark.parametrize("loss", [MSE, BCE, HINGE])
@pytest.mark.parametrize("layers", [SMALL, SOFT, ONE])
def test_fit_one_sample_equals_column_form(spark, layers, loss):
    df = spark.createDataFrame([(X, Y)], "x array<double>, y array<double>")
    expected = Plain(layers, loss).fit(X, Y, 2, 0.1).layers
    fitted = row_network(layers, loss).fit(df, "x", "y", 2, 0.1)
    check_layers([(la.weights, la.biases) for la in fitted.layers], expected)


def test_fit_averages_samples(spark):
    samples = [(X, Y), ([1.0, 0.0, -1.0], [0.2, 0.2, 0.8]), ([0.1, 0.2, 0.3], [1.0, 0.0, 0.5])]
    df = spark.createDataFrame(samples, "x array<double>, y array<double>").repartition(3)
    each = [Plain(SMALL, MSE).updated(x, y, 0.1).layers for x, y in samples]
    expected = [
        tuple([sum(v) / 3 for v in zip(*[e[i][k] for e in each], strict=True)] for k in (0, 1))
        + (None,)
        for i in range(3)
    ]
    fitted = row_network(SMALL).fit(df, "x", "y", 1, 0.1)
    check_layers([(la.weights, la.biases) for la in fitted.layers], expected)
    with pytest.raises(ValueError, match="no samples"):
        row_network(SMALL).fit(df.limit(0), "x", "y", 1, 0.1)


def test_backward_with_given_outputs(layer, vec):
    network = column_network(layer, SMALL)
    outputs = Plain(SMALL, MSE).forward(X)
    same = network.backward(vec(X, Y), 0.1)
    given = network.backward(vec(X, Y, out=outputs), 0.1, output="out")
    assert column_parameters(given) == [
        [approx(w), approx(b)] for w, b in column_parameters(same)
    ]
    check_layers(column_parameters(same), Plain(SMALL, MSE).updated(X, Y, 0.1).layers)


def test_fit_returns_a_new_network(layer, vec):
    network = column_network(layer, SMALL)
    network.fit(vec(X, Y), 1, 0.1)
    check_layers(column_parameters(network), SMALL)
    assert network.fit(vec(X, Y), 0, 0.1) is network


def test_plan_does_not_grow_with_epochs(layer, vec):
    network = column_network(layer, SMALL)
    lengths = [
        len(network.fit(vec(X, Y), n, 0.01).layers[0]._jdf.queryExecution().toString())
        for n in (1, 4)
    ]
    assert abs(lengths[0] - lengths[1]) < 200


# ---- evaluation -----------------------------------------------------------------


@pytest.mark.parametrize("loss", [MSE, BCE, HINGE])
def test_loss_swaps_arguments(spark, layer, vec, loss):
    p = Plain(SMALL, loss).forward(X)
    if loss == MSE:
        expected = sum((a - b) ** 2 for a, b in zip(p, Y, strict=True)) / 3
    elif loss == HINGE:
        expected = sum(max(0, 1 - a * b) for a, b in zip(p, Y, strict=True))
    else:
        terms = [a * math.log(b) + (1 - a) * math.log(1 - b) for a, b in zip(p, Y, strict=True)]
        expected = -sum(terms) / 3
    assert column_network(layer, SMALL, loss).loss(vec(X, Y)).first()[0] == approx(expected)
    df = spark.createDataFrame([(X, Y)] * 4, "x array<double>, y array<double>")
    assert row_network(SMALL, loss).loss(df, "x", "y").first()[0] == approx(expected)


def test_accuracy_counts_equal_values(spark, layer, vec):
    layers = [([0.0] * 3, [1.0, 2.0, 3.0], IDENTITY)]
    target = [1.0, 2.5, 3.0]
    assert column_network(layer, layers).accuracy(vec(X, target)).first()[0] == approx(2 / 3)
    df = spark.createDataFrame([(X, target)], "x array<double>, y array<double>")
    assert row_network(layers).accuracy(df, "x", "y").first()[0] == approx(2 / 3)


def test_nothing_stays_cached(layer, vec, spark):
    network = column_network(layer, SMALL)
    network.fit(vec(X, Y), 2, 0.1).forward(vec(X)).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0
