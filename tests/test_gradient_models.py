"""Linear, logistic and support vector models against plain loops."""

import math
import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from colfit.functions import kernels
from colfit.functions.activations import IDENTITY, SIGMOID, SOFTMAX
from colfit.functions.losses import BCE, HINGE, MSE
from colfit.models import (
    LinearModel,
    LogisticModel,
    SVMModel,
    classify,
    fit_linear,
    fit_logistic,
    fit_svm,
)
from colfit.models.gradient import PER_FEATURE, fit_by_epochs
from colfit.operators import stats


def approx(values, tol=1e-9):
    return pytest.approx(values, abs=tol, nan_ok=True)


def sig(x):
    return 1 / (1 + math.exp(-x))


def mean(values):
    values = list(values)
    return sum(values) / len(values)


def loop(xs, y, epochs, rate, act=lambda v: v, loss="mse", shared=True, start=None, kernel=None):
    """Gradient descent row by row; ``xs`` is a list of feature columns."""
    k, n = len(xs), len(y)
    b, w = start or (0.0, [0.0] * k)
    w = list(w)
    for _ in range(epochs):
        p = [act(reduce(lambda s, j: s + xs[j][i] * w[j], range(k), b)) for i in range(n)]
        cols = xs if kernel is None else [[kernel(x[i], p[i]) for i in range(n)] for x in xs]
        if loss == "hinge":
            g0 = mean(1.0 if y[i] - p[i] > 0 else 0.0 for i in range(n))
            rows = range(min(n, k)) if kernel is None else [0] * k
            each = [-mean(cols[j]) if y[r] - p[r] > 0 else 0.0 for j, r in enumerate(rows)]
        else:
            scale = {"mse": -2.0, "bce": -1.0}[loss]
            g0 = -2.0 * mean(y[i] - p[i] for i in range(n))
            each = [scale * mean((y[i] - p[i]) * c[i] for i in range(n)) for c in cols]
        if shared and kernel is None:
            each = [mean(each)] * k
        each += [0.0] * (k - len(each))
        b -= rate * g0
        w = [w[j] - rate * each[j] for j in range(k)]
    return b, w


@pytest.fixture
def data(table):
    def make(xs, y):
        names = [f"f{j}" for j in range(len(xs))]
        return table(**dict(zip(names, xs, strict=True)), target=y), names

    return make


X = [[1.0, 2.0, 3.0, 4.0, 5.0], [0.5, -1.0, 2.0, 0.0, 1.5], [2.0, 2.0, -1.0, 0.5, 0.0]]
Y = [1.0, 0.0, 1.0, 0.0, 1.0]


def same(model, expected, tol=1e-9):
    assert model.intercept == approx(expected[0], tol)
    assert list(model.coefficients) == approx(expected[1], tol)


# ---- linear ---------------------------------------------------------------


@pytest.mark.parametrize(
    ("xs", "y", "epochs", "rate", "intercept", "weights", "r2"),
    [
        ([[1, 2, 3]], [10, 20, 30], 1000, 0.1, 0, [10], 1),
        ([[1, 2, 3]] * 2, [10, 20, 30], 10000, 0.01, 0, [5, 5], 1),
        ([[1, 2, 3, 4, 5]], [10, 25, 50, 56, 50], 10000, 0.01, 4.9, [11.1], 0.787384969),
        ([[1, 2, 3, 4, 5]] * 2, [10, 25, 50, 56, 50], 10000, 0.01, 4.9, [5.55] * 2, 0.787384969),
    ],
)
def test_linear_goldens(data, xs, y, epochs, rate, intercept, weights, r2):
    df, names = data(xs, y)
    model = fit_linear(df, names, "target", epochs, rate)
    same(model, (intercept, weights), 1e-6)
    assert model.accuracy(df).first()[0] == approx(r2)
    total = model.predict(df).agg(F.sum("prediction")).first()[0]
    assert total == approx(sum(y), 1e-6)


@pytest.mark.parametrize("gradient", ["shared", PER_FEATURE])
def test_linear_equals_loop(data, gradient):
    df, names = data(X, Y)
    expected = loop(X, Y, 30, 0.05, shared=gradient == "shared")
    same(fit_linear(df, names, "target", 30, 0.05, gradient=gradient), expected)


@pytest.mark.parametrize("gradient", ["shared", PER_FEATURE])
def test_linear_warm_start(data, gradient):
    df, names = data(X, Y)
    start = LinearModel(tuple(names), "target", 0.3, (0.1, -0.2, 0.4))
    fitted = fit_linear(df, names, "target", 7, 0.05, gradient=gradient, warm_start=start)
    same(fitted, loop(X, Y, 7, 0.05, shared=gradient == "shared", start=(0.3, [0.1, -0.2, 0.4])))
    again = fit_linear(df, names, "target", 7, 0.05, gradient=gradient)
    same(again, loop(X, Y, 7, 0.05, shared=gradient == "shared"))


@pytest.mark.parametrize("gradient", ["shared", PER_FEATURE])
@pytest.mark.parametrize("loss", [BCE, HINGE])
def test_linear_other_losses(data, loss, gradient):
    df, names = data(X, Y)
    name = {BCE: "bce", HINGE: "hinge"}[loss]
    model = fit_linear(
        df, names, "target", 4, 0.05, loss=loss, gradient=gradient, order_by=["row_id"]
    )
    same(model, loop(X, Y, 4, 0.05, loss=name, shared=gradient == "shared"))


def test_linear_hinge_fewer_rows_than_features(data):
    xs = [[1.0, 2.0], [3.0, -1.0], [0.5, 0.25]]
    df, names = data(xs, [1.0, 0.0])
    for gradient in ("shared", PER_FEATURE):
        model = fit_linear(
            df, names, "target", 3, 0.1, loss=HINGE, gradient=gradient, order_by=["row_id"]
        )
        expected = loop(xs, [1.0, 0.0], 3, 0.1, loss="hinge", shared=gradient == "shared")
        same(model, expected)


def test_per_feature_one_feature_is_least_squares(data):
    df, names = data(X[:1], [3.0, 5.0, 4.0, 8.0, 9.0])
    model = fit_linear(df, names, "target", 5000, 0.05, gradient=PER_FEATURE)
    slope, intercept = df.agg(
        F.regr_slope("target", "f0"), F.regr_intercept("target", "f0")
    ).first()
    same(model, (intercept, [slope]), 1e-8)


def test_wide_features(spark):
    """Many features, by one matrix product per task and by epochs alike."""
    rng = random.Random(5)
    k, n = 70, 200
    rows = [[rng.uniform(-1, 1) for _ in range(k)] for _ in range(n)]
    y = [sum(r) / k + rng.random() for r in rows]
    names = [f"f{i}" for i in range(k)]
    schema = ", ".join(f"{c} double" for c in [*names, "target"])
    df = spark.createDataFrame([(*r, t) for r, t in zip(rows, y, strict=True)], schema).repartition(3)
    expected = loop([list(c) for c in zip(*rows, strict=True)], y, 4, 0.05, shared=False)
    same(fit_linear(df, names, "target", 4, 0.05, gradient=PER_FEATURE), expected)
    model = LinearModel(tuple(names), "target", 0.0, (0.0,) * k)
    by_epochs = fit_by_epochs(model, df, 4, 0.05, (), PER_FEATURE, "error")
    same(by_epochs, expected)


@pytest.mark.parametrize("few", [16, 0])
def test_wide_means_leave_nulls_out(table, monkeypatch, few):
    monkeypatch.setattr(stats, "FEW_AVERAGES", few)
    df = table(a=[1.0, None, 3.0], b=[None, None, None], c=[float("nan"), 1.0, 2.0])
    means = stats.wide_means(df, [F.col(c) for c in "abc"])
    assert means[:2] == [2.0, None] and math.isnan(means[2])
    assert stats.wide_means(df.limit(0), [F.col("a")]) == [None]


def test_key_may_be_one_name(data):
    df, names = data(X, Y)
    df = df.withColumn("id", F.monotonically_increasing_id())
    by_name = fit_svm(df, names, "target", 2, 0.1, order_by="id")
    assert by_name == fit_svm(df, names, "target", 2, 0.1, order_by=["id"])


def test_linear_r2_of_constant_label(data):
    df, names = data([[1, 2]], [3, 3])
    assert LinearModel(("f0",), "target", 0.0, (1.0,)).accuracy(df).first()[0] == 1.0


def test_linear_gradients_and_loss(data):
    df, names = data(X, Y)
    model = LinearModel(tuple(names), "target", 0.2, (0.1, 0.3, -0.1))
    p = [0.2 + 0.1 * a + 0.3 * b - 0.1 * c for a, b, c in zip(*X, strict=True)]
    each = [-2 * mean((y - q) * x for y, q, x in zip(Y, p, col, strict=True)) for col in X]
    g0, shared = model.gradients(df)
    assert g0 == approx(-2 * mean(y - q for y, q in zip(Y, p, strict=True)))
    assert list(shared) == approx([mean(each)] * 3)
    assert list(model.gradients(df, gradient=PER_FEATURE)[1]) == approx(each)
    squares = [(y - q) ** 2 for y, q in zip(Y, p, strict=True)]
    assert model.loss(df).first()[0] == approx(mean(squares))


# ---- logistic -------------------------------------------------------------


@pytest.mark.parametrize("gradient", ["shared", PER_FEATURE])
@pytest.mark.parametrize(("loss", "name"), [(BCE, "bce"), (MSE, "mse"), (HINGE, "hinge")])
def test_logistic_equals_loop(data, loss, name, gradient):
    df, names = data(X, Y)
    model = fit_logistic(
        df, names, "target", 5, 0.1, loss=loss, gradient=gradient, order_by=["row_id"]
    )
    same(model, loop(X, Y, 5, 0.1, sig, name, gradient == "shared"))


def test_logistic_warm_start_continues(data):
    df, names = data(X, Y)
    half = fit_logistic(df, names, "target", 3, 0.1, gradient=PER_FEATURE)
    whole = fit_logistic(df, names, "target", 6, 0.1, gradient=PER_FEATURE)
    rest = fit_logistic(df, names, "target", 3, 0.1, gradient=PER_FEATURE, warm_start=half)
    same(rest, (whole.intercept, list(whole.coefficients)))
    shared = fit_logistic(df, names, "target", 3, 0.1, warm_start=half)
    same(shared, loop(X, Y, 3, 0.1, sig, "bce", start=(half.intercept, half.coefficients)))


@pytest.mark.parametrize(
    ("xs", "y", "epochs", "rate", "intercept", "weight", "accuracy", "loss"),
    [
        ([[1, 2, 3]], [0, 1, 1], 1000, 0.1, -6.001733256, 4.144661627, 1, 0.081122577),
        ([[1, 3, 2]] * 2, [1, 0, 1], 10000, 0.01, 8.367237186, -1.711906576, 1, 0.114603388),
        ([[1, 2, 3, 4, 5]], [0, 1, 1, 0, 1], 10000, 0.01, -0.87418542, 0.439272524, 0.8, None),
        ([[1, 3, 2, 4, 5]] * 2, [1, 0, 1, 0, 1], 10**4, 0.01, 1.759688178, -0.219431984, 0.4, None),
    ],
)
def test_logistic_goldens(data, xs, y, epochs, rate, intercept, weight, accuracy, loss):
    """The full epoch counts run on the loop, scoring on Spark."""
    b, w = loop([list(map(float, x)) for x in xs], y, epochs, rate, sig, "bce")
    assert (b, w) == (approx(intercept, 1e-8), approx([weight] * len(xs), 1e-8))
    df, names = data(xs, y)
    model = LogisticModel(tuple(names), "target", b, tuple(w))
    assert model.accuracy(df).first()[0] == approx(accuracy)
    if loss is not None:
        assert model.loss(df).first()[0] == approx(loss, 1e-8)


def test_classify(column, values):
    df = column([0.2, 0.5, 0.50001, math.nan, None])
    result = values(df.select("row_id", classify(F.col("x")).alias("x")))
    assert result == [0, 0, 1, 0, None]
    assert values(df.select("row_id", classify(F.col("x"), 0.1).alias("x")))[:3] == [1, 1, 1]


# ---- support vector machine -------------------------------------------------


@pytest.mark.parametrize(
    ("kernel", "function"),
    [
        (kernels.IDENTITY, lambda x, p: x),
        (kernels.LINEAR, lambda x, p: x * p),
        (kernels.Polynomial(1, 2), lambda x, p: (x * p + 1) ** 2),
        (kernels.RadialBasis(0.5), lambda x, p: math.exp(-0.5 * (x - p) ** 2)),
    ],
)
@pytest.mark.parametrize(("loss", "name"), [(HINGE, "hinge"), (MSE, "mse"), (BCE, "bce")])
def test_svm_equals_loop(data, kernel, function, loss, name):
    df, names = data(X, Y)
    for activation, act in ((IDENTITY, lambda v: v), (SIGMOID, sig)):
        model = fit_svm(
            df, names, "target", 4, 0.03, ["row_id"],
            loss=loss, kernel=kernel, activation=activation,
        )
        same(model, loop(X, Y, 4, 0.03, act, name, kernel=function))


def test_svm_softmax_activation(data, values):
    df, names = data([[0.0, 1.0]], [1.0, 0.0])
    model = fit_svm(df, names, "target", 1, 0.1, ["row_id"], activation=SOFTMAX)
    # Both scores are 0, so both predictions are 1/2; row 0 opens the gate.
    same(model, (-0.05, [0.05]))
    total = math.exp(-0.05) + math.exp(0.0)
    assert values(model.predict(df), "prediction") == approx(
        [math.exp(-0.05) / total, math.exp(0.0) / total]
    )


@pytest.mark.parametrize(
    ("xs", "y", "epochs", "rate", "intercept", "weights", "accuracy"),
    [
        ([[1, 2, 3]], [0, 1, 1], 1000, 0.1, -0.9, [1.0], 1.0),
        ([[1, 2, 3]] * 2, [0, 1, 1], 10000, 0.01, -0.97, [0.5, 0.5], 1.0),
        ([[1, 2, 3]] * 2, [1, 1, 0], 10000, 0.01, -0.143333, [0.58, 0.58], 1.0),
    ],
)
def test_svm_goldens(data, xs, y, epochs, rate, intercept, weights, accuracy):
    columns = [list(map(float, x)) for x in xs]
    b, w = loop(columns, y, epochs, rate, loss="hinge", kernel=lambda x, p: x)
    assert b == approx(intercept, 1e-6)
    assert w == approx(weights, 1e-6)
    df, names = data(xs, y)
    fitted = fit_svm(df, names, "target", 1, rate, ["row_id"])
    model = fitted.with_parameters(b, w)
    assert model.accuracy(df).first()[0] == approx(accuracy)


def test_svm_order_is_the_key_not_the_rows(data):
    df, names = data(X, Y)
    first = fit_svm(df, names, "target", 5, 0.1, ["row_id"])
    again = fit_svm(
        df.orderBy(F.col("row_id").desc()).coalesce(1), names, "target", 5, 0.1, ["row_id"]
    )
    same(again, (first.intercept, list(first.coefficients)))


def test_svm_loss_and_gradients(data):
    df, names = data(X, Y)
    model = fit_svm(df, names, "target", 1, 0.1, ["row_id"]).with_parameters(0.1, (0.1, 0.0, 0.2))
    p = [0.1 + 0.1 * a + 0.2 * c for a, _, c in zip(*X, strict=True)]
    assert model.loss(df).first()[0] == approx(
        sum(max(0, 1 - y * q) for y, q in zip(Y, p, strict=True))
    )
    g0, g = model.gradients(df, ["row_id"])
    assert g0 == approx(mean(1.0 if y - q > 0 else 0.0 for y, q in zip(Y, p, strict=True)))
    assert list(g) == approx([-mean(x) for x in X])


def test_svm_hinge_needs_key(data):
    df, names = data(X, Y)
    with pytest.raises(ValueError, match="order_by"):
        fit_svm(df, names, "target", 1, 0.1)


# ---- inputs -------------------------------------------------------------------


FITS = [
    lambda df, **k: fit_linear(df, ["f0"], "target", 3, 0.1, **k),
    lambda df, **k: fit_linear(df, ["f0"], "target", 3, 0.1, gradient=PER_FEATURE, **k),
    lambda df, **k: fit_logistic(df, ["f0"], "target", 3, 0.1, **k),
    lambda df, **k: fit_logistic(df, ["f0"], "target", 3, 0.1, gradient=PER_FEATURE, **k),
    lambda df, **k: fit_svm(df, ["f0"], "target", 3, 0.1, ["row_id"], **k),
]


@pytest.mark.parametrize("fit", FITS)
def test_nulls_raise_or_are_skipped(data, fit):
    df, _ = data([[1, None, 3, 4]], [1, 0, None, 0])
    clean, _ = data([[1, 4]], [1, 0])
    with pytest.raises(ValueError, match="nulls"):
        fit(df)
    skipped, expected = fit(df, handle_invalid="skip"), fit(clean)
    same(skipped, (expected.intercept, list(expected.coefficients)))
    with pytest.raises(ValueError, match="handle_invalid"):
        fit(df, handle_invalid="keep")


@pytest.mark.parametrize("fit", FITS)
def test_no_rows_and_missing_columns(data, fit):
    df, _ = data([[]], [])
    with pytest.raises(ValueError, match="no rows"):
        fit(df)
    with pytest.raises(ValueError, match="not found"):
        fit(df.drop("target"))


@pytest.mark.parametrize("kind", [LinearModel, LogisticModel, SVMModel])
def test_gradients_of_no_rows(data, kind):
    df, names = data([[]], [])
    with pytest.raises(ValueError, match="no rows"):
        kind(tuple(names), "target", 0.0, (0.0,)).gradients(df, ["row_id"])


def test_predict_null_and_integers(spark):
    df = spark.createDataFrame([(1, 1), (2, None)], "row_id int, f0 int")
    model = LinearModel(("f0",), "target", 0.5, (2.5,))
    assert [r.prediction for r in model.predict(df).orderBy("row_id").collect()] == [3.0, None]


def test_result_does_not_depend_on_partitions(data):
    df, names = data(X, Y)
    one = fit_logistic(df.coalesce(1), names, "target", 5, 0.1)
    many = fit_logistic(df.repartition(8), names, "target", 5, 0.1)
    same(many, (one.intercept, list(one.coefficients)))


def test_nothing_stays_cached(data, spark):
    df, names = data(X, Y)
    fit_logistic(df, names, "target", 2, 0.1)
    fit_svm(df, names, "target", 2, 0.1, ["row_id"])
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_parameters_as_rows(spark):
    model = LinearModel(("a", "b"), "y", 1.0, (2.0, 3.0))
    assert [tuple(r) for r in model.to_df(spark).collect()] == [
        ("intercept", 1.0),
        ("a", 2.0),
        ("b", 3.0),
    ]


def test_scores_a_stream(spark, tmp_path, data):
    df, names = data(X, Y)
    path = str(tmp_path / "rows")
    df.write.parquet(path)
    model = fit_linear(df, names, "target", 5, 0.05)
    stream = model.predict(spark.readStream.schema(df.schema).parquet(path))
    query = stream.writeStream.format("memory").queryName("scored").start()
    query.processAllAvailable()
    query.stop()
    streamed = {r.row_id: r.prediction for r in spark.table("scored").collect()}
    assert streamed == {r.row_id: r.prediction for r in model.predict(df).collect()}
