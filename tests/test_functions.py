import math

import pytest
from pyspark.sql import functions as F

from colfit.functions import kernels, losses
from colfit.functions.activations import IDENTITY, RELU, SIGMOID, SOFTMAX, LeakyReLU
from colfit.functions.uniform import uniform_column, uniform_value

NAN, INF = math.nan, math.inf


def approx(values, tol=1e-9):
    return pytest.approx(values, abs=tol, nan_ok=True)


def sig(x):
    return 1 / (1 + math.exp(-x))


@pytest.mark.parametrize(
    ("activation", "inputs", "activated", "gradients"),
    [
        (IDENTITY, [1, 2, 3], [1, 2, 3], [1, 1, 1]),
        (
            SIGMOID,
            [1, 2, 3],
            [0.731058579, 0.880797078, 0.952574127],
            [sig(x) * (1 - sig(x)) for x in (1, 2, 3)],
        ),
        (SIGMOID, [-1000, 1000, NAN, INF], [0, 1, NAN, 1], [0, 0, NAN, 0]),
        (RELU, [-1, 2, -3], [0, 2, 0], [0, 1, 0]),
        (RELU, [NAN, INF, -INF, 0], [0, INF, 0, 0], [0, 1, 0, 0]),
        (LeakyReLU(0.1), [-1, 2, -3], [-0.1, 2, -0.3], [0.1, 1, 0.1]),
        (LeakyReLU(0.1), [NAN, 0], [NAN, 0], [0.1, 0.1]),
    ],
)
def test_activations(column, values, activation, inputs, activated, gradients):
    df = column(inputs)
    assert values(df.select("row_id", activation.activate(F.col("x")).alias("x"))) == approx(
        activated
    )
    assert values(df.select("row_id", activation.gradient(F.col("x")).alias("x"))) == approx(
        gradients
    )
    finite = [x for x in inputs if not math.isnan(x)]
    expected = [a for x, a in zip(inputs, activated, strict=True) if not math.isnan(x)]
    assert [activation.value(float(x)) for x in finite] == approx(expected)


def test_activations_keep_null(column, values):
    df = column([None])
    for activation in (IDENTITY, SIGMOID, RELU, LeakyReLU(0.1)):
        assert values(df.select("row_id", activation.activate(F.col("x")).alias("x"))) == [None]


def test_softmax_over_column(column, values):
    df = column([1, 2, 3])
    scored = df.withColumn("x", SOFTMAX.over_column(df, F.col("x")))
    assert values(scored) == approx([0.090030573, 0.244728471, 0.665240956])


def test_softmax_overflows_to_nan(column, values):
    df = column([1, 800])
    assert values(df.withColumn("x", SOFTMAX.over_column(df, F.col("x")))) == approx([0, NAN])


def test_softmax_underflow_is_nan(column, values):
    df = column([-800, -900])
    assert values(df.withColumn("x", SOFTMAX.over_column(df, F.col("x")))) == approx([NAN, NAN])


def test_softmax_array_and_jacobian(spark):
    row = (
        spark.createDataFrame([([1.0, 2.0, 3.0],)], "v array<double>")
        .select(
            SOFTMAX.activate_array(F.col("v")).alias("s"),
            SOFTMAX.gradient_array(F.col("v")).alias("g"),
        )
        .first()
    )
    assert row["s"] == approx([0.090030573, 0.244728471, 0.665240956])
    expected = [
        0.081925, -0.022033, -0.059892,
        -0.022033, 0.184836, -0.162803,
        -0.059892, -0.162803, 0.222695,
    ]
    assert row["g"] == approx(expected, 1e-6)


def test_softmax_jacobian_is_shifted(spark):
    df = spark.createDataFrame([([1000.0, 1000.0],)], "v array<double>")
    assert df.select(SOFTMAX.gradient_array(F.col("v"))).first()[0] == approx(
        [0.25, -0.25, -0.25, 0.25]
    )


def test_elementwise_arrays(spark):
    df = spark.createDataFrame([([-1.0, 2.0],)], "v array<double>")
    row = df.select(RELU.activate_array(F.col("v")), RELU.gradient_array(F.col("v"))).first()
    assert (row[0], row[1]) == ([0.0, 2.0], [0.0, 1.0])


@pytest.mark.parametrize(
    ("kernel", "x", "y", "expected"),
    [
        (kernels.IDENTITY, [1, 2, 3], [4, 5, 6], [1, 2, 3]),
        (kernels.LINEAR, [1, 2, 3], [1, 2, 3], [1, 4, 9]),
        (kernels.Polynomial(2, 2), [1, 2, 3], [1, 2, 3], [9, 36, 121]),
        (kernels.RadialBasis(2), [1, 2, 3], [3, 2, 1], [math.exp(-8), 1, math.exp(-8)]),
    ],
)
def test_kernels(table, values, kernel, x, y, expected):
    df = table(x=x, y=y)
    result = df.select("row_id", kernel.apply(F.col("x"), F.col("y")).alias("k"))
    assert values(result, "k") == approx(expected)


def aggregate(df, *columns):
    return list(df.agg(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first())


@pytest.mark.parametrize(
    ("loss", "y", "p", "expected"),
    [
        (losses.MSE, [1, 2, 3], [1, 2, 3], 0),
        (losses.MSE, [1, 2, 3], [4, 5, 6], 9),
        (losses.HINGE, [1, 2, 3], [1, 2, 3], 0),
        (losses.HINGE, [1, 1, 1], [1, 1, 0], 1),
        (losses.HINGE, [1, NAN], [0, 1], 1),
        (losses.BCE, [1, 0], [0.8, 0.3], -(math.log(0.8) + math.log(0.7)) / 2),
        (losses.BCE, [1, 0], [0, 0.5], INF),
        (losses.BCE, [1, 0], [1, 0.5], NAN),  # 0 * -inf
    ],
)
def test_losses(table, loss, y, p, expected):
    df = table(y=y, p=p)
    assert aggregate(df, loss.loss(F.col("y"), F.col("p"))) == approx([expected])


def test_mse_gradients(table):
    df = table(a=[1, 2, 3], b=[4, 5, 6], y=[1, 2, 3], p=[4, 5, 6])
    xs = [F.col("a"), F.col("b")]
    assert aggregate(df, *losses.MSE.gradient(xs, F.col("y"), F.col("p"))) == approx([12, 30])
    assert aggregate(df, *losses.MSE.gradient(xs, F.col("y"), F.col("y"))) == approx([0, 0])
    assert aggregate(df, losses.MSE.intercept_gradient(F.col("y"), F.col("p"))) == approx([6])


def test_bce_gradients(table):
    df = table(a=[1, 2], y=[1, 0], p=[0.8, 0.3])
    (gradient,) = losses.BCE.gradient([F.col("a")], F.col("y"), F.col("p"))
    shift = losses.BCE.intercept_gradient(F.col("y"), F.col("p"))
    # mean((p - y) * x), and twice mean(p - y).
    assert aggregate(df, gradient, shift) == approx([(-0.2 + 0.6) / 2, 2 * (-0.2 + 0.3) / 2])


def test_hinge_intercept_gradient_ignores_nan(table):
    df = table(y=[1, 0, NAN, 2], p=[0, 1, 0, 1])
    shift = losses.HINGE.intercept_gradient(F.col("y"), F.col("p"))
    assert aggregate(df, shift) == approx([0.5])


def test_hinge_gradient_row_gates_column(table, values):
    # Row 0 has a positive margin and opens column a; row 1 closes column b.
    df = table(a=[1, 2, 3], b=[4, 5, 6], y=[1, 0, 1], p=[0, 1, 0])
    xs = {"ga": F.col("a"), "gb": F.col("b")}
    result = losses.hinge_gradient(df, xs, F.col("y"), F.col("p"), ["row_id"])
    assert values(result, "ga") == [-1, -2, -3]
    assert values(result, "gb") == [0, 0, 0]


def test_hinge_gradient_fewer_rows_than_columns(table):
    df = table(a=[1], b=[4], y=[1], p=[0])
    xs = {"ga": F.col("a"), "gb": F.col("b")}
    result = losses.hinge_gradient(df, xs, F.col("y"), F.col("p"), ["row_id"])
    assert "ga" in result.columns
    assert "gb" not in result.columns


def test_hinge_gradient_needs_unique_key(table):
    df = table(a=[1, 1], y=[1, 0], p=[0, 1])
    with pytest.raises(ValueError, match="not unique"):
        losses.hinge_gates(df, F.col("y"), F.col("p"), ["a"], 1)
    with pytest.raises(ValueError, match="order_by"):
        losses.hinge_gates(df, F.col("y"), F.col("p"), [], 1)


def test_uniform_is_the_same_on_driver_and_executors(spark):
    df = spark.range(50).repartition(7)
    rows = df.select("id", uniform_column(-2, 3, 5, "w", F.col("id")).alias("u")).collect()
    for row in rows:
        assert row["u"] == pytest.approx(uniform_value(-2, 3, 5, "w", row["id"]), abs=1e-12)
        assert -2 <= row["u"] < 3
    assert len({row["u"] for row in rows}) == 50
