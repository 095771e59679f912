"""Activations, kernels and losses."""

from __future__ import annotations

from pyspark.sql import functions as F

from colfit.functions import kernels, losses
from colfit.functions.activations import IDENTITY, RELU, SIGMOID, Activation, LeakyReLU
from colfit.functions.kernels import Kernel
from colfit.functions.losses import BCE, HINGE, MSE, Loss
from colfit.operators import softmax, softmax_columns, softmax_jacobian
from colfit.plans.registry import number, query, rounded, rounded_sql, with_ctes
from colfit.plans.views import (
    CLS_SQL,
    ORD_FEATURES,
    ORD_SQL,
    REG_FEATURES,
    REG_SQL,
    cls,
    orders,
    reg,
    table,
)

_EVENT_SQL = "SELECT event_id, {} AS {} FROM (SELECT event_id, (value - 100)/50 AS x FROM events)"


def _event_values(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", ((F.col("value") - 100) / 50).alias("x")
    )


def _activation(name: str, activation: Activation, sql: str) -> None:
    @query(f"act_{name}", _EVENT_SQL.format(rounded_sql(sql), "activated_values"))
    def run(spark, folder):
        return _event_values(spark, folder).select(
            "event_id", rounded(activation.activate(F.col("x"))).alias("activated_values")
        )


def _activation_gradient(name: str, activation: Activation, sql: str) -> None:
    @query(f"grad_{name}", _EVENT_SQL.format(rounded_sql(sql), "gradients"))
    def run(spark, folder):
        return _event_values(spark, folder).select(
            "event_id", rounded(activation.gradient(F.col("x"))).alias("gradients")
        )


_SIGMOID = "(1/(1 + exp(-x)))"
_LEAK = number(0.1)

_activation("identity", IDENTITY, "x")
_activation_gradient("identity", IDENTITY, number(1.0))
_activation("sigmoid", SIGMOID, _SIGMOID)
_activation_gradient("sigmoid", SIGMOID, f"{_SIGMOID} * (1 - {_SIGMOID})")
_activation("relu", RELU, "greatest(x, 0)")
_activation_gradient("relu", RELU, "CASE WHEN x > 0 THEN 1 ELSE 0 END")
_activation("lrelu", LeakyReLU(0.1), f"CASE WHEN x > 0 THEN x ELSE {_LEAK} * x END")
_activation_gradient("lrelu", LeakyReLU(0.1), f"CASE WHEN x > 0 THEN 1 ELSE {_LEAK} END")


@query(
    "act_softmax",
    "SELECT event_id, "
    + rounded_sql("1000 * exp(value/100) / sum(exp(value/100)) OVER (PARTITION BY event_type)")
    + " AS activated_values FROM events",
)
def _act_softmax(spark, folder):
    values = table(spark, folder, "events").select(
        "event_id", "event_type", (F.col("value") / 100).alias("x")
    )
    return softmax(values, "x", ["event_type"]).select(
        "event_id", rounded(F.col("activated_values") * 1000).alias("activated_values")
    )


@query(
    "act_softmax_column",
    "SELECT event_id, "
    + rounded_sql("1000 * exp(value/100) / (SELECT sum(exp(value/100)) FROM events)")
    + " AS activated_values FROM events",
)
def _act_softmax_column(spark, folder):
    values = table(spark, folder, "events").select(
        "event_id", (F.col("value") / 100).alias("x")
    )
    return softmax(values, "x").select(
        "event_id", rounded(F.col("activated_values") * 1000).alias("activated_values")
    )


def _jacobian_sql() -> str:
    cells = [
        f"s{i} * (1 - s{i})" if i == j else f"-s{i} * s{j}" for i in range(3) for j in range(3)
    ]
    shares = ", ".join(f"exp(x{i} - m) / t AS s{i}" for i in range(3))
    return with_ctes(
        [
            REG_SQL,
            "top AS (SELECT *, greatest(x0, x1, x2) AS m FROM reg)",
            "tot AS (SELECT *, exp(x0 - m) + exp(x1 - m) + exp(x2 - m) AS t FROM top)",
            f"shares AS (SELECT l_orderkey, l_linenumber, {shares} FROM tot)",
        ],
        "SELECT l_orderkey, l_linenumber, "
        + ", ".join(f"{rounded_sql(c)} AS gradients_{i}" for i, c in enumerate(cells))
        + " FROM shares",
    )


@query("grad_softmax", _jacobian_sql())
def _grad_softmax(spark, folder):
    """The 3x3 Jacobian of each line item's feature vector, row by row."""
    rows = softmax_jacobian(reg(spark, folder), REG_FEATURES)
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        *[rounded(f"gradients_{i}").alias(f"gradients_{i}") for i in range(9)],
    )


def _share_sql() -> str:
    scale = "(exp(x0) + exp(x1) + exp(x2))"
    shares = ", ".join(f"{rounded_sql(f'exp(x{i}) / {scale}')} AS x{i}" for i in range(3))
    return with_ctes([REG_SQL], f"SELECT l_orderkey, l_linenumber, {shares} FROM reg")


@query("act_softmax_row", _share_sql())
def _act_softmax_row(spark, folder):
    rows = softmax_columns(reg(spark, folder), REG_FEATURES)
    return rows.select(
        "l_orderkey", "l_linenumber", *[rounded(x).alias(x) for x in REG_FEATURES]
    )


def _kernel(name: str, kernel: Kernel, sql: str) -> None:
    @query(
        f"kernel_{name}",
        with_ctes(
            [REG_SQL], f"SELECT l_orderkey, l_linenumber, {rounded_sql(sql)} AS kernel FROM reg"
        ),
    )
    def run(spark, folder):
        return reg(spark, folder).select(
            "l_orderkey",
            "l_linenumber",
            rounded(kernel.apply(F.col("x0"), F.col("x1"))).alias("kernel"),
        )


_kernel("identity", kernels.IDENTITY, "x0")
_kernel("linear", kernels.LINEAR, "x0 * x1")
_kernel("polynomial", kernels.Polynomial(2.0, 2.0), "pow(x0*x1 + 2, 2)")
_kernel("rbf", kernels.RadialBasis(2.0), "exp(-2 * (x0 - x1) * (x0 - x1))")


# Predictions the losses are tried on: (view, features, Spark column, SQL).
_REG = (reg, REG_FEATURES, lambda: F.lit(0.1) + F.col("x0") * 0.3, REG_SQL, "reg")
_CLS = (
    cls,
    REG_FEATURES,
    lambda: SIGMOID.activate(F.col("x0") - 0.5),
    CLS_SQL,
    "cls",
)
_ORD = (orders, ORD_FEATURES, lambda: F.col("x0") - 0.3, ORD_SQL, "ord")
_PREDICTION_SQL = {
    "reg": f"{number(0.1)} + x0 * {number(0.3)}",
    "cls": f"1/(1 + exp(-(x0 - {number(0.5)})))",
    "ord": f"x0 - {number(0.3)}",
}


def _scored_sql(view, select: str) -> str:
    _, _, _, sql, name = view
    return with_ctes(
        [sql, f"t AS (SELECT *, {_PREDICTION_SQL[name]} AS p FROM {name})"],
        f"SELECT {select} FROM t",
    )


def _loss(name: str, loss: Loss, view, sql: str, gradient_sql: str | None, shift_sql: str):
    load, features, prediction, _, _ = view
    scored = (lambda s, f: load(s, f).withColumn("p", prediction()))
    y, p = F.col, F.col

    @query(f"loss_{name}", _scored_sql(view, f"{rounded_sql(sql)} AS loss"))
    def run_loss(spark, folder):
        return scored(spark, folder).agg(rounded(loss.loss(y("y"), p("p"))).alias("loss"))

    @query(
        f"{name}_intercept_gradient",
        _scored_sql(view, f"{rounded_sql(shift_sql)} AS gradient"),
    )
    def run_intercept(spark, folder):
        return scored(spark, folder).agg(
            rounded(loss.intercept_gradient(y("y"), p("p"))).alias("gradient")
        )

    if gradient_sql is None:
        return
    select = ", ".join(
        f"{rounded_sql(gradient_sql.format(x=x))} AS gradient_{x}" for x in features
    )

    @query(f"{name}_gradient", _scored_sql(view, select))
    def run_gradient(spark, folder):
        columns = loss.gradient([F.col(x) for x in features], y("y"), p("p"))
        return scored(spark, folder).agg(
            *[rounded(g).alias(f"gradient_{x}") for g, x in zip(columns, features, strict=True)]
        )


_loss("mse", MSE, _REG, "avg((y - p)*(y - p))", "-2 * avg((y - p)*{x})", "-2 * avg(y - p)")
_loss(
    "bce",
    BCE,
    _CLS,
    "-avg(y*ln(p) + (1 - y)*ln(1 - p))",
    "avg((p - y)*{x})",
    "-2 * avg(y - p)",
)
_loss(
    "hinge",
    HINGE,
    _ORD,
    "sum(greatest(1 - y*p, 0))",
    None,
    "avg(CASE WHEN y - p > 0 THEN 1.0 ELSE 0.0 END)",
)

_FIRST = "row_number() OVER (ORDER BY o_orderkey)"
_ORD_MARGIN = f"t AS (SELECT *, y - (x0 - {number(0.3)}) AS margin, {_FIRST} AS rn FROM ord)"


@query(
    "hinge_gradient",
    with_ctes(
        [ORD_SQL, _ORD_MARGIN],
        "SELECT "
        + rounded_sql(
            "CASE WHEN max(CASE WHEN rn = 1 THEN margin END) > 0 THEN -avg(x0) ELSE 0 END"
        )
        + " AS gradient_x0 FROM t",
    ),
)
def _hinge_gradient(spark, folder):
    """Mean gradient of one column, decided by the first row."""
    rows = orders(spark, folder)
    p = F.col("x0") - 0.3
    values = losses.hinge_gradient(
        rows, {"gradient_x0": F.col("x0")}, F.col("y"), p, ["o_orderkey"]
    )
    return values.agg(rounded(F.avg("gradient_x0")).alias("gradient_x0"))


@query(
    "hinge_gradient_values",
    with_ctes(
        [
            ORD_SQL,
            _ORD_MARGIN,
            "g AS (SELECT max(CASE WHEN rn = 1 THEN margin END) AS g0, "
            "max(CASE WHEN rn = 2 THEN margin END) AS g1 FROM t)",
        ],
        "SELECT o_orderkey, "
        + ", ".join(
            f"CASE WHEN g{i} > 0 THEN -x{i} ELSE 0 END + 0.0 AS gradient_x{i}"
            for i in range(2)
        )
        + " FROM t, g",
    ),
)
def _hinge_gradient_values(spark, folder):
    """Gradient values of two columns: row i decides column i."""
    rows = orders(spark, folder)
    values = losses.hinge_gradient(
        rows,
        {f"gradient_{x}": F.col(x) for x in ORD_FEATURES},
        F.col("y"),
        F.col("x0") - 0.3,
        ["o_orderkey"],
    )
    return values.select(
        "o_orderkey",
        *[(F.col(f"gradient_{x}") + 0.0).alias(f"gradient_{x}") for x in ORD_FEATURES],
    )


