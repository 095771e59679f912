"""Linear, logistic and support vector models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colfit.functions.activations import SIGMOID
from colfit.functions.kernels import Polynomial, RadialBasis
from colfit.functions.losses import HINGE, MSE
from colfit.models import (
    LinearModel,
    LogisticModel,
    SVMModel,
    classify,
    fit_linear,
    fit_logistic,
    fit_svm,
)
from colfit.models.gradient import PER_FEATURE, SHARED
from colfit.operators import min_max_norm_cols
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
)


def _parameters(spark, model) -> DataFrame:
    return model.to_df(spark).select("term", rounded("value").alias("value"))


def _gradients(spark, model, gradients) -> DataFrame:
    g0, g = gradients
    terms = _parameters(spark, model.with_parameters(g0, g))
    return terms.withColumnRenamed("value", "gradient")


def _rows_sql(source: str, columns: Sequence[str], features: Sequence[str], value: str) -> str:
    """One row per term from the columns of a one-row CTE."""
    terms = ["intercept", *features]
    return " UNION ALL ".join(
        f"SELECT '{t}' AS term, {rounded_sql(c)} AS {value} FROM {source}"
        for t, c in zip(terms, columns, strict=True)
    )


def _score_sql(features: Sequence[str], intercept: str, weights: Sequence[str]) -> str:
    return " + ".join([intercept, *[f"{x}*{w}" for x, w in zip(features, weights, strict=True)]])


def _fixed_score(features: Sequence[str], intercept: float, weights: Sequence[float]) -> str:
    return _score_sql(features, number(intercept), [number(w) for w in weights])


def _sigmoid_sql(score: str) -> str:
    return f"1/(1 + exp(-({score})))"


# ---- linear ---------------------------------------------------------------

LINEAR = LinearModel(REG_FEATURES, "y", 0.1, (0.5, 0.1, -0.1))
_LINEAR_SQL = f"t AS (SELECT *, {_fixed_score(REG_FEATURES, 0.1, (0.5, 0.1, -0.1))} AS p FROM reg)"


def _moments_sql(view: str, features: Sequence[str]) -> str:
    k = range(len(features))
    parts = [f"avg({features[i]}) AS m{i}" for i in k]
    parts += [f"avg({features[i]}*{features[j]}) AS m{i}{j}" for i in k for j in k]
    parts += [f"avg({features[i]}*y) AS my{i}" for i in k] + ["avg(y) AS my"]
    return f"m AS (SELECT {', '.join(parts)} FROM {view})"


def _linear_fit_sql(cte: str, view: str, epochs: int, rate: float, shared: bool) -> str:
    """Gradient descent on the moments, one recursion step per epoch."""
    k = range(3)
    w = [f"w{i}" for i in k]
    each = [
        f"-2*(my{i} - b*m{i} - " + " - ".join(f"{w[j]}*m{i}{j}" for j in k) + ")" for i in k
    ]
    if shared:
        each = ["((" + ") + (".join(each) + "))/3"] * 3
    shift = "-2*(my - b - " + " - ".join(f"{w[j]}*m{j}" for j in k) + ")"
    lr = number(rate)
    zero = ", ".join(f"{number(0.0)} AS {n}" for n in ["b", *w])
    steps = ", ".join([f"b - {lr}*({shift})", *[f"{w[i]} - {lr}*({each[i]})" for i in k]])
    return with_ctes(
        [
            cte,
            _moments_sql(view, REG_FEATURES),
            f"gd AS (SELECT 0 AS e, {zero} UNION ALL "
            f"SELECT e + 1, {steps} FROM gd, m WHERE e < {epochs})",
            f"final AS (SELECT * FROM gd WHERE e = {epochs})",
        ],
        _rows_sql("final", ["b", *w], REG_FEATURES, "value"),
        recursive=True,
    )


@query("linear_fit", _linear_fit_sql(REG_SQL, "reg", 50, 0.2, True))
def _linear_fit(spark, folder):
    return _parameters(spark, fit_linear(reg(spark, folder), REG_FEATURES, "y", 50, 0.2))


@query("linear_fit_per_feature", _linear_fit_sql(REG_SQL, "reg", 50, 0.2, False))
def _linear_fit_per_feature(spark, folder):
    model = fit_linear(reg(spark, folder), REG_FEATURES, "y", 50, 0.2, gradient=PER_FEATURE)
    return _parameters(spark, model)


_NORM_SQL = (
    "SELECT "
    + ", ".join(
        f"({x} - min({x}) OVER ()) / (max({x}) OVER () - min({x}) OVER ()) AS {x}"
        for x in REG_FEATURES
    )
    + ", y FROM reg"
)


@query(
    "normalised_linear_fit",
    _linear_fit_sql(f"{REG_SQL}, norm AS ({_NORM_SQL})", "norm", 200, 0.1, True),
)
def normalised_linear_fit(spark, folder):
    """Line items, min-max normalised, then a linear fit: ``(term, value)``."""
    rows = reg(spark, folder).transform(min_max_norm_cols, REG_FEATURES)
    return _parameters(spark, fit_linear(rows, REG_FEATURES, "y", 200, 0.1))


_SHARED_MSE = "(" + " + ".join(f"-2*avg((y - p)*{x})" for x in REG_FEATURES) + ")/3"


@query(
    "linear_gradients",
    with_ctes(
        [REG_SQL, _LINEAR_SQL, f"g AS (SELECT -2*avg(y - p) AS g0, {_SHARED_MSE} AS g1 FROM t)"],
        _rows_sql("g", ["g0", "g1", "g1", "g1"], REG_FEATURES, "gradient"),
    ),
)
def _linear_gradients(spark, folder):
    return _gradients(spark, LINEAR, LINEAR.gradients(reg(spark, folder)))


_LINE_KEYS = ("l_orderkey", "l_linenumber")


def _predicted(model, df, keys) -> DataFrame:
    """Linear scores unrounded: both engines do the same operations in order."""
    return model.predict(df).select(*keys, (F.col("prediction") + 0.0).alias("prediction"))


@query(
    "linear_predict",
    with_ctes(
        [REG_SQL, _LINEAR_SQL],
        "SELECT l_orderkey, l_linenumber, p + 0.0 AS prediction FROM t",
    ),
)
def _linear_predict(spark, folder):
    return _predicted(LINEAR, reg(spark, folder), _LINE_KEYS)


@query(
    "linear_r2",
    with_ctes(
        [REG_SQL, _LINEAR_SQL, "a AS (SELECT avg(y) AS my FROM t)"],
        "SELECT "
        + rounded_sql("1 - sum((y - p)*(y - p)) / sum((y - my)*(y - my))")
        + " AS r2 FROM t, a",
    ),
)
def _linear_r2(spark, folder):
    return LINEAR.accuracy(reg(spark, folder)).select(rounded("r2").alias("r2"))


@query(
    "linear_loss",
    with_ctes(
        [REG_SQL, _LINEAR_SQL], f"SELECT {rounded_sql('avg((y - p)*(y - p))')} AS loss FROM t"
    ),
)
def _linear_loss(spark, folder):
    return LINEAR.loss(reg(spark, folder)).select(rounded("loss").alias("loss"))


# ---- logistic -------------------------------------------------------------

LOGISTIC = LogisticModel(REG_FEATURES, "y", -0.5, (0.2, 0.1, -0.1))
_LOGISTIC_SQL = (
    "t AS (SELECT *, "
    + _sigmoid_sql(_fixed_score(REG_FEATURES, -0.5, (0.2, 0.1, -0.1)))
    + " AS p FROM cls)"
)


def _epochs_sql(
    cte: str,
    view: str,
    features: Sequence[str],
    epochs: int,
    rate: float,
    prediction: str,
    shift: str,
    gradients: Sequence[str],
    extra: str = "",
) -> str:
    """One CTE per epoch; ``p`` is the prediction, ``extra`` more columns of the rows."""
    w = [f"w{i}" for i in range(len(features))]
    lr = number(rate)
    ctes = [cte, "e0 AS (SELECT " + ", ".join(f"{number(0.0)} AS {n}" for n in ["b", *w]) + ")"]
    for e in range(epochs):
        ctes.append(f"p{e} AS (SELECT *, {prediction} AS p{extra} FROM {view}, e{e})")
        steps = [f"any_value(b) - {lr}*({shift}) AS b"]
        steps += [
            f"any_value({n}) - {lr}*({g}) AS {n}" for n, g in zip(w, gradients, strict=True)
        ]
        ctes.append(f"e{e + 1} AS (SELECT {', '.join(steps)} FROM p{e})")
    return with_ctes(ctes, _rows_sql(f"e{epochs}", ["b", *w], features, "value"))


_SCORE3 = _score_sql(REG_FEATURES, "b", ["w0", "w1", "w2"])
_SHARED_BCE = "(" + " + ".join(f"avg((p - y)*{x})" for x in REG_FEATURES) + ")/3"


def _logistic_fit_sql(gradients: Sequence[str]) -> str:
    return _epochs_sql(
        CLS_SQL, "cls", REG_FEATURES, 3, 0.1, _sigmoid_sql(_SCORE3), "-2*avg(y - p)", gradients
    )


@query("logistic_fit", _logistic_fit_sql([_SHARED_BCE] * 3))
def _logistic_fit(spark, folder):
    return _parameters(spark, fit_logistic(cls(spark, folder), REG_FEATURES, "y", 3, 0.1))


@query(
    "logistic_fit_per_feature",
    _logistic_fit_sql([f"avg((p - y)*{x})" for x in REG_FEATURES]),
)
def _logistic_fit_per_feature(spark, folder):
    model = fit_logistic(cls(spark, folder), REG_FEATURES, "y", 3, 0.1, gradient=PER_FEATURE)
    return _parameters(spark, model)


@query(
    "logistic_fit_mse",
    _logistic_fit_sql(["(" + " + ".join(f"-2*avg((y - p)*{x})" for x in REG_FEATURES) + ")/3"] * 3),
)
def _logistic_fit_mse(spark, folder):
    model = fit_logistic(cls(spark, folder), REG_FEATURES, "y", 3, 0.1, loss=MSE)
    return _parameters(spark, model)


@query(
    "logistic_gradients",
    with_ctes(
        [
            CLS_SQL,
            _LOGISTIC_SQL,
            f"g AS (SELECT -2*avg(y - p) AS g0, {_SHARED_BCE} AS g1 FROM t)",
        ],
        _rows_sql("g", ["g0", "g1", "g1", "g1"], REG_FEATURES, "gradient"),
    ),
)
def _logistic_gradients(spark, folder):
    return _gradients(spark, LOGISTIC, LOGISTIC.gradients(cls(spark, folder), gradient=SHARED))


@query(
    "logistic_predict",
    with_ctes(
        [CLS_SQL, _LOGISTIC_SQL],
        f"SELECT l_orderkey, l_linenumber, {rounded_sql('p')} AS prediction FROM t",
    ),
)
def _logistic_predict(spark, folder):
    rows = LOGISTIC.predict(cls(spark, folder))
    return rows.select(*_LINE_KEYS, rounded("prediction").alias("prediction"))


_CLASS_SQL = f"CAST(p > {number(0.4)} AS DOUBLE)"


@query(
    "logistic_classify",
    with_ctes(
        [CLS_SQL, _LOGISTIC_SQL],
        f"SELECT l_orderkey, l_linenumber, {_CLASS_SQL} AS prediction FROM t",
    ),
)
def _logistic_classify(spark, folder):
    return (
        LOGISTIC.predict(cls(spark, folder))
        .withColumn("prediction", classify(F.col("prediction"), 0.4))
        .select(*_LINE_KEYS, "prediction")
    )


@query(
    "logistic_accuracy",
    with_ctes(
        [CLS_SQL, _LOGISTIC_SQL],
        "SELECT "
        + rounded_sql(f"avg(CAST(CAST(p > {number(0.5)} AS DOUBLE) = y AS DOUBLE))")
        + " AS accuracy FROM t",
    ),
)
def _logistic_accuracy(spark, folder):
    return LOGISTIC.accuracy(cls(spark, folder)).select(rounded("accuracy").alias("accuracy"))


@query(
    "logistic_loss",
    with_ctes(
        [CLS_SQL, _LOGISTIC_SQL],
        f"SELECT {rounded_sql('-avg(y*ln(p) + (1 - y)*ln(1 - p))')} AS loss FROM t",
    ),
)
def _logistic_loss(spark, folder):
    return LOGISTIC.loss(cls(spark, folder)).select(rounded("loss").alias("loss"))


# ---- support vector machine -----------------------------------------------

SVM = SVMModel(ORD_FEATURES, "y", 0.2, (0.5, -0.3))
SVM_OPEN = SVMModel(ORD_FEATURES, "y", -0.2, (0.1, 0.1))
_ORD_SCORE = _score_sql(ORD_FEATURES, "b", ["w0", "w1"])
_FIRST_ROW = ", row_number() OVER (ORDER BY o_orderkey) AS rn"
_VIOLATED = "avg(CASE WHEN y - p > 0 THEN 1.0 ELSE 0.0 END)"


def _svm_sql(intercept: float, weights: Sequence[float]) -> str:
    score = _fixed_score(ORD_FEATURES, intercept, weights)
    return f"t AS (SELECT *, {score} AS p{_FIRST_ROW} FROM ord)"


def _gated_sql(mean: str) -> str:
    return f"CASE WHEN max(CASE WHEN rn = 1 THEN y - p END) > 0 THEN -avg({mean}) ELSE 0 END"


def _svm_fit_sql(epochs: int, kernel: str) -> str:
    gradients = [_gated_sql(kernel.format(x=x)) for x in ORD_FEATURES]
    return _epochs_sql(
        ORD_SQL, "ord", ORD_FEATURES, epochs, 0.1, _ORD_SCORE, _VIOLATED, gradients, _FIRST_ROW
    )


@query("svm_fit", _svm_fit_sql(5, "{x}"))
def _svm_fit(spark, folder):
    model = fit_svm(orders(spark, folder), ORD_FEATURES, "y", 5, 0.1, ["o_orderkey"])
    return _parameters(spark, model)


_RBF = f"exp(-{number(0.5)} * ({{x}} - p) * ({{x}} - p))"


@query("svm_fit_rbf", _svm_fit_sql(3, _RBF))
def _svm_fit_rbf(spark, folder):
    rows = orders(spark, folder)
    model = fit_svm(rows, ORD_FEATURES, "y", 3, 0.1, ["o_orderkey"], kernel=RadialBasis(0.5))
    return _parameters(spark, model)


@query(
    "svm_fit_sigmoid",
    _epochs_sql(
        ORD_SQL,
        "ord",
        ORD_FEATURES,
        4,
        0.1,
        _sigmoid_sql(_ORD_SCORE),
        _VIOLATED,
        [_gated_sql(x) for x in ORD_FEATURES],
        _FIRST_ROW,
    ),
)
def _svm_fit_sigmoid(spark, folder):
    rows = orders(spark, folder)
    model = fit_svm(rows, ORD_FEATURES, "y", 4, 0.1, ["o_orderkey"], activation=SIGMOID)
    return _parameters(spark, model)


@query(
    "svm_fit_mse_polynomial",
    _epochs_sql(
        ORD_SQL,
        "ord",
        ORD_FEATURES,
        3,
        0.05,
        _ORD_SCORE,
        "-2*avg(y - p)",
        [f"-2*avg((y - p)*pow({x}*p + 1, 2))" for x in ORD_FEATURES],
    ),
)
def _svm_fit_mse_polynomial(spark, folder):
    rows = orders(spark, folder)
    model = fit_svm(rows, ORD_FEATURES, "y", 3, 0.05, loss=MSE, kernel=Polynomial(1.0, 2.0))
    return _parameters(spark, model)


def _row_gate_sql(row: int, x: str) -> str:
    return f"CASE WHEN max(CASE WHEN rn = {row} THEN y - p END) > 0 THEN -avg({x}) ELSE 0 END"


@query(
    "linear_fit_hinge",
    _epochs_sql(
        ORD_SQL,
        "ord",
        ORD_FEATURES,
        4,
        0.1,
        _ORD_SCORE,
        _VIOLATED,
        [f"(({_row_gate_sql(1, 'x0')}) + ({_row_gate_sql(2, 'x1')}))/2"] * 2,
        _FIRST_ROW,
    ),
)
def _linear_fit_hinge(spark, folder):
    """Row i's margin gates feature i; the step is shared."""
    rows = orders(spark, folder)
    model = fit_linear(rows, ORD_FEATURES, "y", 4, 0.1, loss=HINGE, order_by=["o_orderkey"])
    return _parameters(spark, model)


@query(
    "svm_gradients",
    with_ctes(
        [
            ORD_SQL,
            _svm_sql(-0.2, (0.1, 0.1)),
            f"g AS (SELECT {_VIOLATED} AS g0, {_gated_sql('x0')} AS g1, "
            f"{_gated_sql('x1')} AS g2 FROM t)",
        ],
        _rows_sql("g", ["g0", "g1", "g2"], ORD_FEATURES, "gradient"),
    ),
)
def _svm_gradients(spark, folder):
    return _gradients(spark, SVM_OPEN, SVM_OPEN.gradients(orders(spark, folder), ["o_orderkey"]))


@query(
    "svm_predict",
    with_ctes(
        [ORD_SQL, _svm_sql(0.2, (0.5, -0.3))],
        "SELECT o_orderkey, p + 0.0 AS prediction FROM t",
    ),
)
def _svm_predict(spark, folder):
    return _predicted(SVM, orders(spark, folder), ["o_orderkey"])


@query(
    "svm_accuracy",
    with_ctes(
        [ORD_SQL, _svm_sql(0.2, (0.5, -0.3))],
        f"SELECT {rounded_sql('avg(CAST(p >= y AS DOUBLE))')} AS accuracy FROM t",
    ),
)
def _svm_accuracy(spark, folder):
    return SVM.accuracy(orders(spark, folder)).select(rounded("accuracy").alias("accuracy"))


@query(
    "svm_loss",
    with_ctes(
        [ORD_SQL, _svm_sql(0.2, (0.5, -0.3))],
        f"SELECT {rounded_sql('sum(greatest(1 - y*p, 0))')} AS loss FROM t",
    ),
)
def _svm_loss(spark, folder):
    return SVM.loss(orders(spark, folder)).select(rounded("loss").alias("loss"))
