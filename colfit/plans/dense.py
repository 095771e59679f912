"""Dense networks: back-propagation, mini-batches, Adam and regularisation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colfit.functions.activations import IDENTITY, SIGMOID, SOFTMAX, LeakyReLU
from colfit.models.dense import (
    CROSS_ENTROPY,
    HINGE,
    SQUARED,
    Adam,
    DenseNetwork,
    Descent,
    Optimiser,
    random_layer,
    zero_layer,
)
from colfit.plans.registry import number, query, rounded, rounded_sql, with_ctes
from colfit.plans.views import CLS_SQL, ORD_FEATURES, ORD_SQL, REG_FEATURES, REG_SQL, cls, orders, reg, table

SEED = 5
LANES, BATCHES = 2, 3

HIDDEN = DenseNetwork(
    REG_FEATURES,
    ("y",),
    (random_layer(3, 2, SIGMOID, SEED, 0), random_layer(2, 1, SIGMOID, SEED, 1)),
    CROSS_ENTROPY,
)
FLAGS = DenseNetwork(
    REG_FEATURES,
    ("y0", "y1", "y2"),
    (random_layer(3, 4, LeakyReLU(0.1), SEED, 0), random_layer(4, 3, SOFTMAX, SEED, 1)),
    CROSS_ENTROPY,
)
DEEP = DenseNetwork(
    REG_FEATURES,
    ("y",),
    (random_layer(3, 3, SIGMOID, SEED, 0), random_layer(3, 2, LeakyReLU(0.2), SEED, 1), random_layer(2, 1, IDENTITY, SEED, 2)),
    SQUARED,
)
LINEAR = DenseNetwork(REG_FEATURES, ("y",), (zero_layer(3),), SQUARED)
LINE = DenseNetwork(ORD_FEATURES, ("y",), (zero_layer(2),), SQUARED)
LOGIT = DenseNetwork(ORD_FEATURES, ("y",), (zero_layer(2, 1, SIGMOID),), CROSS_ENTROPY)
MARGIN = DenseNetwork(ORD_FEATURES, ("y",), (zero_layer(2),), HINGE)

_FLAG_SQL = (
    "flags AS (SELECT l_quantity/50 AS x0, l_discount*10 AS x1, l_tax*10 AS x2, CAST(l_returnflag = 'A' AS DOUBLE) AS y0, "
    "CAST(l_returnflag = 'N' AS DOUBLE) AS y1, CAST(l_returnflag = 'R' AS DOUBLE) AS y2 FROM lineitem)"
)


def _flags(spark: SparkSession, folder: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return table(spark, folder, "lineitem").select(
        (F.col("l_quantity") / 50).alias("x0"),
        (F.col("l_discount") * 10).alias("x1"),
        (F.col("l_tax") * 10).alias("x2"),
        *[(flag == c).cast("double").alias(f"y{i}") for i, c in enumerate("ANR")],
    )


# ---- the same in SQL: a column for each parameter, a CTE for each step --------


def _names(network: DenseNetwork) -> list[str]:
    """Parameters in the order of ``flat``."""
    out = []
    for k, layer in enumerate(network.layers):
        n, m = len(layer.biases), layer.inputs
        out += [f"w{k}_{i}_{j}" for i in range(n) for j in range(m)] + [f"b{k}_{i}" for i in range(n)]
    return out


def _activation_sql(network: DenseNetwork, k: int, i: int) -> str:
    kind, z = network.layers[k].activation, f"z{k}_{i}"
    if kind == SIGMOID:
        return f"1 / (1 + exp(-{z}))"
    if kind == SOFTMAX:
        return f"exp({z}) / ({' + '.join(f'exp(z{k}_{j})' for j in range(len(network.layers[k].biases)))})"
    return f"CASE WHEN {z} > 0 THEN {z} ELSE {number(kind.alpha)} * {z} END" if isinstance(kind, LeakyReLU) else z


def _slope_sql(network: DenseNetwork, k: int, i: int) -> str:
    kind = network.layers[k].activation
    if kind == SIGMOID:
        return f"(a{k}_{i} * (1 - a{k}_{i}))"
    return f"(CASE WHEN z{k}_{i} > 0 THEN 1 ELSE {number(kind.alpha)} END)" if isinstance(kind, LeakyReLU) else "1"


def _forward_sql(network: DenseNetwork, rows: str) -> str:
    """``rows`` with every layer's sums ``z`` and outputs ``a``."""
    for k, layer in enumerate(network.layers):
        below = network.features if k == 0 else [f"a{k - 1}_{j}" for j in range(layer.inputs)]
        sums = [
            " + ".join([f"b{k}_{i}", *(f"w{k}_{i}_{j} * {x}" for j, x in enumerate(below))]) + f" AS z{k}_{i}"
            for i in range(len(layer.biases))
        ]
        rows = f"SELECT *, {', '.join(sums)} FROM ({rows})"
        outputs = [f"{_activation_sql(network, k, i)} AS a{k}_{i}" for i in range(len(layer.biases))]
        rows = f"SELECT *, {', '.join(outputs)} FROM ({rows})"
    return rows


def _backward_sql(network: DenseNetwork, rows: str) -> tuple[str, list[str]]:
    """Rows with every layer's errors ``d``, and each parameter's gradient as an average."""
    rows, last = _forward_sql(network, rows), len(network.layers) - 1
    share = float(len(network.labels))
    errors = []
    for i, y in enumerate(network.labels):
        p = f"a{last}_{i}"
        if network.loss_function == HINGE:
            error = f"CASE WHEN (2 * {y} - 1) * {p} < 1 THEN -(2 * {y} - 1) ELSE 0 END / {number(share)}"
        elif network.loss_function == SQUARED:
            error = f"2 * ({p} - {y}) / {number(share)} * {_slope_sql(network, last, i)}"
        elif network.layers[last].activation == SOFTMAX:
            error = f"{p} * ({' + '.join(network.labels)}) - {y}"
        else:
            error = f"({p} - {y}) / {number(share)}"
        errors.append(f"{error} AS d{last}_{i}")
    rows = f"SELECT *, {', '.join(errors)} FROM ({rows})"
    for k in range(last - 1, -1, -1):
        above = range(len(network.layers[k + 1].biases))
        errors = [
            f"({' + '.join(f'd{k + 1}_{i} * w{k + 1}_{i}_{j}' for i in above)}) * {_slope_sql(network, k, j)} AS d{k}_{j}"
            for j in range(len(network.layers[k].biases))
        ]
        rows = f"SELECT *, {', '.join(errors)} FROM ({rows})"
    gradients = []
    for k, layer in enumerate(network.layers):
        below = network.features if k == 0 else [f"a{k - 1}_{j}" for j in range(layer.inputs)]
        gradients += [f"avg(d{k}_{i} * {x})" for i in range(len(layer.biases)) for x in below]
        gradients += [f"avg(d{k}_{i})" for i in range(len(layer.biases))]
    return rows, gradients


def _start_sql(network: DenseNetwork) -> str:
    values = zip(network.flat().tolist(), _names(network), strict=True)
    moments = [f"{number(0.0)} AS {m}_{p}" for p in _names(network) for m in "uv"]
    return ", ".join([f"{number(float(v))} AS {p}" for v, p in values] + moments)


def _step_sql(parameter: str, optimiser: Optimiser) -> list[str]:
    """A parameter and its moments after a step from its gradient ``g_``."""
    weight, p, rate = parameter.startswith("w"), f"s.{parameter}", number(optimiser.rate)
    gradient = f"g_{parameter}" + (f" + {number(optimiser.l2)} * {p}" if weight and optimiser.l2 else "")
    first = second = number(0.0)
    moved = f"{p} - {rate} * ({gradient})"
    if isinstance(optimiser, Adam):
        one, two = number(optimiser.beta1), number(optimiser.beta2)
        first = f"({one} * s.u_{parameter} + (1 - {one}) * ({gradient}))"
        second = f"({two} * s.v_{parameter} + (1 - {two}) * ({gradient}) * ({gradient}))"
        moved = (
            f"{p} - {rate} * ({first} / (1 - pow({one}, s.t + 1))) / "
            f"(sqrt({second} / (1 - pow({two}, s.t + 1))) + {number(optimiser.epsilon)})"
        )
    if weight and optimiser.l1:
        moved = f"sign({moved}) * greatest(abs({moved}) - {number(optimiser.rate * optimiser.l1)}, 0)"
    return [f"{moved} AS {parameter}", f"{first} AS u_{parameter}", f"{second} AS v_{parameter}"]


def _uniform_sql(key: str, size: int, *parts: object) -> str:
    text = ":".join(map(str, parts))
    unit = f"CAST('0x' || substr(md5('{text}:' || CAST({key} AS VARCHAR)), 1, 13) AS BIGINT) / {number(float(16**13))}"
    return f"CAST(floor({unit} * {number(float(size))}) AS INT)"


def _fit_ctes(
    view: str, source: str, network: DenseNetwork, epochs: int, optimiser: Optimiser, key: str | None = None
) -> tuple[list[str], str]:
    """CTEs of the training, and the name of the one with a row of parameters for each lane."""
    lanes, batches = (LANES, BATCHES) if key else (1, 1)
    names = _names(network)
    lane = _uniform_sql(key, lanes, SEED, "lane") if key else "0"
    turns = [f"{_uniform_sql(key, batches, SEED, 'batch', e) if key else '0'} AS batch{e}" for e in range(epochs)]
    columns = ", ".join([*network.features, *network.labels])
    ctes = [
        view,
        f"src AS MATERIALIZED (SELECT {columns}, {lane} AS lane, {', '.join(turns)} FROM {source})",
        f"s0 AS (SELECT lane, 0 AS t, {_start_sql(network)} FROM range({lanes}) l(lane))",
    ]
    n = 0
    for e in range(epochs):
        for b in range(batches):
            rows, gradients = _backward_sql(network, f"SELECT * FROM src JOIN s{n} USING (lane) WHERE batch{e} = {b}")
            averages = ", ".join(f"{g} AS g_{p}" for g, p in zip(gradients, names, strict=True))
            moved = ", ".join(x for p in names for x in _step_sql(p, optimiser))
            ctes += [
                f"g{n} AS MATERIALIZED (SELECT lane, {averages} FROM ({rows}) GROUP BY lane)",
                f"s{n + 1} AS MATERIALIZED (SELECT s.lane, s.t + 1 AS t, {moved} FROM s{n} s JOIN g{n} g ON g.lane = s.lane)",
            ]
            n += 1
        if key:
            means = ", ".join(f"avg({c}) OVER () AS {c}" for p in names for c in (p, f"u_{p}", f"v_{p}"))
            ctes.append(f"s{n + 1} AS MATERIALIZED (SELECT lane, t, {means} FROM s{n})")
            n += 1
    return ctes, f"s{n}"


def _terms_sql(network: DenseNetwork, source: str, value: str = "") -> str:
    rows = []
    for name in _names(network):
        layer, output, *inputs = name[1:].split("_")
        rows.append(
            f"SELECT {layer} AS layer, {output} AS output, {inputs[0] if inputs else 'CAST(NULL AS INT)'} AS input, "
            f"{rounded_sql(value + name)} AS value FROM {source}"
        )
    return " UNION ALL ".join(rows)


def _fit_sql(*args) -> str:
    ctes, last = _fit_ctes(*args)
    return with_ctes([*ctes, f"ended AS (SELECT * FROM {last} WHERE lane = 0)"], _terms_sql(args[2], "ended"))


def _gradient_sql(view: str, source: str, network: DenseNetwork) -> str:
    rows, gradients = _backward_sql(network, f"SELECT * FROM {source}, (SELECT {_start_sql(network)})")
    averages = ", ".join(f"{g} AS g_{p}" for g, p in zip(gradients, _names(network), strict=True))
    return with_ctes([view, f"g AS MATERIALIZED (SELECT {averages} FROM ({rows}))"], _terms_sql(network, "g", "g_"))


def _parameters(spark: SparkSession, network: DenseNetwork) -> DataFrame:
    return network.to_df(spark).select("layer", "output", "input", rounded("value").alias("value"))


# ---- queries --------------------------------------------------------------------

STEPS = Descent(0.5)
ADAM = Adam(0.05)


@query("dense_gradients", _gradient_sql(REG_SQL, "reg", DEEP))
def dense_gradients(spark: SparkSession, folder: str) -> DataFrame:
    """Three layers: the chain rule through two of them."""
    return _parameters(spark, DEEP.gradients(reg(spark, folder)))


@query("dense_fit", _fit_sql(CLS_SQL, "cls", HIDDEN, 3, STEPS))
def dense_fit(spark: SparkSession, folder: str) -> DataFrame:
    return _parameters(spark, HIDDEN.fit(cls(spark, folder), 3, STEPS))


@query("dense_fit_softmax", _fit_sql(_FLAG_SQL, "flags", FLAGS, 2, STEPS))
def dense_fit_softmax(spark: SparkSession, folder: str) -> DataFrame:
    return _parameters(spark, FLAGS.fit(_flags(spark, folder), 2, STEPS))


def _scored_sql(view: str, source: str, network: DenseNetwork) -> list[str]:
    return [view, f"scored AS ({_forward_sql(network, f'SELECT * FROM {source}, (SELECT {_start_sql(network)})')})"]


@query(
    "dense_predict",
    with_ctes(
        _scored_sql(_FLAG_SQL, "flags", FLAGS),
        f"SELECT x0, x1, x2, {', '.join(f'{rounded_sql(f"a1_{i}")} AS p{i}' for i in range(3))}, count(*) AS n FROM scored GROUP BY ALL",
    ),
)
def dense_predict(spark: SparkSession, folder: str) -> DataFrame:
    scored = FLAGS.predict(_flags(spark, folder))
    outputs = [rounded(F.element_at("output", i + 1)).alias(f"p{i}") for i in range(3)]
    return scored.select("x0", "x1", "x2", *outputs).groupBy("x0", "x1", "x2", "p0", "p1", "p2").agg(F.count("*").alias("n"))


@query(
    "dense_loss",
    with_ctes(
        _scored_sql(_FLAG_SQL, "flags", FLAGS),
        f"SELECT {rounded_sql('avg(-(y0 * ln(a1_0) + y1 * ln(a1_1) + y2 * ln(a1_2)))')} AS loss FROM scored",
    ),
)
def dense_loss(spark: SparkSession, folder: str) -> DataFrame:
    return FLAGS.loss(_flags(spark, folder)).select(rounded("loss").alias("loss"))


@query(
    "dense_accuracy",
    with_ctes(
        _scored_sql(_FLAG_SQL, "flags", FLAGS),
        f"SELECT {rounded_sql('avg(CAST(list_position([a1_0, a1_1, a1_2], greatest(a1_0, a1_1, a1_2)) = list_position([y0, y1, y2], 1) AS DOUBLE))')} "
        "AS accuracy FROM scored",
    ),
)
def dense_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return FLAGS.accuracy(_flags(spark, folder)).select(rounded("accuracy").alias("accuracy"))


@query("adam_fit", _fit_sql(REG_SQL, "reg", DEEP, 4, ADAM))
def adam_fit(spark: SparkSession, folder: str) -> DataFrame:
    return _parameters(spark, DEEP.fit(reg(spark, folder), 4, ADAM))


@query("adam_fit_resumed", _fit_sql(CLS_SQL, "cls", HIDDEN, 4, ADAM))
def adam_fit_resumed(spark: SparkSession, folder: str) -> DataFrame:
    """Two epochs and two more: the optimiser's state stays with the network."""
    rows = cls(spark, folder)
    return _parameters(spark, HIDDEN.fit(rows, 2, ADAM).fit(rows, 2, ADAM))


def _batched(spark: SparkSession, folder: str, network: DenseNetwork, optimiser: Optimiser) -> DataFrame:
    fitted = network.fit(orders(spark, folder), 2, optimiser, batches=BATCHES, lanes=LANES, key="o_orderkey", seed=SEED)
    return _parameters(spark, fitted)


def _batched_sql(network: DenseNetwork, optimiser: Optimiser) -> str:
    return _fit_sql(ORD_SQL, "ord", network, 2, optimiser, "o_orderkey")


@query("batches_linear", _batched_sql(LINE, STEPS))
def batches_linear(spark: SparkSession, folder: str) -> DataFrame:
    return _batched(spark, folder, LINE, STEPS)


@query("batches_logistic", _batched_sql(LOGIT, STEPS))
def batches_logistic(spark: SparkSession, folder: str) -> DataFrame:
    return _batched(spark, folder, LOGIT, STEPS)


@query("batches_svm", _batched_sql(MARGIN, STEPS))
def batches_svm(spark: SparkSession, folder: str) -> DataFrame:
    return _batched(spark, folder, MARGIN, STEPS)


@query("batches_adam", _batched_sql(LOGIT, ADAM))
def batches_adam(spark: SparkSession, folder: str) -> DataFrame:
    return _batched(spark, folder, LOGIT, ADAM)


def _regularised(name: str, optimiser: Optimiser, network: DenseNetwork, view: str, source: str, rows) -> None:
    @query(name, _fit_sql(view, source, network, 5, optimiser))
    def fit(spark: SparkSession, folder: str) -> DataFrame:
        return _parameters(spark, network.fit(rows(spark, folder), 5, optimiser))


_regularised("lasso_fit", Descent(0.3, l1=0.12), LINEAR, REG_SQL, "reg", reg)
_regularised("ridge_fit", Descent(0.3, l2=0.5), LINEAR, REG_SQL, "reg", reg)
_regularised("elastic_net_fit", Adam(0.05, l1=0.3, l2=0.1), LOGIT, ORD_SQL, "ord", orders)

