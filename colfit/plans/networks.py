"""Layers and multilayer perceptrons."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colfit.functions.activations import IDENTITY, RELU, SIGMOID, Activation, LeakyReLU
from colfit.functions.losses import BCE
from colfit.models import ColumnNetwork, Layer, Network, layer_random, layer_zeroes
from colfit.models.layers import layer_backward, layer_forward
from colfit.plans.clustering import _unit_sql as unit_sql
from colfit.plans.registry import number, query, rounded, rounded_sql, with_ctes
from colfit.plans.views import (
    COL_SQL,
    EMB_SQL,
    WIDTH,
    bias_at,
    embeddings,
    layer_sql,
    layer_table,
    part_column,
    table,
    weight_at,
)

RATE = 0.01
SEED = 11


def _sigmoid_sql(x: str) -> str:
    return f"(1/(1 + exp(-({x}))))"


# ---- layers -----------------------------------------------------------------


@query(
    "layer_zeroes",
    f"SELECT p_partkey AS pos, {number(0.0)} AS weight, {number(0.0)} AS bias FROM part",
)
def _layer_zeroes(spark, folder):
    """A layer with the positions of the part table."""
    return layer_zeroes(table(spark, folder, "part"), "p_partkey")


def _random_sql(kind: str) -> str:
    return rounded_sql(f"{unit_sql(str(SEED), repr(kind), 'p_partkey')} * 2 + {number(-1.0)}")


@query(
    "layer_random",
    f"SELECT p_partkey AS pos, {_random_sql('weight')} AS weight, "
    f"{_random_sql('bias')} AS bias FROM part",
)
def _layer_random(spark, folder):
    layer = layer_random(table(spark, folder, "part"), (1.0, -1.0), SEED, "p_partkey")
    return layer.select(
        "pos", rounded("weight").alias("weight"), rounded("bias").alias("bias")
    )


# ---- one sample per row -----------------------------------------------------


def _layer(i: int, activation: Activation) -> Layer:
    return Layer(
        tuple(weight_at(i, j) for j in range(WIDTH)),
        tuple(bias_at(i, j) for j in range(WIDTH)),
        activation,
    )


def _batch_sql(activations: Sequence[str], weights: Sequence[tuple[str, str]]) -> list[str]:
    """CTEs ending in ``outs(vec_id, pos, label, value)``."""
    (w, b), *above = weights
    ctes = [
        EMB_SQL,
        f"d0 AS (SELECT vec_id, sum(x*{w}) AS d FROM emb GROUP BY vec_id)",
    ]
    out = activations[0].format(x=f"d + {b}")
    for i, ((next_w, next_b), act) in enumerate(zip(above, activations[1:], strict=True)):
        ctes.append(
            f"d{i + 1} AS (SELECT vec_id, sum({out}*{next_w}) AS d "
            f"FROM d{i}, (SELECT unnest(range({WIDTH})) AS pos) GROUP BY vec_id)"
        )
        out = act.format(x=f"d + {next_b}")
    last = len(weights) - 1
    ctes.append(
        f"outs AS (SELECT vec_id, pos, label, {out} AS value FROM emb JOIN d{last} USING (vec_id))"
    )
    return ctes


_SIGMOID = _sigmoid_sql("{x}")
_LEAK = f"(CASE WHEN {{x}} > 0 THEN {{x}} ELSE {number(0.1)} * ({{x}}) END)"
_VALUES_SQL = f"SELECT vec_id, pos, {rounded_sql('value')} AS value FROM outs"


def _positions(df: DataFrame) -> DataFrame:
    return df.select("vec_id", F.posexplode_outer("output").alias("pos", "value")).select(
        "vec_id", F.col("pos").cast("bigint").alias("pos"), rounded("value").alias("value")
    )


@query("layer_forward", with_ctes(_batch_sql([_SIGMOID], [layer_sql(0)]), _VALUES_SQL))
def _layer_forward(spark, folder):
    network = Network((_layer(0, SIGMOID),))
    return _positions(network.forward(embeddings(spark, folder), "x"))


@query(
    "mlp_forward",
    with_ctes(_batch_sql([_SIGMOID, _SIGMOID], [layer_sql(0), layer_sql(1)]), _VALUES_SQL),
)
def _mlp_forward(spark, folder):
    network = Network((_layer(0, SIGMOID), _layer(1, SIGMOID)))
    return _positions(network.forward(embeddings(spark, folder), "x"))


@query(
    "mlp_predict",
    with_ctes(
        _batch_sql([_LEAK, _SIGMOID, "({x})"], [layer_sql(0), layer_sql(1), layer_sql(0)]),
        _VALUES_SQL,
    ),
)
def _mlp_predict(spark, folder):
    network = (
        Network()
        .add_layer(_layer(0, LeakyReLU(0.1)))
        .add_layer(_layer(1, SIGMOID))
        .add_layer(_layer(0, IDENTITY))
    )
    return _positions(network.predict(embeddings(spark, folder), "x"))


def _labelled(spark, folder) -> DataFrame:
    """Embeddings with the label repeated over the positions as target array."""
    return embeddings(spark, folder).withColumn(
        "y", F.array_repeat(F.col("label") / 10, WIDTH)
    )


@query(
    "mlp_loss",
    with_ctes(
        _batch_sql([_SIGMOID, _SIGMOID], [layer_sql(0), layer_sql(1)]),
        f"SELECT {rounded_sql('avg((value - label/10)*(value - label/10))')} AS loss FROM outs",
    ),
)
def _mlp_loss(spark, folder):
    network = Network((_layer(0, SIGMOID), _layer(1, SIGMOID)))
    loss = network.loss(_labelled(spark, folder), "x", "y")
    return loss.select(rounded("loss").alias("loss"))


@query(
    "mlp_accuracy",
    with_ctes(
        _batch_sql(["greatest({x}, 0)"], [(number(0.0), "((pos % 4)/10)")]),
        f"SELECT {rounded_sql('avg(CAST(value = label/10 AS DOUBLE))')} AS accuracy FROM outs",
    ),
)
def _mlp_accuracy(spark, folder):
    """Zero weights, so outputs are the biases and equal some labels exactly."""
    layer = Layer((0.0,) * WIDTH, tuple((j % 4) / 10 for j in range(WIDTH)), RELU)
    accuracy = Network((layer,)).accuracy(_labelled(spark, folder), "x", "y")
    return accuracy.select(rounded("accuracy").alias("accuracy"))


def _batch_epoch_sql(e: int) -> list[str]:
    """From parameters ``l{e}(pos, w0, b0, w1, b1)`` to ``l{e + 1}``."""
    lr = number(RATE)
    return [
        f"r{e} AS (SELECT vec_id, any_value(label)/10 AS y, sum(x*w0) AS raw "
        f"FROM emb JOIN l{e} USING (pos) GROUP BY vec_id)",
        f"s{e} AS (SELECT vec_id, any_value(y) AS y, any_value(raw) AS raw, "
        f"sum({_sigmoid_sql('raw + b0')}*w1) AS s FROM r{e}, l{e} GROUP BY vec_id)",
        f"g{e} AS (SELECT vec_id, any_value(raw) AS raw, "
        f"-2*avg(y - {_sigmoid_sql('s + b1')}) AS g FROM s{e}, l{e} GROUP BY vec_id)",
        f"n{e} AS (SELECT vec_id, pos, w0, b0, b1, x, g, "
        f"w1 - {lr}*{_sigmoid_sql('raw + b0')}*g AS nw1 "
        f"FROM emb JOIN g{e} USING (vec_id) JOIN l{e} USING (pos))",
        f"h{e} AS (SELECT avg(h) AS h, avg(g) AS g FROM "
        f"(SELECT vec_id, sum(nw1) AS h, any_value(g) AS g FROM n{e} GROUP BY vec_id))",
        f"l{e + 1} AS (SELECT pos, avg(w0 - {lr}*x*nw1) AS w0, "
        f"any_value(b0) - {lr}*any_value(h{e}.h) AS b0, avg(nw1) AS w1, "
        f"any_value(b1) - {lr}*any_value(h{e}.g) AS b1 FROM n{e}, h{e} GROUP BY pos)",
    ]


def _two_layers_sql(source: str) -> str:
    parts = [
        f"SELECT {i} AS layer, pos, {rounded_sql(f'w{i}')} AS weight, "
        f"{rounded_sql(f'b{i}')} AS bias FROM {source}"
        for i in range(2)
    ]
    return " UNION ALL ".join(parts)


def _start_sql(positions: str) -> str:
    (w0, b0), (w1, b1) = layer_sql(0), layer_sql(1)
    return f"SELECT pos, {w0} AS w0, {b0} AS b0, {w1} AS w1, {b1} AS b1 FROM {positions}"


@query(
    "mlp_fit_batch",
    with_ctes(
        [
            EMB_SQL,
            f"l0 AS ({_start_sql(f'(SELECT unnest(range({WIDTH})) AS pos)')})",
            *_batch_epoch_sql(0),
            *_batch_epoch_sql(1),
        ],
        _two_layers_sql("l2"),
    ),
)
def _mlp_fit_batch(spark, folder):
    """Two epochs on all embeddings, updates averaged over them."""
    network = Network((_layer(0, SIGMOID), _layer(1, SIGMOID)))
    fitted = network.fit(_labelled(spark, folder), "x", "y", 2, RATE)
    return spark.createDataFrame(
        [
            (i, j, w, b)
            for i, layer in enumerate(fitted.layers)
            for j, (w, b) in enumerate(zip(layer.weights, layer.biases, strict=True))
        ],
        "layer int, pos bigint, weight double, bias double",
    ).select("layer", "pos", rounded("weight").alias("weight"), rounded("bias").alias("bias"))


# ---- one sample as a column ---------------------------------------------------


def _column_network(spark, folder) -> ColumnNetwork:
    return ColumnNetwork(
        (layer_table(spark, folder, 0), layer_table(spark, folder, 1)), (SIGMOID, SIGMOID)
    )


_L0 = f"l0 AS ({_start_sql('col')})"
_RAW = "r AS (SELECT sum(v*w0) AS raw FROM col JOIN l0 USING (pos))"


@query(
    "layer_forward_column",
    with_ctes(
        [COL_SQL, _L0, _RAW],
        f"SELECT pos, {rounded_sql(_sigmoid_sql('raw + b0'))} AS value FROM l0, r",
    ),
)
def _layer_forward_column(spark, folder):
    layer = layer_table(spark, folder, 0)
    values = layer_forward(layer, part_column(spark, folder), SIGMOID)
    return values.select("pos", rounded("value").alias("value"))


@query(
    "mlp_forward_column",
    with_ctes(
        [
            COL_SQL,
            _L0,
            _RAW,
            f"s AS (SELECT sum({_sigmoid_sql('raw + b0')}*w1) AS s FROM l0, r)",
        ],
        f"SELECT pos, {rounded_sql(_sigmoid_sql('s + b1'))} AS value FROM l0, s",
    ),
)
def _mlp_forward_column(spark, folder):
    values = _column_network(spark, folder).forward(part_column(spark, folder))
    return values.select("pos", rounded("value").alias("value"))


# Long decimals, so that no product falls halfway between two rounded values.
_OFFSET = 0.91234567


@query(
    "layer_backward",
    with_ctes(
        [COL_SQL, _L0, f"g AS (SELECT sum(v - {number(_OFFSET)}) AS g FROM col)"],
        f"SELECT pos, {rounded_sql(f'w0 - {number(RATE)}*v*(v - {number(_OFFSET)})')} AS weight, "
        f"{rounded_sql(f'b0 - {number(RATE)}*g')} AS bias FROM col JOIN l0 USING (pos), g",
    ),
)
def _layer_backward(spark, folder):
    inputs = part_column(spark, folder).withColumn("g", F.col("value") - _OFFSET)
    layer = layer_backward(layer_table(spark, folder, 0), inputs, "g", RATE)
    return layer.select("pos", rounded("weight").alias("weight"), rounded("bias").alias("bias"))


_SCALAR = -0.73917345


@query(
    "layer_backward_scalar",
    with_ctes(
        [COL_SQL, _L0],
        f"SELECT pos, {rounded_sql(f'w0 - {number(RATE)}*v*{number(_SCALAR)}')} AS weight, "
        f"{rounded_sql(f'b0 - {number(RATE)}*{number(_SCALAR)}')} AS bias "
        "FROM col JOIN l0 USING (pos)",
    ),
)
def _layer_backward_scalar(spark, folder):
    """One output gradient for all positions, as the last layer of a network has."""
    inputs = part_column(spark, folder)
    layer = layer_backward(layer_table(spark, folder, 0), inputs, _SCALAR, RATE)
    return layer.select("pos", rounded("weight").alias("weight"), rounded("bias").alias("bias"))


_OUT = f"outs AS (SELECT pos, y, {_sigmoid_sql('s + b1')} AS p FROM col JOIN l0 USING (pos), s)"
_DOT = f"s AS (SELECT sum({_sigmoid_sql('raw + b0')}*w1) AS s FROM l0, r)"


@query(
    "mlp_loss_column",
    with_ctes(
        [COL_SQL, _L0, _RAW, _DOT, _OUT],
        f"SELECT {rounded_sql('-avg(p*ln(y) + (1 - p)*ln(1 - y))')} AS loss FROM outs",
    ),
)
def _mlp_loss_column(spark, folder):
    """Cross entropy with prediction and label changing places."""
    network = replace(_column_network(spark, folder), loss_function=BCE)
    return network.loss(part_column(spark, folder)).select(rounded("loss").alias("loss"))


@query(
    "mlp_accuracy_column",
    with_ctes(
        [COL_SQL, _L0],
        f"SELECT {rounded_sql('avg(CAST(b0 = trunc(v*5)/10 - 0.3 AS DOUBLE))')} AS accuracy "
        "FROM col JOIN l0 USING (pos)",
    ),
)
def _mlp_accuracy_column(spark, folder):
    """Zero weights, so outputs are the biases and equal some labels exactly."""
    layer = layer_table(spark, folder, 0).withColumn("weight", F.lit(0.0))
    inputs = part_column(spark, folder).withColumn(
        "label", F.floor(F.col("value") * 5) / F.lit(10.0) - F.lit(0.3)
    )
    accuracy = ColumnNetwork((layer,), (IDENTITY,)).accuracy(inputs)
    return accuracy.select(rounded("accuracy").alias("accuracy"))


def _column_epoch_sql(e: int) -> list[str]:
    """One update of a two-layer network from ``l{e}`` to ``l{e + 1}``."""
    lr = number(RATE)
    inner = _sigmoid_sql("raw + b0")
    return [
        f"r{e} AS (SELECT sum(v*w0) AS raw FROM col JOIN l{e} USING (pos))",
        f"s{e} AS (SELECT any_value(raw) AS raw, sum({inner}*w1) AS s FROM l{e}, r{e})",
        f"g{e} AS (SELECT any_value(raw) AS raw, -2*avg(y - {_sigmoid_sql('s + b1')}) AS g "
        f"FROM col JOIN l{e} USING (pos), s{e})",
        f"n{e} AS (SELECT pos, v, w0, b0, b1, g, w1 - {lr}*{inner}*g AS nw1 "
        f"FROM col JOIN l{e} USING (pos), g{e})",
        f"h{e} AS (SELECT sum(nw1) AS h FROM n{e})",
        f"l{e + 1} AS (SELECT pos, w0 - {lr}*v*nw1 AS w0, b0 - {lr}*h AS b0, nw1 AS w1, "
        f"b1 - {lr}*g AS b1 FROM n{e}, h{e})",
    ]


def _column_fit_sql(epochs: int) -> str:
    steps = [cte for e in range(epochs) for cte in _column_epoch_sql(e)]
    return with_ctes([COL_SQL, _L0, *steps], _two_layers_sql(f"l{epochs}"))


def _parameters(network: ColumnNetwork) -> DataFrame:
    return network.parameters().select(
        "layer", "pos", rounded("weight").alias("weight"), rounded("bias").alias("bias")
    )


@query("mlp_backward", _column_fit_sql(1))
def _mlp_backward(spark, folder):
    return _parameters(_column_network(spark, folder).backward(part_column(spark, folder), RATE))


@query("mlp_fit", _column_fit_sql(2))
def _mlp_fit(spark, folder):
    return _parameters(_column_network(spark, folder).fit(part_column(spark, folder), 2, RATE))
