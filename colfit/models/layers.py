"""Linear layers as tables ``(pos, weight, bias)``.

A layer reduces its input vector to one number, the dot product with its
weights, and adds each neuron's bias.  The vector is a table ``(pos, value)``;
``pos`` is a unique key, and inputs and layer must cover the same positions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colfit.functions.activations import Activation
from colfit.functions.uniform import uniform_column
from colfit.operators.stats import require_columns
from colfit.session import persisted, shared_folder


def positions(spark: SparkSession, width: int) -> DataFrame:
    """The positions 0 to ``width - 1`` of a layer that belongs to no table."""
    return spark.range(width).toDF("pos")


def layer_zeroes(table: DataFrame, pos: str = "pos") -> DataFrame:
    """A layer with a neuron of zero weight and bias for each position of a table."""
    require_columns(table, [pos])
    return table.select(
        F.col(f"`{pos}`").alias("pos"), F.lit(0.0).alias("weight"), F.lit(0.0).alias("bias")
    )


def layer_random(
    table: DataFrame, limits: tuple[float, float], seed: int, pos: str = "pos"
) -> DataFrame:
    """Weights and biases uniform between the limits, given in either order.

    A neuron's values depend on the seed and its position only.
    """
    require_columns(table, [pos])
    low, high = min(limits), max(limits)
    at = F.col(f"`{pos}`")
    return table.select(
        at.alias("pos"),
        uniform_column(low, high, seed, "weight", at).alias("weight"),
        uniform_column(low, high, seed, "bias", at).alias("bias"),
    )


def layer_forward(layer: DataFrame, inputs: DataFrame, activation: Activation) -> DataFrame:
    """``activation(sum(x*w) + bias)`` per neuron, as ``(pos, value)``."""
    require_columns(inputs, ["pos", "value"])
    values = inputs.select("pos", F.col("value").cast("double").alias("value"))
    with aligned(values, [layer]) as joined:
        (dot,) = dots(joined, [F.col("value") * F.col("weight0")])
    return activated(layer, dot, activation)


def layer_backward(
    layer: DataFrame, inputs: DataFrame, gradient: str | float, learning_rate: float
) -> DataFrame:
    """The layer after one step: ``w - lr*x*g`` and ``b - lr*sum(g)``.

    ``gradient`` names a column of ``inputs``, or is one number for all
    positions (its sum is then the number itself).
    """
    require_columns(inputs, ["pos", "value"])
    if isinstance(gradient, str):
        require_columns(inputs, [gradient])
        g = F.col(f"`{gradient}`").cast("double")
        (shift,) = dots(inputs, [g])
    else:
        g, shift = F.lit(float(gradient)), float(gradient)
    rows = inputs.select("pos", F.col("value").cast("double").alias("value"), g.alias("g"))
    shared_folder(inputs.sparkSession)
    with aligned(rows, [layer]) as joined:
        updated = joined.select(
            "pos",
            stepped(F.col("weight0"), F.col("value"), F.col("g"), learning_rate).alias("weight"),
            (F.col("bias0") - F.lit(shift) * F.lit(float(learning_rate))).alias("bias"),
        )
        return updated.checkpoint()  # of the kept join, which is not computed again


def stepped(weight: Column, x: Column, g: Column, learning_rate: float) -> Column:
    return weight - (x * g) * F.lit(float(learning_rate))


def activated(layer: DataFrame, dot: float, activation: Activation) -> DataFrame:
    """Outputs of a layer whose dot product is known; needs only its biases."""
    z = F.lit(dot) + F.col("bias").cast("double")
    return layer.select("pos", activation.over_column(layer, z).alias("value"))


def dots(df: DataFrame, products: Sequence[Column]) -> list[float]:
    """Sums over all rows in one pass."""
    return list(df.agg(*[F.sum(p).alias(f"s{i}") for i, p in enumerate(products)]).first())


@contextmanager
def aligned(rows: DataFrame, layers: Sequence[DataFrame]) -> Iterator[DataFrame]:
    """``rows`` joined with ``weight0, bias0, weight1, ...`` on ``pos``.

    Inner joins on the same key, so every table is shuffled at most once; the
    result is kept for the passes made within the block.  Raises unless all
    tables hold the same unique positions without nulls.
    """
    for table in (rows, *layers):
        require_columns(table, ["pos"])
    for layer in layers:
        require_columns(layer, ["weight", "bias"])
    named = [
        layer.select(
            "pos",
            F.col("weight").cast("double").alias(f"weight{i}"),
            F.col("bias").cast("double").alias(f"bias{i}"),
        )
        for i, layer in enumerate(layers)
    ]
    joined = reduce(lambda a, b: a.join(b, "pos"), named, rows)
    with persisted(joined):
        _check_aligned([rows, *named], joined)
        yield joined


def _check_aligned(tables: Sequence[DataFrame], joined: DataFrame) -> None:
    """Equal counts and equal sums of position hashes, also after the join.

    One job over the key columns, one row per table.
    """

    def keys(i: int, table: DataFrame) -> DataFrame:
        filled = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in table.columns])
        return table.select(F.lit(i).alias("table"), "pos", filled.alias("filled"))

    prints = (
        reduce(DataFrame.unionAll, [keys(i, t) for i, t in enumerate([*tables, joined])])
        .groupBy("table")
        .agg(
            F.count("*").alias("rows"),
            F.sum(F.xxhash64("pos").cast("decimal(20,0)")).alias("print"),
            F.count_if(~F.col("filled")).alias("nulls"),
        )
        .collect()
    )
    if any(p["nulls"] for p in prints):
        raise ValueError("positions, values and layer parameters must not be null")
    distinct = {(p["rows"], p["print"]) for p in prints}
    if len(distinct) > 1 or (prints and len(prints) <= len(tables)):
        raise ValueError("inputs and layers must cover the same unique positions")
