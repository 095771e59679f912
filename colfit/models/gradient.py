"""What the gradient-descent models share: parameters, scoring and the epoch loop.

An epoch is one aggregate over the persisted inputs; the driver holds the
intercept and one coefficient per feature.  By default all coefficients get the
same step, the mean of the per-feature gradients (``SHARED``); ``PER_FEATURE``
gives each its own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import nullcontext
from dataclasses import dataclass, replace
from typing import Self

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colfit.functions.activations import IDENTITY, SOFTMAX, Activation
from colfit.functions.losses import Loss, first_rows, hinge_gates
from colfit.functions.numeric import any_null, double, sql_column, total, weighted
from colfit.models.dense import activated
from colfit.operators.stats import (
    FEW_AVERAGES,
    added_up,
    check_counts,
    check_invalid,
    column_means,
    require_columns,
    wide_means,
    wide_means_of_checked,
)
from colfit.session import persisted

SHARED = "shared"
PER_FEATURE = "per_feature"


@dataclass(frozen=True)
class GradientModel:
    """Parameters of a fitted model, matched to features by name."""

    features: tuple[str, ...]
    label: str
    intercept: float
    coefficients: tuple[float, ...]
    loss_function: Loss
    activation: Activation = IDENTITY

    def __post_init__(self):
        if not self.features or len(self.features) != len(self.coefficients):
            raise ValueError("need one coefficient per feature and at least one feature")

    @property
    def score(self) -> Column:
        """The linear score before the activation."""
        return weighted(self.intercept, self.coefficients, self.features)

    def predict(self, df: DataFrame, column: str = "prediction") -> DataFrame:
        """``df`` with a prediction column; rows with null features predict NULL."""
        return df.withColumn(column, self.prediction(df))

    def prediction(self, df: DataFrame) -> Column:
        require_columns(df, self.features)
        return self.activation.over_column(df, self.score)

    def loss(self, df: DataFrame) -> DataFrame:
        """The loss as a one-row DataFrame with column ``loss``."""
        require_columns(df, [self.label])
        return df.agg(self._loss(double(self.label), self.prediction(df)).alias("loss"))

    def _loss(self, y: Column, p: Column) -> Column:
        return self.loss_function.loss(y, p)

    def gradients(
        self, df: DataFrame, order_by: str | Sequence[str] = (), gradient: str = SHARED
    ) -> tuple[float, tuple[float, ...]]:
        """Intercept and coefficient gradients at the current parameters."""
        check_gradient(gradient)
        order_by = key_columns(order_by)
        require_columns(df, [self.label, *order_by])
        y = double(self.label)
        df, p = with_prediction(df, self.prediction(df))
        xs = [double(f) for f in self.features]
        loss = self.loss_function
        terms = [loss.feature_term(x, y, p) for x in xs]
        means = checked_means(df, self, [loss.intercept_term(y, p), *terms])
        gates = hinge_gates(df, y, p, order_by, len(xs)) if loss.gated else [True] * len(xs)
        each = gated([loss.feature_scale * m for m in means[1:]], gates, gradient)
        return loss.intercept_scale * means[0], tuple(each)

    def to_df(self, spark: SparkSession) -> DataFrame:
        """The parameters as rows ``(term, value)``; the intercept is a term."""
        return spark.createDataFrame(
            [("intercept", self.intercept), *zip(self.features, self.coefficients, strict=True)],
            "term string, value double",
        )

    def with_parameters(self, intercept: float, coefficients: Sequence[float]) -> Self:
        return replace(self, intercept=intercept, coefficients=tuple(coefficients))


def gated(
    gradients: Sequence[float], gates: Sequence[bool], gradient: str
) -> list[float]:
    """Coefficient gradients; columns behind a closed or missing gate give zero.

    A table with fewer rows than features has fewer gates; the shared gradient
    is the mean over the gates there are.
    """
    each = [g if gate else 0.0 for g, gate in zip(gradients, gates, strict=False)]
    if gradient == SHARED:
        return [sum(each) / len(each)] * len(gradients)
    return each + [0.0] * (len(gradients) - len(each))


def check_gradient(gradient: str) -> None:
    if gradient not in (SHARED, PER_FEATURE):
        raise ValueError(f"gradient must be {SHARED!r} or {PER_FEATURE!r}, got {gradient!r}")


def starting_point(model: GradientModel, warm_start: GradientModel | None) -> GradientModel:
    if warm_start is None:
        return model
    if warm_start.features != model.features:
        raise ValueError(f"warm start has features {warm_start.features}")
    return model.with_parameters(warm_start.intercept, warm_start.coefficients)


def training_rows(
    df: DataFrame, model: GradientModel, order_by: str | Sequence[str], handle_invalid: str
) -> DataFrame:
    """The needed columns only, as doubles, without null rows when skipping."""
    check_invalid(handle_invalid)
    require_columns(df, [*model.features, model.label, *order_by])
    inputs = dict.fromkeys([*model.features, model.label])
    keys = [k for k in order_by if k not in inputs]
    rows = df.select(*[double(c).alias(c) for c in inputs], *[F.col(f"`{k}`") for k in keys])
    return rows.dropna(subset=list(inputs)) if handle_invalid == "skip" else rows


def without_keys(rows: DataFrame, model: GradientModel) -> DataFrame:
    """The columns an epoch reads."""
    return rows.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*model.features, model.label])])


def checked_means(
    rows: DataFrame, model: GradientModel, columns: Sequence[Column]
) -> list[float]:
    """Averages of the columns, as many as features; raises on nulls and on no rows."""
    missing = any_null([*model.features, model.label]).cast("double")
    *means, nulls = wide_means(rows, [*columns, missing])
    check_counts(nulls is not None, nulls)
    return means


def with_prediction(rows: DataFrame, prediction: Column) -> tuple[DataFrame, Column]:
    """The prediction as a column, so that many terms share one expression."""
    return rows.withColumn("__prediction", prediction), F.col("__prediction")


def check_rows(rows: DataFrame, model: GradientModel) -> None:
    """Raises on nulls and on no rows."""
    missing = any_null([*model.features, model.label])
    check_counts(*rows.agg(F.count("*"), F.count_if(missing)).first())


def key_columns(order_by: str | Sequence[str]) -> list[str]:
    """A key is one column name or several."""
    return [order_by] if isinstance(order_by, str) else list(order_by)


def descend(
    model: GradientModel,
    num_epochs: int,
    learning_rate: float,
    gradients: Callable[[GradientModel], tuple[float, Sequence[float]]],
) -> GradientModel:
    """Exactly ``num_epochs`` steps of fixed size."""
    for _ in range(num_epochs):
        g0, g = gradients(model)
        model = model.with_parameters(
            model.intercept - learning_rate * g0,
            [w - learning_rate * gj for w, gj in zip(model.coefficients, g, strict=True)],
        )
    return model


def fit_by_epochs(
    model: GradientModel,
    df: DataFrame,
    num_epochs: int,
    learning_rate: float,
    order_by: str | Sequence[str],
    gradient: str,
    handle_invalid: str,
) -> GradientModel:
    """Gradient descent for any loss, one aggregate per epoch."""
    check_gradient(gradient)
    order_by = key_columns(order_by)
    rows = training_rows(df, model, order_by, handle_invalid)
    if model.loss_function.gated:
        return _fit_gated(model, rows, num_epochs, learning_rate, order_by, gradient)
    if gradient == SHARED:
        return _fit_shared(model, rows, num_epochs, learning_rate)
    if len(model.features) > FEW_AVERAGES and model.activation != SOFTMAX:
        return _fit_wide(model, rows, num_epochs, learning_rate)
    y = double(model.label)
    with persisted(rows):
        check_rows(rows, model)

        def step(current: GradientModel):
            scored, p = with_prediction(rows, current.activation.over_column(rows, current.score))
            loss = current.loss_function
            xs = [double(f) for f in current.features]
            terms = [loss.feature_term(x, y, p) for x in xs]
            means = wide_means_of_checked(scored, [loss.intercept_term(y, p), *terms])
            return loss.intercept_scale * means[0], [loss.feature_scale * m for m in means[1:]]

        return descend(model, num_epochs, learning_rate, step)


def _fit_shared(
    model: GradientModel, rows: DataFrame, num_epochs: int, learning_rate: float
) -> GradientModel:
    """Equal steps move all coefficients by one number ``t``.

    The score is then ``intercept + base + t * sum(x)``, where ``base`` comes
    from the starting coefficients, and the shared gradient is one average.  So
    three doubles per row are persisted however many features there are, and an
    epoch has two aggregates.
    """
    k = len(model.features)
    slim = rows.select(
        weighted(0.0, model.coefficients, model.features).alias("base"),
        total(model.features).alias("sum"),
        double(model.label).alias("y"),
        any_null([*model.features, model.label]).alias("missing"),
    )
    base, x, y = F.col("base"), F.col("sum"), F.col("y")
    loss = model.loss_function
    intercept, t = model.intercept, 0.0
    with persisted(slim):
        check_counts(*slim.agg(F.count("*"), F.count_if("missing")).first())
        for _ in range(num_epochs):
            p = model.activation.over_column(slim, F.lit(intercept) + base + F.lit(t) * x)
            g0, g = column_means(slim, [loss.intercept_term(y, p), loss.feature_term(x, y, p)])
            intercept -= learning_rate * loss.intercept_scale * g0
            t -= learning_rate * loss.feature_scale * g / k
    return model.with_parameters(intercept, [w + t for w in model.coefficients])


def _fit_wide(
    model: GradientModel, rows: DataFrame, num_epochs: int, learning_rate: float
) -> GradientModel:
    """Many features: they are persisted as one array, and every task multiplies its rows as a matrix.

    Rows in fewer partitions than there are cores are dealt out once.
    """
    features = ", ".join(map(sql_column, model.features))
    packed = rows.select(
        F.expr(f"array({features})").alias("x"),
        double(model.label).alias("y"),
        any_null([*model.features, model.label]).alias("missing"),
        F.spark_partition_id().alias("part"),
    )
    counts = [F.count("*"), F.count_if("missing"), F.count_distinct("part")]
    cores = rows.sparkSession.sparkContext.defaultParallelism
    with persisted(packed) as kept:
        n, nulls, parts = kept.agg(*counts).first()
        check_counts(n, nulls)
        with persisted(kept.repartition(cores)) if parts < cores else nullcontext(kept) as dealt:

            def step(current: GradientModel):
                b, w, kind = current.intercept, np.array(current.coefficients), current.activation

                def total(batch: pa.RecordBatch) -> np.ndarray:
                    x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
                    d = batch.column("y").to_numpy() - activated(kind, x @ w + b)
                    return np.concatenate(([d.sum()], d @ x, [len(d)]))

                sums = added_up(dealt.select("x", "y"), total)
                loss = current.loss_function
                return float(loss.intercept_scale * sums[0] / n), (loss.feature_scale * sums[1:-1] / n).tolist()

            return descend(model, num_epochs, learning_rate, step)


def _fit_gated(
    model: GradientModel,
    rows: DataFrame,
    num_epochs: int,
    learning_rate: float,
    order_by: str | Sequence[str],
    gradient: str,
) -> GradientModel:
    """Hinge loss: feature means are constant, the first rows open or close them."""
    y = double(model.label)
    loss = model.loss_function
    head = first_rows(rows, order_by, len(model.features))
    with persisted(without_keys(rows, model)) as rows:
        means = checked_means(rows, model, [double(f) for f in model.features])

        def step(current: GradientModel):
            summed = current.activation.column_total(rows, current.score)
            p = current.activation.activate(current.score, literal(summed))
            (violated,) = column_means(rows, [loss.intercept_term(y, p)])
            gates = [margin(current, row, summed) > 0 for row in head]
            each = gated([loss.feature_scale * m for m in means], gates, gradient)
            return loss.intercept_scale * violated, each

        return descend(model, num_epochs, learning_rate, step)


def margin(model: GradientModel, row, summed: float | None) -> float:
    """``y - prediction`` of one collected row, in the same order of operations."""
    score = model.intercept
    for w, f in zip(model.coefficients, model.features, strict=True):
        score = score + row[f] * w
    return row[model.label] - model.activation.value(score, summed)


def literal(value: float | None) -> Column | None:
    return None if value is None else F.lit(value)
