"""Linear regression by gradient descent."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colfit.functions.losses import MSE, Loss, MeanSquaredError
from colfit.functions.numeric import any_null, double, total, weighted
from colfit.models.gradient import (
    SHARED,
    GradientModel,
    check_gradient,
    fit_by_epochs,
    starting_point,
    training_rows,
)
from colfit.operators.stats import AGGREGATES_AT_ONCE, check_counts, column_means, require_columns, sums_by_task


@dataclass(frozen=True)
class LinearModel(GradientModel):
    loss_function: Loss = MSE

    def accuracy(self, df: DataFrame) -> DataFrame:
        """R squared as a one-row DataFrame; 1 when the label is constant.

        One pass: Spark's variance is accumulated around the running mean, so
        it does not lose digits the way a sum of squares would.
        """
        require_columns(df, [self.label])
        y, p = double(self.label), self.prediction(df)
        residual = F.sum((y - p) * (y - p))
        spread = F.var_pop(y) * F.count(y)
        return df.agg(residual.alias("res"), spread.alias("tot")).select(
            F.when(F.col("tot") == 0, F.lit(1.0))
            .otherwise(F.lit(1.0) - F.col("res") / F.col("tot"))
            .alias("r2")
        )


def fit_linear(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    num_epochs: int,
    learning_rate: float,
    *,
    loss: Loss = MSE,
    gradient: str = SHARED,
    order_by: str | Sequence[str] = (),
    warm_start: LinearModel | None = None,
    handle_invalid: str = "error",
) -> LinearModel:
    """Fit from zero coefficients, or from ``warm_start``.

    With the mean squared error the gradient depends on the data only through
    averages of products, so one pass over the table collects those and all
    epochs run on them.  Other losses take one pass per epoch; the hinge loss
    needs ``order_by``.
    """
    check_gradient(gradient)
    features = tuple(features)
    zeros = LinearModel(features, label, 0.0, (0.0,) * len(features), loss)
    model = starting_point(zeros, warm_start)
    if isinstance(loss, MeanSquaredError):
        if gradient == SHARED:
            return _fit_shared_moments(model, df, num_epochs, learning_rate, handle_invalid)
        return _fit_moments(model, df, num_epochs, learning_rate, handle_invalid)
    return fit_by_epochs(
        model, df, num_epochs, learning_rate, order_by, gradient, handle_invalid
    )


def _fit_shared_moments(model, df, num_epochs, learning_rate, handle_invalid) -> LinearModel:
    """All coefficients move by one number ``t``: a regression on ``sum(x)``.

    Five averages, however many features.
    """
    rows = training_rows(df, model, (), handle_invalid)
    k = len(model.features)
    x = total(model.features)
    r = double(model.label) - weighted(0.0, model.coefficients, model.features)
    missing = any_null([*model.features, model.label]).cast("double")
    mx, mr, mxx, mrx, nulls = column_means(rows, [x, r, x * x, r * x, missing])
    check_counts(nulls is not None, nulls)
    intercept, t = model.intercept, 0.0
    for _ in range(num_epochs):
        g0 = -2.0 * (mr - intercept - t * mx)
        g = -2.0 * (mrx - intercept * mx - t * mxx) / k
        intercept -= learning_rate * g0
        t -= learning_rate * g
    return model.with_parameters(intercept, [w + t for w in model.coefficients])


def _fit_moments(model, df, num_epochs, learning_rate, handle_invalid) -> LinearModel:
    """Each coefficient has its own gradient: the averages of all products of features.

    One pass, a plain aggregate for a few features; for more, every task multiplies its
    rows as a matrix.  The driver holds features squared numbers.
    """
    rows = training_rows(df, model, (), handle_invalid)
    k = len(model.features)
    if (k + 1) * (k + 2) < AGGREGATES_AT_ONCE:
        xx, xy = _few_products(rows, model)
        return _descended(model, xx, xy, num_epochs, learning_rate)

    def products(values: np.ndarray) -> np.ndarray:
        x = np.column_stack((np.ones(len(values)), values[:, :k]))
        y, missing = values[:, k], values[:, k + 1]
        return np.concatenate(((x.T @ x).ravel(), x.T @ y, [missing.sum()]))

    missing = any_null([*model.features, model.label]).cast("double")
    columns = [*[double(f) for f in model.features], double(model.label), missing]
    totals = sums_by_task(rows, columns, products)
    check_counts(totals is not None, totals is not None and totals[-1])
    n = totals[0]
    xx = totals[: (k + 1) ** 2].reshape(k + 1, k + 1) / n
    xy = totals[(k + 1) ** 2 : -1] / n
    return _descended(model, xx, xy, num_epochs, learning_rate)


def _few_products(rows: DataFrame, model: LinearModel) -> tuple[np.ndarray, np.ndarray]:
    """Averages of products of features, one of them 1, with each other and with the label."""
    xs, y = [F.lit(1.0), *(double(f) for f in model.features)], double(model.label)
    k = len(xs)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    missing = any_null([*model.features, model.label]).cast("double")
    found = column_means(rows, [*[xs[i] * xs[j] for i, j in pairs], *[x * y for x in xs], missing])
    check_counts(found[-1] is not None, found[-1])
    xx = np.empty((k, k))
    for (i, j), mean in zip(pairs, found[: len(pairs)], strict=True):
        xx[i, j] = xx[j, i] = mean
    return xx, np.array(found[len(pairs) : -1])


def _descended(model: LinearModel, xx: np.ndarray, xy: np.ndarray, num_epochs: int, learning_rate: float) -> LinearModel:
    w = np.array([model.intercept, *model.coefficients])
    for _ in range(num_epochs):
        w = w + learning_rate * 2.0 * (xy - xx @ w)
    return model.with_parameters(float(w[0]), w[1:].tolist())
