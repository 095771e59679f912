"""Logistic regression by gradient descent."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colfit.functions.activations import SIGMOID, Activation
from colfit.functions.losses import BCE, Loss
from colfit.functions.numeric import double, positive
from colfit.models.gradient import SHARED, GradientModel, fit_by_epochs, starting_point
from colfit.operators.stats import require_columns


def classify(probability: Column, threshold: float = 0.5) -> Column:
    """1.0 above the threshold, else 0.0; NaN is 0.0."""
    above = positive(probability - F.lit(float(threshold)))
    return F.when(probability.isNotNull(), F.when(above, F.lit(1.0)).otherwise(F.lit(0.0)))


@dataclass(frozen=True)
class LogisticModel(GradientModel):
    loss_function: Loss = BCE
    activation: Activation = SIGMOID

    def accuracy(self, df: DataFrame) -> DataFrame:
        """Share of rows whose class at 0.5 equals the label, as column ``accuracy``."""
        require_columns(df, [self.label])
        hit = classify(self.prediction(df)) == double(self.label)
        return df.agg(F.avg(hit.cast("double")).alias("accuracy"))


def fit_logistic(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    num_epochs: int,
    learning_rate: float,
    *,
    loss: Loss = BCE,
    gradient: str = SHARED,
    order_by: str | Sequence[str] = (),
    warm_start: LogisticModel | None = None,
    handle_invalid: str = "error",
) -> LogisticModel:
    """Fit from zero coefficients, or from ``warm_start``; one pass per epoch.

    The hinge loss needs ``order_by``, a unique row key.
    """
    features = tuple(features)
    zeros = LogisticModel(features, label, 0.0, (0.0,) * len(features), loss)
    return fit_by_epochs(
        starting_point(zeros, warm_start),
        df,
        num_epochs,
        learning_rate,
        order_by,
        gradient,
        handle_invalid,
    )
