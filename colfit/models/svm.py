"""Support vector machine by gradient descent.

Unlike the other models each coefficient has its own gradient, taken on the
kernel of its feature and the prediction.  With the hinge loss one row, the
first by ``order_by``, opens or closes all feature gradients.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colfit.functions import kernels
from colfit.functions.activations import IDENTITY, Activation
from colfit.functions.kernels import Kernel
from colfit.functions.losses import HINGE, Loss, first_rows
from colfit.functions.numeric import double
from colfit.models.gradient import (
    GradientModel,
    check_rows,
    checked_means,
    descend,
    key_columns,
    literal,
    margin,
    starting_point,
    training_rows,
    with_prediction,
    without_keys,
)
from colfit.operators.stats import check_counts, column_means, require_columns, wide_means_of_checked
from colfit.session import persisted


@dataclass(frozen=True)
class SVMModel(GradientModel):
    loss_function: Loss = HINGE
    activation: Activation = IDENTITY
    kernel: Kernel = kernels.IDENTITY

    def accuracy(self, df: DataFrame) -> DataFrame:
        """Share of rows whose prediction, activated once more, is at least the label."""
        require_columns(df, [self.label])
        again = self.activation.over_column(df, self.prediction(df))
        hit = (again >= double(self.label)) & ~F.isnan(again)
        return df.agg(F.avg(hit.cast("double")).alias("accuracy"))

    def _loss(self, y: Column, p: Column) -> Column:
        # Arguments swapped: no difference for hinge and squared error.
        return self.loss_function.loss(p, y)

    def gradients(
        self, df: DataFrame, order_by: str | Sequence[str] = ()
    ) -> tuple[float, tuple[float, ...]]:
        """Intercept and coefficient gradients at the current parameters."""
        order_by = key_columns(order_by)
        rows = training_rows(df, self, order_by, "error")
        check_rows(rows, self)
        head = first_rows(rows, order_by, 1) if self.loss_function.gated else []
        g0, g = self._gradients(rows, head, [])
        return g0, tuple(g)

    def _gradients(
        self, rows: DataFrame, head: list, constant: Sequence[float]
    ) -> tuple[float, list[float]]:
        """One aggregate; ``constant`` holds kernel means that never change."""
        loss, y = self.loss_function, double(self.label)
        summed = self.activation.column_total(rows, self.score)
        rows, p = with_prediction(rows, self.activation.activate(self.score, literal(summed)))
        shut = loss.gated and not (head and margin(self, head[0], summed) > 0)
        terms = []
        if not shut and not constant:
            kernel = [self.kernel.apply(double(f), p) for f in self.features]
            terms = [loss.feature_term(x, y, p) for x in kernel]
        means = (wide_means_of_checked if terms else column_means)(rows, [loss.intercept_term(y, p), *terms])
        check_counts(means[0] is not None, 0)
        if shut:
            each = [0.0] * len(self.features)
        else:
            each = [loss.feature_scale * m for m in (constant or means[1:])]
        return loss.intercept_scale * means[0], each


def fit_svm(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    num_epochs: int,
    learning_rate: float,
    order_by: str | Sequence[str] = (),
    *,
    loss: Loss = HINGE,
    activation: Activation = IDENTITY,
    kernel: Kernel = kernels.IDENTITY,
    warm_start: SVMModel | None = None,
    handle_invalid: str = "error",
) -> SVMModel:
    """Fit from zero coefficients, or from ``warm_start``; one pass per epoch.

    With the hinge loss and identity kernel an epoch is a single aggregate,
    because the feature means do not change.
    """
    features, order_by = tuple(features), key_columns(order_by)
    zeros = SVMModel(features, label, 0.0, (0.0,) * len(features), loss, activation, kernel)
    model = starting_point(zeros, warm_start)
    rows = training_rows(df, model, order_by, handle_invalid)
    head = first_rows(rows, order_by, 1) if loss.gated else []
    with persisted(without_keys(rows, model)) as rows:
        fixed = loss.gated and isinstance(kernel, kernels.Identity)
        means = checked_means(rows, model, [double(f) for f in features]) if fixed else []
        if not fixed:
            check_rows(rows, model)
        return descend(
            model, num_epochs, learning_rate, lambda m: m._gradients(rows, head, means)
        )
