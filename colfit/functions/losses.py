"""Loss functions as aggregate expressions.

``loss`` and ``intercept_gradient`` are single aggregates.  The mean squared
error and cross entropy gradients are one average per feature.  The hinge
gradient is gated by the first rows of the table, see ``hinge_gates``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colfit.functions.numeric import ln, positive


@dataclass(frozen=True)
class Loss:
    """``feature_scale * mean((y - p) * x)`` is the gradient for feature ``x``."""

    intercept_scale = -2.0
    feature_scale = -2.0
    gated = False

    def loss(self, y: Column, p: Column) -> Column:
        raise NotImplementedError

    def intercept_term(self, y: Column, p: Column) -> Column:
        """Per-row value whose average is the intercept gradient over its scale."""
        return y - p

    def feature_term(self, x: Column, y: Column, p: Column) -> Column:
        """Per-row value whose average is the feature gradient over its scale."""
        return (y - p) * x

    def intercept_gradient(self, y: Column, p: Column) -> Column:
        return F.avg(self.intercept_term(y, p)) * F.lit(self.intercept_scale)

    def gradient(self, xs: Sequence[Column], y: Column, p: Column) -> list[Column]:
        return [F.avg(self.feature_term(x, y, p)) * F.lit(self.feature_scale) for x in xs]


@dataclass(frozen=True)
class MeanSquaredError(Loss):
    def loss(self, y, p):
        return F.avg((y - p) * (y - p))


@dataclass(frozen=True)
class BinaryCrossEntropy(Loss):
    """No clipping: probabilities of exactly 0 or 1 give infinity or NaN.

    The intercept gradient is twice the analytic one.
    """

    feature_scale = -1.0

    def loss(self, y, p):
        one = F.lit(1.0)
        return -F.avg(y * ln(p) + (one - y) * ln(one - p))


@dataclass(frozen=True)
class Hinge(Loss):
    """Loss is a sum; a NaN term counts as 0.

    The gradient of column ``i`` is ``-x`` where row ``i`` has ``y - p > 0``
    and 0 otherwise, so only the first rows decide it.
    """

    intercept_scale = 1.0
    feature_scale = -1.0
    gated = True

    def loss(self, y, p):
        term = F.lit(1.0) - y * p
        return F.sum(F.greatest(F.nanvl(term, F.lit(0.0)), F.lit(0.0)))

    def intercept_term(self, y, p):
        return F.when((y - p).isNull(), None).otherwise(positive(y - p).cast("double"))

    def feature_term(self, x, y, p):
        return x

    def gradient(self, xs, y, p):
        raise ValueError("the hinge gradient depends on row order: use hinge_gradient")


MSE = MeanSquaredError()
BCE = BinaryCrossEntropy()
HINGE = Hinge()


def first_rows(df: DataFrame, order_by: str | Sequence[str], n: int) -> list:
    """The first ``n`` rows by a unique key; ``n`` is at most the feature count.

    Spark keeps the ``n + 1`` smallest keys of each partition, reading only the
    key columns; the rows are then read with a filter on the key.
    """
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    if not order_by:
        raise ValueError("the hinge gradient needs order_by, a unique row key")
    keys = [F.col(f"`{k}`") for k in order_by]
    head = [tuple(row) for row in df.select(*keys).orderBy(*keys).limit(n + 1).collect()]
    if any(part is None for key in head for part in key):
        raise ValueError(f"key {list(order_by)} has nulls")
    if len(set(head)) != len(head):
        raise ValueError(f"key {list(order_by)} is not unique")
    if not head:
        return []
    return df.filter(keys[0] <= F.lit(head[-1][0])).orderBy(*keys).limit(n).collect()


def hinge_gates(
    df: DataFrame, y: Column, p: Column, order_by: str | Sequence[str], n_columns: int
) -> list[bool]:
    """For each column whether its row has a positive margin; min(rows, columns) long."""
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    keys = [F.col(f"`{k}`") for k in order_by]
    margins = df.select(*keys, (y - p).alias("__margin"))
    rows = first_rows(margins, order_by, n_columns)
    if any(row["__margin"] is None for row in rows):
        raise ValueError("the first rows have a null label or prediction")
    return [row["__margin"] > 0 for row in rows]


def hinge_gradient(
    df: DataFrame,
    xs: dict[str, Column],
    y: Column,
    p: Column,
    order_by: str | Sequence[str],
) -> DataFrame:
    """Hinge gradient values: ``df`` with one more column per gated feature column.

    ``xs`` maps each output name to its feature column, in feature order.
    """
    gates = hinge_gates(df, y, p, order_by, len(xs))
    return df.withColumns(
        {
            name: F.lit(-1.0 if gate else 0.0) * x
            for (name, x), gate in zip(xs.items(), gates, strict=False)
        }
    )
