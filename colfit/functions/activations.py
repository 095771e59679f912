"""Activation functions as column expressions.

Elementwise activations need one value at a time.  Softmax also needs the sum
of exponentials over its vector; callers pass it as ``total``:

* a whole column: ``column_total`` runs one aggregate and returns a number;
* groups of a table: ``operators.softmax.softmax``;
* a fixed-width ``array<double>`` per row: ``activate_array``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colfit.functions.numeric import array_sum, bind, positive, ratio

ACTIVATED = "activated_values"
GRADIENTS = "gradients"


@dataclass(frozen=True)
class Activation:
    """Base class; ``total`` is ignored by the elementwise activations."""

    def activate(self, x: Column, total: Column | None = None) -> Column:
        raise NotImplementedError

    def gradient(self, x: Column) -> Column:
        raise NotImplementedError

    def value(self, x: float, total: float | None = None) -> float:
        """The activation of one number on the driver (first-row gates)."""
        raise NotImplementedError

    def column_total(self, df: DataFrame, x: Column) -> float | None:
        return None

    def over_column(self, df: DataFrame, x: Column) -> Column:
        """Activation of ``x`` taken over all rows of ``df``."""
        total = self.column_total(df, x)
        return self.activate(x, None if total is None else F.lit(total))

    def activate_array(self, values: Column) -> Column:
        return F.transform(values, lambda x: self.activate(x))

    def gradient_array(self, values: Column) -> Column:
        return F.transform(values, lambda x: self.gradient(x))


@dataclass(frozen=True)
class Identity(Activation):
    def activate(self, x, total=None):
        return x

    def gradient(self, x):
        return F.lit(1.0)

    def value(self, x, total=None):
        return x


@dataclass(frozen=True)
class Sigmoid(Activation):
    def activate(self, x, total=None):
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))

    def gradient(self, x):
        s = self.activate(x)
        return s * (F.lit(1.0) - s)

    def value(self, x, total=None):
        return 1.0 / (1.0 + _exp(-x))


@dataclass(frozen=True)
class ReLU(Activation):
    """``max(x, 0)``; NaN becomes 0."""

    def activate(self, x, total=None):
        return F.when(x.isNotNull(), F.greatest(F.nanvl(x, F.lit(0.0)), F.lit(0.0)))

    def gradient(self, x):
        return F.when(x.isNull(), None).when(positive(x), F.lit(1.0)).otherwise(F.lit(0.0))

    def value(self, x, total=None):
        return x if x > 0 else 0.0


@dataclass(frozen=True)
class LeakyReLU(Activation):
    alpha: float

    def activate(self, x, total=None):
        return F.when(positive(x), x).otherwise(F.lit(float(self.alpha)) * x)

    def gradient(self, x):
        slope = F.lit(float(self.alpha))
        return F.when(x.isNull(), None).when(positive(x), F.lit(1.0)).otherwise(slope)

    def value(self, x, total=None):
        return x if x > 0 else self.alpha * x


@dataclass(frozen=True)
class Softmax(Activation):
    """``exp(x) / sum(exp(x))`` without a shift, so it overflows to NaN above 709.

    The gradient is the Jacobian of the vector, computed on shifted values.
    """

    def activate(self, x, total=None):
        if total is None:
            raise ValueError("softmax needs the total of its vector")
        return ratio(F.exp(x), total)

    def gradient(self, x):
        raise ValueError("the softmax gradient is a matrix: use gradient_array")

    def value(self, x, total=None):
        if total is None:
            raise ValueError("softmax needs the total of its vector")
        return _exp(x) / total if total else math.nan

    def column_total(self, df, x):
        total = df.agg(F.sum(F.exp(x))).first()[0]
        return math.nan if total is None else total

    def activate_array(self, values):
        exps = F.transform(values, lambda x: F.exp(x))
        return bind(
            F.struct(exps.alias("e"), array_sum(exps).alias("t")),
            lambda b: F.transform(b["e"], lambda e: ratio(e, b["t"])),
        )

    def gradient_array(self, values):
        """Row-major flattened Jacobian, n*n values for an array of n."""

        def jacobian(s: Column) -> Column:
            return F.flatten(
                F.transform(
                    s,
                    lambda a, i: F.transform(
                        s,
                        lambda b, j: F.when(i == j, a * (F.lit(1.0) - a)).otherwise(-a * b),
                    ),
                )
            )

        shifted = bind(F.array_max(values), lambda m: F.transform(values, lambda x: x - m))
        return bind(self.activate_array(shifted), jacobian)


def _exp(x: float) -> float:
    try:
        return math.exp(x)
    except OverflowError:
        return math.inf


IDENTITY = Identity()
SIGMOID = Sigmoid()
RELU = ReLU()
SOFTMAX = Softmax()
