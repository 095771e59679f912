"""Column-to-column functions for ``operators.prep.transform_cols``."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from colfit.functions.numeric import INF, NAN

Transform = Callable[[Column], Column]


def identity() -> Transform:
    return lambda c: c


def power(exponent: float) -> Transform:
    """``x ** exponent``; a negative base with a fractional exponent gives NaN."""
    return lambda c: F.pow(c.cast("double"), F.lit(float(exponent)))


def log(base: float) -> Transform:
    """Logarithm to ``base``: infinite at zero, NaN below zero, NULL for NULL."""
    if not base > 0 or base == 1 or math.isinf(base):
        raise ValueError(f"log base must be positive, finite and not 1, got {base}")
    scale = math.log(base)
    at_zero = -INF if scale > 0 else INF

    def apply(c: Column) -> Column:
        x = c.cast("double")
        return (
            F.when(x > 0, F.ln(x) / F.lit(scale))
            .when(x == 0, F.lit(at_zero))
            .when(x < 0, F.lit(NAN))
        )

    return apply
