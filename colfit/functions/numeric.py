"""IEEE-style arithmetic on Spark columns.

Spark's ANSI mode raises on division by zero and its ``ln`` is NULL outside
(0, inf); the models need NaN and infinities instead.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")
NAN = float("nan")

ColumnOrName = Column | str


def double(column: ColumnOrName) -> Column:
    """The column as double; names may contain dots."""
    if isinstance(column, str):
        return F.expr(sql_column(column))
    return column.cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, NaN where the denominator is zero."""
    return F.when(denominator == 0, F.lit(NAN)).otherwise(numerator / denominator)


def ln(x: Column) -> Column:
    """Natural logarithm: -inf at zero, NaN below zero, NULL for NULL."""
    return F.when(x > 0, F.ln(x)).when(x == 0, F.lit(-INF)).when(x < 0, F.lit(NAN))


def positive(x: Column) -> Column:
    """``x > 0`` with NaN counted as false (Spark orders NaN above everything)."""
    return (x > 0) & ~F.isnan(x)


def sql_double(value: float) -> str:
    """A double literal in Spark SQL."""
    value = float(value)
    return f"{value!r}D" if math.isfinite(value) else f"double('{value}')"


def sql_column(name: str) -> str:
    """A column as double in Spark SQL."""
    escaped = name.replace("`", "``")
    return f"cast(`{escaped}` as double)"


# Expressions with one term per feature are parsed from text: building them
# operator by operator costs a call to the JVM for each, every epoch.


def total(names: Sequence[str]) -> Column:
    """Left-to-right sum of columns as doubles."""
    return F.expr(" + ".join(map(sql_column, names)))


def weighted(intercept: float, weights: Sequence[float], names: Sequence[str]) -> Column:
    """``intercept + w0*x0 + w1*x1 + ...`` summed left to right."""
    pairs = zip(weights, names, strict=True)
    terms = [f"{sql_column(x)} * {sql_double(w)}" for w, x in pairs]
    return F.expr(" + ".join([sql_double(intercept), *terms]))


def any_null(names: Sequence[str]) -> Column:
    """Rows with at least one NULL among the columns."""
    return F.expr(" or ".join(f"{sql_column(x)} is null" for x in names))


def double_array(values: Sequence[float]) -> Column:
    """A constant ``array<double>``."""
    return F.expr(f"array({', '.join(map(sql_double, values))})")


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    Inside an array lambda a repeated expression is evaluated once per element;
    binding it to a lambda variable avoids that.
    """
    return F.transform(F.array(value), body).getItem(0)
