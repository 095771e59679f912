"""Column transforms and normalisation.

Each function takes the DataFrame first, so steps chain with ``df.transform``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colfit.functions.numeric import NAN, double
from colfit.operators.stats import (
    column_statistics,
    number_max,
    number_min,
    require_columns,
)


def transform_cols(
    df: DataFrame,
    columns: Sequence[str],
    function: Callable[..., Column],
    rename: Callable[[str], str] | None = None,
    statistics: Sequence[Callable[[Column], Column]] = (),
) -> DataFrame:
    """Apply ``function`` to each named column of the input.

    The result replaces the column, or is appended under ``rename(name)``.  A
    column listed twice is transformed once.  ``statistics`` are aggregates of
    the whole column, such as ``F.avg``; ``function`` gets their values, of its
    own column, as further arguments.
    """
    require_columns(df, columns)
    names = list(dict.fromkeys(columns))
    values: dict[str, tuple] = dict.fromkeys(names, ())
    if statistics:
        found = column_statistics(df, [F.col(f"`{c}`") for c in names], statistics)
        values = dict(zip(names, found, strict=True))
    return df.withColumns(
        {(rename(c) if rename else c): function(F.col(f"`{c}`"), *map(F.lit, values[c])) for c in names}
    )


def spread_vector(df: DataFrame, column: str, width: int) -> tuple[DataFrame, list[str]]:
    """``df`` with the elements of an array column as doubles, and their names.

    The names serve as features of the models; a null array or one of another
    length gives nulls.
    """
    require_columns(df, [column])
    names = [f"{column}_{i}" for i in range(width)]
    vector = F.when(F.size(F.col(f"`{column}`")) == width, F.col(f"`{column}`"))
    return df.withColumns({n: vector[i].cast("double") for i, n in enumerate(names)}), names


def z_norm_cols(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(x - mean) / population std``; a constant column becomes NaN.

    All statistics come from one aggregate; the result is a plain projection.
    """
    stats = _statistics(df, columns, [F.avg, F.stddev_pop])
    return df.withColumns(
        {c: _scaled(double(c), mean, std) for c, (mean, std) in stats.items()}
    )


def min_max_norm_cols(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(x - min) / (max - min)``; a constant column becomes NaN.

    NaN values take no part in the minimum and maximum.
    """
    stats = _statistics(df, columns, [number_min, number_max])
    return df.withColumns(
        {c: _scaled(double(c), low, high - low) for c, (low, high) in stats.items()}
    )


def get_col_by_index(df: DataFrame, index: int) -> DataFrame:
    """The column at a 0-based position, as a one-column DataFrame."""
    if not 0 <= index < len(df.columns):
        raise IndexError(f"column index {index} out of range for {len(df.columns)} columns")
    return df.select(F.col(f"`{df.columns[index]}`"))


def _statistics(
    df: DataFrame, columns: Sequence[str], aggregates: Sequence[Callable[[Column], Column]]
) -> dict[str, tuple[float, float]]:
    """Two statistics for every column from a single pass."""
    names = list(dict.fromkeys(columns))
    require_columns(df, names)
    found = column_statistics(df, [double(c) for c in names], aggregates)
    stats = dict(zip(names, found, strict=True))
    empty = [c for c, pair in stats.items() if None in pair]
    if empty:
        raise ValueError(f"columns {empty} have no values to normalise by")
    return stats


def _scaled(x: Column, centre: float, scale: float) -> Column:
    if scale == 0:
        return F.when(x.isNotNull(), F.lit(NAN))
    return (x - F.lit(centre)) / F.lit(scale)
