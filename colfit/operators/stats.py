"""Column statistics in one pass, and input checks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colfit.session import ship_package

# Up to so many averages are one aggregate, which needs no Python; the values are the same.
FEW_AVERAGES = 16
# Expressions in one aggregate; more are split over several in the same job, as
# one large aggregate no longer compiles to a small method.
AGGREGATES_AT_ONCE = 50


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} not found among {df.columns}")


def column_statistics(
    df: DataFrame,
    columns: Sequence[Column],
    aggregates: Sequence[Callable[[Column], Column]],
) -> list[tuple]:
    """The aggregates of each column expression over all rows.

    Combined on the map side.  Many columns are read in groups, each by an
    aggregate of its own whose scan reads the group's columns only.
    """
    width = len(aggregates)
    found: list[tuple] = []
    for at in range(0, len(columns), max(1, AGGREGATES_AT_ONCE // width)):
        group = columns[at : at + max(1, AGGREGATES_AT_ONCE // width)]
        named = [f(c).alias(f"s{i}_{j}") for i, c in enumerate(group) for j, f in enumerate(aggregates)]
        row = df.agg(*named).first()
        found += [tuple(row[i * width : (i + 1) * width]) for i in range(len(group))]
    return found


def column_means(df: DataFrame, columns: Sequence[Column]) -> list[float | None]:
    """Averages of a few column expressions over all rows, in one pass."""
    return list(df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]).first()) if columns else []


def sums_by_task(
    df: DataFrame, columns: Sequence[Column], function: Callable[[np.ndarray], np.ndarray]
) -> np.ndarray | None:
    """``function`` of the values, rows by columns, added up over all rows; None without rows.

    Each task adds up its batches in numpy and yields one row, so the cost does
    not depend on how many numbers the function returns.  Nulls arrive as NaN.
    """
    names = [f"c{i}" for i in range(len(columns))]

    def total(batch: pa.RecordBatch) -> np.ndarray:
        return function(np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))

    return added_up(df.select(*[c.cast("double").alias(n) for c, n in zip(columns, names, strict=True)]), total)


def array_means(df: DataFrame, values: Column) -> np.ndarray | None:
    """Averages by position of arrays of doubles of one length, null arrays left out.

    None without arrays.
    """

    def total(batch: pa.RecordBatch) -> np.ndarray | None:
        arrays = batch.column(0).drop_null()
        if not len(arrays):
            return None
        flat = pc.list_flatten(arrays).to_numpy(zero_copy_only=False)
        return np.append(flat.reshape(len(arrays), -1).sum(axis=0), len(arrays))

    sums = added_up(df.select(values.alias("values")), total)
    return None if sums is None else sums[:-1] / sums[-1]


def added_up(rows: DataFrame, total: Callable[[pa.RecordBatch], np.ndarray | None]) -> np.ndarray | None:
    """``total`` of every batch of rows, added up in the tasks and over them; None without rows."""
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            part = total(batch) if batch.num_rows else None
            if part is not None:
                own = part if own is None else own + part
        if own is not None:
            yield pa.RecordBatch.from_arrays([pa.array([own], pa.list_(pa.float64()))], ["total"])

    summed = (
        rows.mapInArrow(run, "total array<double>")
        .select(F.posexplode("total").alias("pos", "value"))
        .groupBy("pos")
        .agg(F.sum("value").alias("value"))
        .collect()  # one row per number that total returns
    )
    if not summed:
        return None
    return np.array([r["value"] for r in sorted(summed, key=lambda r: r["pos"])])


def wide_means(df: DataFrame, columns: Sequence[Column]) -> list[float | None]:
    """Averages, nulls left out, of as many column expressions as there are features."""

    if len(columns) <= FEW_AVERAGES:
        return column_means(df, columns)

    def function(values: np.ndarray) -> np.ndarray:
        return values.sum(axis=0)

    # A null counts neither as a value nor in the number of values.
    filled = [F.coalesce(c.cast("double"), F.lit(0.0)) for c in columns]
    there = [c.isNotNull().cast("double") for c in columns]
    totals = sums_by_task(df, [*filled, *there], function)
    if totals is None:
        return [None] * len(columns)
    sums, counts = np.split(totals, 2)
    return [float(x / n) if n else None for x, n in zip(sums, counts, strict=True)]


def wide_means_of_checked(df: DataFrame, columns: Sequence[Column]) -> list[float | None]:
    """The same for columns that are known to have no nulls."""

    if len(columns) <= FEW_AVERAGES:
        return column_means(df, columns)

    def function(values: np.ndarray) -> np.ndarray:
        return np.append(values.sum(axis=0), len(values))

    totals = sums_by_task(df, columns, function)
    if totals is None:
        return [None] * len(columns)
    return [float(x) for x in totals[:-1] / totals[-1]]


def number_min(x: Column) -> Column:
    """Minimum with NaN left out."""
    return F.min(F.when(~F.isnan(x), x))


def number_max(x: Column) -> Column:
    """Maximum with NaN left out (Spark orders it above everything)."""
    return F.max(F.when(~F.isnan(x), x))


def check_invalid(handle_invalid: str) -> None:
    if handle_invalid not in ("error", "skip"):
        raise ValueError(f"handle_invalid must be 'error' or 'skip', got {handle_invalid!r}")


def check_counts(rows: float | None, nulls: float | None) -> None:
    """Raises on no rows and on nulls, before any loop starts."""
    if not rows:
        raise ValueError("no rows to learn from")
    if nulls:
        raise ValueError("the inputs have nulls; use handle_invalid='skip' to drop those rows")
