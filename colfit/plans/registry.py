"""The list of queries, and helpers to write Spark and SQL results alike."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SCALE = 1e6


def query(name: str, sql: str):
    """Register a query and the SQL giving the same rows."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = function
        ORACLES[name] = sql
        return function

    return register


def rounded(value: Column | str) -> Column:
    """To six digits, because engines sum in different orders.

    Halves go to even on the scaled double, which both engines compute alike
    and Spark compiles (its ``round`` goes through decimals).
    """
    column = F.col(value) if isinstance(value, str) else value
    return F.rint(column * F.lit(SCALE)) / F.lit(SCALE) + F.lit(0.0)


def rounded_sql(expression: str) -> str:
    scale = number(SCALE)
    return f"round_even(({expression}) * {scale}, 0) / {scale} + 0.0"


def number(value: float) -> str:
    """A double in SQL; a bare decimal would be a fixed-point number."""
    return f"CAST({value!r} AS DOUBLE)"


def with_ctes(ctes: Sequence[str], select: str, recursive: bool = False) -> str:
    keyword = "WITH RECURSIVE" if recursive else "WITH"
    return f"{keyword} {', '.join(ctes)} {select}"


def single(spark: SparkSession, names: Sequence[str], values: Sequence[float]) -> DataFrame:
    """A one-row result of doubles."""
    schema = ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame([tuple(float(v) for v in values)], schema)
