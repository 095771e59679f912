"""CSV input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def load_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Read CSV files with a header line.

    Types are inferred, which reads the files once more; pass ``schema`` for
    large inputs.  A missing path raises at once, a malformed line when the row
    is read (``mode`` is Spark's parse mode).
    """
    reader = spark.read.option("header", True).option("mode", mode)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", False).csv(path)
