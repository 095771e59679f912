from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """A table ``row_id, x`` of doubles."""

    def make(values):
        rows = [(i, None if v is None else float(v)) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, "row_id bigint, x double")

    return make


@pytest.fixture
def table(spark):
    """A table ``row_id`` and named double columns."""

    def make(**columns):
        names = list(columns)
        schema = "row_id bigint, " + ", ".join(f"`{n}` double" for n in names)
        rows = [
            (i, *[None if v is None else float(v) for v in values])
            for i, values in enumerate(zip(*columns.values(), strict=True))
        ]
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def values():
    """A result column in ``row_id`` order."""

    def read(df, name="x", order="row_id"):
        return [row[name] for row in df.orderBy(order).select(name).collect()]

    return read
