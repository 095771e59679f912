"""Loading, transforms, normalisation and row selection."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colfit.functions import transforms
from colfit.operators import (
    get_col_by_index,
    min_max_norm_cols,
    select_rows,
    split,
    transform_cols,
    with_row_index,
    z_norm_cols,
)
from colfit.plans.registry import number, query, rounded, rounded_sql
from colfit.plans.views import table
from colfit.session import remove_folder, shared_folder
from colfit.sources import load_csv

PRICE = ["o_totalprice"]
ROWS = [0, 5, 5, 100, 1499]


def _prices(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", "o_totalprice")


def _rounded_prices(df: DataFrame) -> DataFrame:
    return df.select("o_orderkey", rounded("o_totalprice").alias("o_totalprice"))


def _price_sql(expression: str) -> str:
    return f"SELECT o_orderkey, {expression} AS o_totalprice FROM orders"


CSV_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]


def _orders_by_csv(spark: SparkSession, folder: str, schema: str | None) -> DataFrame:
    """The orders written as CSV and loaded again; the files are deleted afterwards."""
    path = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    try:
        table(spark, folder, "orders").select(*CSV_COLUMNS).write.option("header", True).csv(path)
        return load_csv(spark, path, schema).checkpoint()
    finally:
        remove_folder(spark, path)


@query(
    "load_csv",
    "SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, "
    "o_totalprice, o_orderpriority FROM orders",
)
def _load_csv(spark: SparkSession, folder: str) -> DataFrame:
    return _orders_by_csv(spark, folder, None)


@query("load_csv_schema", f"SELECT {', '.join(CSV_COLUMNS)} FROM orders")
def _load_csv_schema(spark: SparkSession, folder: str) -> DataFrame:
    schema = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderpriority string"
    return _orders_by_csv(spark, folder, schema)


@query(
    "transform_cols_centred",
    "SELECT o_orderkey, "
    + rounded_sql("o_totalprice - avg(o_totalprice) OVER ()")
    + " AS o_totalprice FROM orders",
)
def _transform_cols_centred(spark, folder):
    """A function of the column and a statistic of all of it."""
    centred = transform_cols(_prices(spark, folder), PRICE, lambda c, mean: c - mean, statistics=[F.avg])
    return _rounded_prices(centred)


@query("transform_cols", _price_sql("o_totalprice * 2"))
def _transform_cols(spark, folder):
    return transform_cols(_prices(spark, folder), PRICE, lambda c: c * 2)


@query("tf_identity", _price_sql("o_totalprice"))
def _tf_identity(spark, folder):
    return transform_cols(_prices(spark, folder), PRICE, transforms.identity())


@query("tf_power", _price_sql(rounded_sql("pow(o_totalprice/100000, 2)")))
def _tf_power(spark, folder):
    scaled = transform_cols(_prices(spark, folder), PRICE, lambda c: c / 100000)
    return _rounded_prices(transform_cols(scaled, PRICE, transforms.power(2.0)))


@query("tf_log", _price_sql(rounded_sql("ln(o_totalprice) / ln(2)")))
def _tf_log(spark, folder):
    return _rounded_prices(transform_cols(_prices(spark, folder), PRICE, transforms.log(2.0)))


@query(
    "z_norm",
    "WITH s AS (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS d FROM orders) "
    f"SELECT o_orderkey, {rounded_sql('(o_totalprice - m) / d')} AS o_totalprice FROM orders, s",
)
def _z_norm(spark, folder):
    return _rounded_prices(z_norm_cols(_prices(spark, folder), PRICE))


@query(
    "min_max_norm",
    "WITH s AS (SELECT min(o_totalprice) AS a, max(o_totalprice) AS b FROM orders) "
    f"SELECT o_orderkey, {rounded_sql('(o_totalprice - a) / (b - a)')} AS o_totalprice "
    "FROM orders, s",
)
def _min_max_norm(spark, folder):
    return _rounded_prices(min_max_norm_cols(_prices(spark, folder), PRICE))


@query(
    "chained_prep",
    "WITH t AS (SELECT o_orderkey, ln(pow(o_totalprice, 2)) / ln(2) AS v FROM orders), "
    "s AS (SELECT avg(v) AS m, stddev_pop(v) AS d FROM t) "
    f"SELECT o_orderkey, {rounded_sql('(v - m) / d')} AS o_totalprice FROM t, s",
)
def _chained_prep(spark, folder):
    return _rounded_prices(
        _prices(spark, folder)
        .transform(transform_cols, PRICE, transforms.power(2.0))
        .transform(transform_cols, PRICE, transforms.log(2.0))
        .transform(transform_cols, PRICE, transforms.identity())
        .transform(z_norm_cols, PRICE)
    )


@query("get_col_by_index", "SELECT p_retailprice FROM part")
def _get_col_by_index(spark, folder):
    return get_col_by_index(table(spark, folder, "part"), 5)


@query(
    "select_rows",
    "SELECT o_orderkey, o_totalprice FROM (SELECT o_orderkey, o_totalprice, "
    "row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders) "
    f"WHERE i IN ({', '.join(map(str, ROWS))})",
)
def _select_rows(spark, folder):
    return select_rows(_prices(spark, folder), ROWS, "o_orderkey")


MANY_ROWS = list(range(0, 1500, 37))


@query(
    "select_rows_many",
    "SELECT o_orderkey, o_totalprice FROM (SELECT o_orderkey, o_totalprice, "
    "row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders) "
    f"WHERE i IN ({', '.join(map(str, MANY_ROWS))})",
)
def _select_rows_many(spark, folder):
    return select_rows(_prices(spark, folder), MANY_ROWS, "o_orderkey")


@query(
    "select_rows_by_two_columns",
    "SELECT o_orderkey, o_totalprice FROM (SELECT o_orderkey, o_totalprice, "
    "row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i FROM orders) "
    f"WHERE i IN ({', '.join(map(str, ROWS))})",
)
def _select_rows_by_two_columns(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderdate", "o_orderkey", "o_totalprice")
    return select_rows(rows, ROWS, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_totalprice")


@query(
    "row_index",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_index "
    "FROM orders",
)
def _row_index(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderdate", "o_orderkey")
    return with_row_index(rows, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "row_index")


def _split_sql(order_by: str, test: str) -> str:
    return (
        "SELECT o_orderkey, o_totalprice FROM (SELECT o_orderkey, o_totalprice, "
        f"row_number() OVER (ORDER BY {order_by}) AS i, count(*) OVER () AS n FROM orders) "
        f"WHERE i {test} trunc(n * {number(0.8)})"
    )


@query("split_train", _split_sql("o_orderkey", "<="))
def _split_train(spark, folder):
    return split(_prices(spark, folder), 0.8, "o_orderkey")[0]


@query("split_test", _split_sql("o_orderkey", ">"))
def _split_test(spark, folder):
    return split(_prices(spark, folder), 0.8, "o_orderkey")[1]


@query("split_by_two_columns", _split_sql("o_orderdate, o_orderkey", "<="))
def _split_by_two_columns(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderdate", "o_orderkey", "o_totalprice")
    train, _ = split(rows, 0.8, ["o_orderdate", "o_orderkey"])
    return train.select("o_orderkey", F.col("o_totalprice"))
