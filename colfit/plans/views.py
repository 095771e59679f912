"""Feature views over the test tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH = 64  # length of an embedding

REG_FEATURES = ("x0", "x1", "x2")
ORD_FEATURES = ("x0", "x1")
CUS_FEATURES = ("x0", "x1")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _line_features() -> list[Column]:
    return [
        (F.col("l_quantity") / 50).alias("x0"),
        (F.col("l_discount") * 10).alias("x1"),
        (F.col("l_tax") * 10).alias("x2"),
    ]


def reg(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with a price target."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        *_line_features(),
        (F.col("l_extendedprice") / 100000).alias("y"),
    )


def cls(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with a 0/1 target: returned or not."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        *_line_features(),
        (F.col("l_returnflag") == "R").cast("double").alias("y"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with a 0/1 target and a unique key."""
    return table(spark, folder, "orders").select(
        "o_orderkey",
        (F.col("o_totalprice") / 500000).alias("x0"),
        (F.pmod(F.col("o_custkey"), F.lit(10)) / 10).alias("x1"),
        (F.col("o_orderstatus") == "F").cast("double").alias("y"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        "c_custkey",
        (F.col("c_acctbal") / 1000).alias("x0"),
        F.col("c_nationkey").cast("double").alias("x1"),
    )


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("x"), "label"
    )


def part_column(spark: SparkSession, folder: str) -> DataFrame:
    """The retail price of every part as one long vector, with a target."""
    value = F.col("p_retailprice") / 1000
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("pos"),
        value.alias("value"),
        (F.lit(1.0) / (F.lit(1.0) + F.exp(-value))).alias("label"),
    )


_LINE_SQL = "l_orderkey, l_linenumber, l_quantity/50 AS x0, l_discount*10 AS x1, l_tax*10 AS x2"

REG_SQL = f"reg AS (SELECT {_LINE_SQL}, l_extendedprice/100000 AS y FROM lineitem)"
CLS_SQL = (
    f"cls AS (SELECT {_LINE_SQL}, CAST(l_returnflag = 'R' AS DOUBLE) AS y FROM lineitem)"
)
ORD_SQL = (
    "ord AS (SELECT o_orderkey, o_totalprice/500000 AS x0, (o_custkey % 10)/10 AS x1, "
    "CAST(o_orderstatus = 'F' AS DOUBLE) AS y FROM orders)"
)
CUS_SQL = (
    "cus AS (SELECT c_custkey, c_acctbal/1000 AS x0, CAST(c_nationkey AS DOUBLE) AS x1 "
    "FROM customer)"
)
COL_SQL = (
    "col AS (SELECT p_partkey AS pos, p_retailprice/1000 AS v, "
    "1.0/(1.0 + exp(-(p_retailprice/1000))) AS y FROM part)"
)
EMB_SQL = (
    "emb AS (SELECT vec_id, label, unnest(range(64)) AS pos, "
    "CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)"
)

# Layer parameters by position: (weight multiplier, modulus, offset, divisor) twice,
# for weights and biases.
LAYERS = (
    ((7, 11, 5, 100), (3, 7, 3, 10)),
    ((5, 13, 6, 50), (2, 5, 2, 10)),
)


def weight_at(layer: int, pos: int) -> float:
    return _formula(LAYERS[layer][0], pos)


def bias_at(layer: int, pos: int) -> float:
    return _formula(LAYERS[layer][1], pos)


def _formula(parts: tuple[int, int, int, int], pos: int) -> float:
    a, m, b, d = parts
    return ((pos * a) % m - b) / d


def layer_table(spark: SparkSession, folder: str, layer: int) -> DataFrame:
    """A layer as long as the part column."""
    pos = F.col("p_partkey")

    def column(parts: tuple[int, int, int, int]) -> Column:
        a, m, b, d = parts
        return (F.pmod(pos * a, F.lit(m)) - b) / d

    weight, bias = LAYERS[layer]
    return table(spark, folder, "part").select(
        pos.alias("pos"), column(weight).alias("weight"), column(bias).alias("bias")
    )


def layer_sql(layer: int, pos: str = "pos") -> tuple[str, str]:
    """Weight and bias at a position as SQL expressions."""

    def column(parts: tuple[int, int, int, int]) -> str:
        a, m, b, d = parts
        return f"((({pos}*{a}) % {m} - {b}) / {d})"

    weight, bias = LAYERS[layer]
    return column(weight), column(bias)
