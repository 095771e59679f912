"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colfit.session import shared_folder, ship_package

#: A word: a run of anything but blank, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"

#: Most rows of a table that is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS = 100_000

MASK_64 = (1 << 64) - 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared checkpoint folder.

    The wide coalesce moves nothing.  It makes Spark forget by which key the rows are
    partitioned: a later join then shuffles both sides, which adaptive execution can
    split where a key is hot.
    """
    shared_folder(df.sparkSession)
    return df.coalesce(1_000_000).checkpoint()


def attach(rows: DataFrame, facts: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join rows with a table, already cut, of one row per key.

    The facts are broadcast only if a count shows at most ``BROADCAST_ROWS`` of
    them.  Beyond that both sides are shuffled by key, and adaptive execution
    splits a partition that a hot key has made large.
    """
    if facts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        facts = F.broadcast(facts)
    return rows.join(facts, list(keys), how)


def map_batches(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | T.StructType,
) -> DataFrame:
    """``mapInArrow`` on workers that have this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def word_count(text: Column) -> Column:
    """Number of words of a text; none for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def id_text(doc_id: Column) -> Column:
    """The id as decimal text, empty for a null."""
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def remainder_of(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo the divisor."""
    return F.crc32(id_text(doc_id)) % F.lit(divisor)


def number_within(
    df: DataFrame, key: str, order: Sequence[str], name: str, buckets: int = 512
) -> DataFrame:
    """Number the rows of each key from 0 without gaps.

    ``df`` should be cut.  Rows are dealt into buckets by a hash of the order
    columns; a key's rows are counted by bucket and numbered inside the buckets,
    so that no task holds all rows of a key.
    """
    spread = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    running = Window.partitionBy(key).orderBy("_bucket")
    starts = (
        spread.groupBy(key, "_bucket")
        .agg(F.count("*").alias("_rows"))
        .select(key, "_bucket", (F.sum("_rows").over(running) - F.col("_rows")).alias("_start"))
    )
    inside = Window.partitionBy(key, "_bucket").orderBy(*order)
    placed = spread.withColumn("_place", F.row_number().over(inside) - 1)
    return (
        attach(placed, cut(starts), [key, "_bucket"])
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_bucket", "_start", "_place")
    )
