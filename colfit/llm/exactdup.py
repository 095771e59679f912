"""Exact duplicates by skew-safe combining.

Rows meet in three steps, each of which compares the full text besides its SHA-256
digest: rows of a task are combined where they are read (Spark's partial aggregate),
the results of tasks meet under digest and salt, and the few winners of the salts
meet under the digest.  No task ever receives a row per copy of a hot text.

Results by case: a null text counts as the empty text; of equal texts the row with
the largest id stays, a null id being the smallest; rows that repeat text and id are
copies of each other of which one stays; a text of any length is compared whole, as it
stands in every key; an empty table gives no rows; other columns come back as they are,
whatever they are called.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colfit.llm.common import attach, cut

SALTS = 16


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _whole(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def _winners(rows: DataFrame, largest: Column) -> DataFrame:
    """Per distinct text of ``rows(digest, body, salt, best)``: the largest row and the count."""
    local = rows.groupBy("digest", "body", "salt").agg(
        F.max(largest).alias("best"), F.count("*").alias("copies")
    )
    return local.groupBy("digest", "body").agg(
        F.max("best").alias("best"), F.sum("copies").alias("group_size")
    )


def deduplicate(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row, whole, of each text: that with the largest id, all else equal the
    largest by the remaining columns in order."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select(
        digest(_whole()).alias("digest"),
        _whole().alias("body"),
        F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"),
        F.struct(
            F.col("doc_id").alias("doc_id"),
            F.col("text").isNotNull().alias("has_text"),
            *[F.col(f"`{c}`").alias(f"other{i}") for i, c in enumerate(others)],
        ).alias("best"),
    )
    source = {c: F.col(f"best.other{i}") for i, c in enumerate(others)}
    source["doc_id"] = F.col("best.doc_id")
    source["text"] = F.when(F.col("best.has_text"), F.col("body"))  # a null stays a null
    return _winners(rows, F.col("best")).select(*[source[c].alias(c) for c in docs.columns])


def mark_copies(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """Per row: ``doc_id, keep_id, group_size, kept, digest``.

    The winners carry the number of texts of their digest.  While that is one, as
    with SHA-256 it always was, a row finds its group by digest; should texts ever
    share a digest, rows are joined by the text as well.
    """
    rows = docs.select(
        "doc_id",
        digest(_whole()).alias("digest"),
        _whole().alias("body"),
        F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).alias("salt"),
    )
    winners = _winners(rows, F.col("doc_id")).withColumnRenamed("best", "keep_id")
    texts = winners.groupBy("digest").agg(
        F.count("*").alias("texts"),
        F.first("keep_id").alias("keep_id"),
        F.first("group_size").alias("group_size"),
    )
    groups = cut(texts)
    one = groups.where("texts > 1").isEmpty()
    columns = ["doc_id", "digest"] if one else ["doc_id", "digest", "body"]
    # Rows with the same id and text are numbered; the first may stay.
    again = F.row_number().over(Window.partitionBy(*columns).orderBy(F.lit(0)))
    numbered = rows.select(*columns).withColumn("again", again)
    if one:
        joined = attach(numbered, groups.drop("texts"), ["digest"])
    else:
        joined = numbered.join(winners, ["digest", "body"])
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("again") == 1)).alias("kept"),
        "digest",
    )

