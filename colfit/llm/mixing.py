"""Mix sources to target weights by Pareto order sampling.

A source of S words with a target of t words is taken t / S times: every document
gets floor(t / S) certain whole copies, and the rest of the target is drawn as one
more copy of some documents.  The draw ranks documents by

    odds of a random number / odds of inclusion

and takes the lowest ranks.  The size of the sample is fixed in words: the ranks are
taken while their words fit the rest of the target.  What then is left is less than
one document; further rounds fill it in the same order with documents that still fit.

Results by case: a null or empty text has size 0 and takes nothing; documents of a
null source form a source of their own, the last; rows that repeat id and size share
their random number, which is the only way for ranks to be equal, and are taken or left
together; a text of any length counts by all its words; an empty table gives no rows; the
columns of the input come back inside ``doc``, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colfit.llm.common import WORD, attach, cut, id_text, word_count

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: No source's target, so no document's words taken, is over this many times its size.
MOST_COPIES = 3
#: Documents of fewer words are half as likely, by their odds, to get the drawn copy.
SHORT_WORDS = 32
SHORT_PREFERENCE = 0.5
ROUNDS = 4
SEED = "mix-1:"
#: Parts of the rank scale by which words are summed to find where a sample ends.
RANK_PARTS = 2048
_DIGITS = 13  # hexadecimal digits of the random number: 52 bits


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def _rank(doc_id: Column, preference: Column) -> Column:
    """Odds of the random number over the preference, brought to 0..1.

    Within a source the odds of inclusion are the source's odds times the
    preference, so the source's factor doesn't change the order.
    """
    digits = F.substring(F.md5(F.concat(F.lit(SEED), id_text(doc_id))), 1, _DIGITS)
    uniform = (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(2.0**52)
    ratio = uniform / (F.lit(1.0) - uniform) / preference
    return ratio / (F.lit(1.0) + ratio)


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """Per source of ``sizes(key, source, size)``: its size and target in words.

    Sources share all words by weight; a target stops at ``MOST_COPIES`` times the
    source's size and the excess is shared again.  In the order of that limit over
    weight the sources that stop come first, so running sums give the final level.
    """
    per_source = sizes.groupBy("key", "source").agg(F.sum("size").cast("double").alias("source_size"))
    # One row per source from here on.
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % F.lit(len(weights))
    weighed = per_source.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    ).withColumn("most", F.lit(float(MOST_COPIES)) * F.col("source_size"))
    ratio = Window.orderBy(F.col("most") / F.col("weight"), "key")
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # While sources stop the level rises, and falls after, so its top is the final level.
    level = F.max(F.col("level")).over(whole)
    return (
        weighed.withColumn("level", left / weight_left)
        .withColumn("level", level)
        .select("key", "source_size", F.least("most", F.col("weight") * F.col("level")).alias("target"))
    )


def _drawn(size: Column, rank: Column) -> Column:
    return F.exists("draws", lambda d: (size <= d["limit"]) & (rank <= d["last"]))


def _draw(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """One round: per source the longest run of ranks whose words fit the gap."""
    open_rows = (
        attach(rows, facts, ["key"])
        .where((F.col("size") <= F.col("gap")) & ~_drawn(F.col("size"), F.col("rank")))
        .select("key", "size", "rank", "gap", F.floor(F.col("rank") * RANK_PARTS).alias("part"))
    )
    by_part = Window.partitionBy("key").orderBy("part")
    sums = (
        open_rows.groupBy("key", "part")
        .agg(F.sum("size").alias("words"), F.max("rank").alias("last"), F.first("gap").alias("gap"))
        .withColumn("end", F.sum("words").over(by_part))
    )
    fits = F.col("end") <= F.col("gap")
    ends = cut(
        sums.groupBy("key").agg(
            F.min(F.when(~fits, F.col("part"))).alias("open_part"),
            F.coalesce(F.max(F.when(fits, F.col("end"))), F.lit(0)).alias("base"),
            F.coalesce(F.max(F.when(fits, F.col("last"))), F.lit(-1.0)).alias("before"),
        )
    )
    # The part in which the gap closes, by rank.
    closing = attach(open_rows, ends, ["key"]).where(F.col("part") == F.col("open_part"))
    by_rank = Window.partitionBy("key").orderBy("rank")
    inside = (
        closing.withColumn("end", F.col("base") + F.sum("size").over(by_rank))
        .where(F.col("end") <= F.col("gap"))
        .groupBy("key")
        .agg(F.max("end").alias("inner_end"), F.max("rank").alias("inner_last"))
    )
    found = ends.join(inside, "key", "left").select(
        "key",
        F.coalesce("inner_end", "base").alias("words"),
        F.coalesce("inner_last", "before").alias("last"),
    )
    draw = F.struct(F.col("gap").alias("limit"), F.coalesce("last", F.lit(-1.0)).alias("last"))
    return cut(
        facts.join(found, "key", "left").select(
            "key",
            "source_size",
            "target",
            "whole",
            (F.col("gap") - F.coalesce("words", F.lit(0))).alias("gap"),
            F.concat("draws", F.array(draw)).alias("draws"),
        )
    )


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, rounds: int = ROUNDS
) -> DataFrame:
    """The documents as ``doc`` (a struct of all columns) and what the mix takes of them.

    Columns: ``doc, doc_id, size, source_size, target, copies, taken``; ``taken`` is
    copies times size.  The documents themselves are not shuffled: a row's copies
    follow from its own id and size and its source's few numbers.
    """
    rows = docs.select(
        F.struct("*").alias("doc"),
        _key(F.col("source")).alias("key"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        "doc_id",
    )
    short = F.col("size") < SHORT_WORDS
    rank = _rank(F.col("doc_id"), F.when(short, F.lit(SHORT_PREFERENCE)).otherwise(F.lit(1.0)))
    rows = rows.withColumn("rank", rank)
    narrow = cut(rows.select("key", "source", "size", "rank"))
    goals = targets(narrow, weights)
    some = F.col("source_size") > 0
    whole = F.when(some, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    facts = cut(
        goals.withColumn("whole", whole.cast("bigint")).select(
            "key",
            F.col("source_size").cast("bigint").alias("source_size"),
            "target",
            "whole",
            (F.col("target") - F.col("whole") * F.col("source_size")).alias("gap"),
            F.array().cast("array<struct<limit:double,last:double>>").alias("draws"),
        )
    )
    for _ in range(rounds):
        facts = _draw(narrow, facts)
    copies = F.col("whole") + _drawn(F.col("size"), F.col("rank")).cast("bigint")
    return (
        attach(rows, facts, ["key"])
        .withColumn("copies", copies)
        .select(
            "doc",
            "doc_id",
            "size",
            "source_size",
            "target",
            "copies",
            (F.col("copies") * F.col("size")).alias("taken"),
        )
    )


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """The documents as often as the mix takes them, with their own columns."""
    taken = mix(docs, weights).where("copies > 0")
    return taken.select(F.explode(F.array_repeat("doc", F.col("copies").cast("int"))).alias("doc")).select("doc.*")


def mixing_sql(rounds: int = ROUNDS, weights: Sequence[int] = WEIGHTS) -> str:
    """The same mix of the table ``documents`` in DuckDB SQL, by plain windows."""
    listed = ", ".join(f"{float(w)!r}::DOUBLE" for w in weights)
    ctes = [
        f"""d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
            (CAST('0x' || substr(md5('{SEED}' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, {_DIGITS}) AS BIGINT)
             + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u FROM documents)""",
        f"""e AS (SELECT *, u / (1::DOUBLE - u) / (CASE WHEN size < {SHORT_WORDS} THEN {SHORT_PREFERENCE}::DOUBLE
            ELSE 1::DOUBLE END) AS x FROM d)""",
        "r AS (SELECT doc_id, source, size, x / (1::DOUBLE + x) AS rank FROM e)",
        f"""s AS (SELECT source, sum(size)::DOUBLE AS source_size,
            [{listed}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)}] AS weight
            FROM r GROUP BY source)""",
        f"""l AS (SELECT *, {MOST_COPIES} * source_size AS most,
            (sum(source_size) OVER () - coalesce(sum({MOST_COPIES} * source_size) OVER w, 0)) /
            (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
            FROM s WINDOW w AS (ORDER BY {MOST_COPIES} * source_size / weight, source NULLS FIRST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
        "t AS (SELECT source, source_size, least(most, weight * max(level) OVER ()) AS target FROM l)",
        """f0 AS (SELECT source, source_size, target,
            CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t)""",
        "g0 AS (SELECT *, target - whole * source_size AS gap FROM f0)",
        "c0 AS (SELECT r.*, false AS drawn FROM r)",
    ]
    for k in range(rounds):
        ctes += [
            f"""o{k} AS (SELECT c.doc_id, c.source, c.rank, gap, sum(c.size) OVER (PARTITION BY c.source ORDER BY c.rank)
                AS run FROM c{k} c JOIN g{k} g ON c.source IS NOT DISTINCT FROM g.source
                WHERE NOT c.drawn AND c.size <= g.gap)""",
            f"""n{k} AS (SELECT source, max(rank) AS last, max(run) AS words FROM o{k} WHERE run <= gap GROUP BY source)""",
            f"""c{k + 1} AS (SELECT c.doc_id, c.source, c.size, c.rank,
                c.drawn OR coalesce(c.size <= g.gap AND c.rank <= n.last, false) AS drawn
                FROM c{k} c JOIN g{k} g ON c.source IS NOT DISTINCT FROM g.source
                LEFT JOIN n{k} n ON c.source IS NOT DISTINCT FROM n.source)""",
            f"""g{k + 1} AS (SELECT g.source, source_size, target, whole, gap - coalesce(n.words, 0) AS gap
                FROM g{k} g LEFT JOIN n{k} n ON g.source IS NOT DISTINCT FROM n.source)""",
        ]
    return f"""WITH {", ".join(ctes)}
        SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
               CAST((whole + CAST(drawn AS INT)) * size AS BIGINT) AS taken
        FROM c{rounds} c JOIN g{rounds} g ON c.source IS NOT DISTINCT FROM g.source"""
