"""Precision, recall, F-score and areas, at one threshold or at all.

A curve has a row for each distinct score.  Rows are first counted by score, so ties are one
and a hot score is one row.  The scores are then dealt out by ranges, sorted and kept;
sums inside a range are a window over that range, and those of the ranges before come from
one row a range.  No window or sort holds all scores.

Results by case: a row counts as positive if its label equals ``positive``; nulls raise, or
their rows are left out with ``handle_invalid="skip"``; NaN is the highest score; 0.0 and -0.0
are one score; a ratio of nothing to nothing is NaN; an empty table gives a curve without
rows, zeros at a threshold, and NaN areas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colfit.functions.numeric import double, ratio
from colfit.operators.stats import check_counts, check_invalid, require_columns
from colfit.session import shared_folder

#: Distinct scores that a range has on average.
RANGE_SCORES = 1_000_000


def _rows(df: DataFrame, score: str, label: str, positive: float, handle_invalid: str) -> DataFrame:
    """``score, hit``: hit is whether the row is positive."""
    check_invalid(handle_invalid)
    require_columns(df, [score, label])
    s, y = double(score), double(label)
    missing = s.isNull() | y.isNull()
    if handle_invalid == "skip":
        df = df.where(~missing)
    else:
        (nulls,) = df.agg(F.count_if(missing)).first()
        check_counts(1, nulls)
    return df.select((s + F.lit(0.0)).alias("score"), (y == F.lit(float(positive))).alias("hit"))


def _ratios(tp: Column, fp: Column, fn: Column) -> list[Column]:
    tp, fp, fn = (c.cast("double") for c in (tp, fp, fn))
    return [
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(tp * 2, tp * 2 + fp + fn).alias("f_score"),
    ]


def confusion(
    df: DataFrame, score: str, label: str, threshold: float, *, positive: float = 1.0, handle_invalid: str = "error"
) -> DataFrame:
    """``tp, fp, fn, tn, precision, recall, f_score`` if a score of at least the threshold is called positive."""
    rows = _rows(df, score, label, positive, handle_invalid)
    called, hit = F.col("score") >= F.lit(float(threshold)), F.col("hit")
    counts = {"tp": called & hit, "fp": called & ~hit, "fn": ~called & hit, "tn": ~called & ~hit}
    found = rows.agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    return found.select(*counts, *_ratios(F.col("tp"), F.col("fp"), F.col("fn")))


def class_scores(df: DataFrame, prediction: str, label: str, *, handle_invalid: str = "error") -> DataFrame:
    """``class, tp, fp, fn, precision, recall, f_score`` of every class that is predicted or a label."""
    check_invalid(handle_invalid)
    require_columns(df, [prediction, label])
    p, y = double(prediction), double(label)
    missing = p.isNull() | y.isNull()
    if handle_invalid == "skip":
        df = df.where(~missing)
    else:
        (nulls,) = df.agg(F.count_if(missing)).first()
        check_counts(1, nulls)
    met = df.select((p + F.lit(0.0)).alias("p"), (y + F.lit(0.0)).alias("y")).groupBy("p", "y").agg(F.count("*").alias("n"))
    same = F.col("p") == F.col("y")
    sides = F.explode(
        F.when(same, F.array(F.struct(F.col("p").alias("class"), F.lit("tp").alias("kind")))).otherwise(
            F.array(F.struct(F.col("p").alias("class"), F.lit("fp").alias("kind")), F.struct(F.col("y").alias("class"), F.lit("fn").alias("kind")))
        )
    )
    counted = met.select(sides.alias("side"), "n").select("side.class", "side.kind", "n")
    kinds = ("tp", "fp", "fn")
    sums = [F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(k) for k in kinds]
    return counted.groupBy("class").agg(*sums).select("class", *kinds, *_ratios(*map(F.col, kinds)))


def _counted(df: DataFrame, score: str, label: str, positive: float, handle_invalid: str) -> DataFrame:
    """``score, hits, misses, tp, fp, all_hits, all_misses``, a row for each distinct score.

    ``tp`` and ``fp`` are of all scores at least as high.
    """
    rows = _rows(df, score, label, positive, handle_invalid)
    shared_folder(df.sparkSession)
    distinct = rows.groupBy("score").agg(F.count_if("hit").alias("hits"), F.count_if(~F.col("hit")).alias("misses")).checkpoint()
    ranges = max(1, -(-distinct.count() // RANGE_SCORES))
    ranged = distinct.repartitionByRange(ranges, F.col("score").desc()).checkpoint().withColumn("part", F.spark_partition_id())
    totals = ranged.groupBy("part").agg(F.sum("hits").alias("h"), F.sum("misses").alias("m"))
    ordered = sorted(tuple(r) for r in totals.collect())  # a row a range
    before, hits, misses = [], 0, 0
    for part, h, m in ordered:
        before.append((part, hits, misses))
        hits, misses = hits + h, misses + m
    offsets = df.sparkSession.createDataFrame(before, "part int, tp_before bigint, fp_before bigint")
    inside = Window.partitionBy("part").orderBy(F.col("score").desc())
    return ranged.join(F.broadcast(offsets), "part").select(
        "score",
        "hits",
        "misses",
        (F.col("tp_before") + F.sum("hits").over(inside)).alias("tp"),
        (F.col("fp_before") + F.sum("misses").over(inside)).alias("fp"),
        F.lit(hits).cast("bigint").alias("all_hits"),
        F.lit(misses).cast("bigint").alias("all_misses"),
    )


def threshold_curve(df: DataFrame, score: str, label: str, *, positive: float = 1.0, handle_invalid: str = "error") -> DataFrame:
    """``threshold, tp, fp, fn, tn, precision, recall, f_score`` for every distinct score as threshold."""
    found = _counted(df, score, label, positive, handle_invalid)
    fn, tn = F.col("all_hits") - F.col("tp"), F.col("all_misses") - F.col("fp")
    counts = found.select(F.col("score").alias("threshold"), "tp", "fp", fn.alias("fn"), tn.alias("tn"))
    return counts.select("*", *_ratios(F.col("tp"), F.col("fp"), F.col("fn")))


def curve_areas(df: DataFrame, score: str, label: str, *, positive: float = 1.0, handle_invalid: str = "error") -> DataFrame:
    """One row: ``roc_area, average_precision, best_f_score, best_threshold``.

    The area under the curve of hits over misses is by trapezoids, so a tie counts half;
    average precision is that at each score weighted by its share of the hits; of equally
    good thresholds the highest is given.
    """
    found = _counted(df, score, label, positive, handle_invalid)
    hits, misses, tp, fp = (F.col(c).cast("double") for c in ("hits", "misses", "tp", "fp"))
    whole = F.col("misses").cast("decimal(38,0)") * (F.col("tp") * 2 - F.col("hits")).cast("decimal(19,0)")
    f_score = _ratios(F.col("tp"), F.col("fp"), F.col("all_hits") - F.col("tp"))[2]
    sums = found.agg(
        F.sum(whole.cast("decimal(38,0)")).cast("double").alias("area"),
        F.sum(hits * tp / (tp + fp)).alias("weighted"),
        F.max("all_hits").cast("double").alias("p"),
        F.max("all_misses").cast("double").alias("n"),
        F.max(F.struct(f_score.alias("f_score"), F.col("score").alias("score"))).alias("best"),
    )
    nan = F.lit(float("nan"))
    return sums.select(
        F.coalesce(ratio(F.col("area"), F.col("p") * F.col("n") * 2), nan).alias("roc_area"),
        F.coalesce(ratio(F.col("weighted"), F.col("p")), nan).alias("average_precision"),
        F.coalesce("best.f_score", nan).alias("best_f_score"),
        F.coalesce("best.score", nan).alias("best_threshold"),
    )
