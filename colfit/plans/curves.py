"""Precision, recall, F-score and areas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colfit.models.logistic import LogisticModel
from colfit.operators.curves import class_scores, confusion, curve_areas, threshold_curve
from colfit.plans.registry import number, query, rounded, rounded_sql, with_ctes
from colfit.plans.views import CLS_SQL, ORD_SQL, REG_FEATURES, cls, orders, table

COUNTS = ("tp", "fp", "fn", "tn")
RATIOS = ("precision", "recall", "f_score")
THRESHOLD = 0.3
MODEL = LogisticModel(REG_FEATURES, "y", -0.5, (0.2, 0.1, -0.1))

_RATIO_SQL = {
    "precision": "CASE WHEN tp + fp = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(tp AS DOUBLE) / (tp + fp) END",
    "recall": "CASE WHEN tp + fn = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(tp AS DOUBLE) / (tp + fn) END",
    "f_score": "CASE WHEN 2 * tp + fp + fn = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END",
}
_RATIOS_SQL = ", ".join(f"{rounded_sql(e)} AS {n}" for n, e in _RATIO_SQL.items())


def _ratios() -> list:
    return [rounded(c).alias(c) for c in RATIOS]


def _curve_sql(scored: str) -> list[str]:
    """CTE ``c(score, hits, misses, tp, fp, fn, tn)`` of ``scored(score, y)``."""
    return [
        f"d AS (SELECT score, count(*) FILTER (y = 1) AS hits, count(*) FILTER (y <> 1) AS misses FROM {scored} GROUP BY score)",
        "c AS (SELECT score, hits, misses, CAST(sum(hits) OVER w AS BIGINT) AS tp, CAST(sum(misses) OVER w AS BIGINT) AS fp, "
        "CAST(sum(hits) OVER () - sum(hits) OVER w AS BIGINT) AS fn, CAST(sum(misses) OVER () - sum(misses) OVER w AS BIGINT) AS tn "
        "FROM d WINDOW w AS (ORDER BY score DESC))",
    ]


_ORDER_SCORES = [ORD_SQL, "s AS (SELECT x0 AS score, y FROM ord)"]


@query(
    "threshold_curve",
    with_ctes([*_ORDER_SCORES, *_curve_sql("s")], f"SELECT score AS threshold, {', '.join(COUNTS)}, {_RATIOS_SQL} FROM c"),
)
def order_curve(spark: SparkSession, folder: str) -> DataFrame:
    return threshold_curve(orders(spark, folder), "x0", "y").select("threshold", *COUNTS, *_ratios())


# The logistic score before the sigmoid, whose ties are the same in both engines once rounded.
_SCORE = f"round_even(({number(-0.5)} + x0*{number(0.2)} + x1*{number(0.1)} + x2*{number(-0.1)}) * 1000, 0)"


def _logistic_scores(spark: SparkSession, folder: str) -> DataFrame:
    return cls(spark, folder).select(F.rint(MODEL.score * 1000).alias("score"), "y")


@query(
    "curve_areas",
    with_ctes(
        [CLS_SQL, f"s AS (SELECT {_SCORE} AS score, y FROM cls)", *_curve_sql("s")],
        f"SELECT {rounded_sql('sum(misses * (2 * tp - hits)) / (2.0 * sum(hits) * sum(misses))')} AS roc_area, "
        f"{rounded_sql('sum(CAST(hits AS DOUBLE) * tp / (tp + fp)) / sum(hits)')} AS average_precision, "
        f"{rounded_sql('max(2.0::DOUBLE * tp / (2 * tp + fp + fn))')} AS best_f_score, "
        "arg_max(score, struct_pack(f := 2.0::DOUBLE * tp / (2 * tp + fp + fn), s := score)) AS best_threshold FROM c",
    ),
)
def logistic_areas(spark: SparkSession, folder: str) -> DataFrame:
    areas = curve_areas(_logistic_scores(spark, folder), "score", "y")
    return areas.select(*[rounded(c).alias(c) for c in ("roc_area", "average_precision", "best_f_score")], "best_threshold")


@query(
    "confusion_at_threshold",
    with_ctes(
        [
            *_ORDER_SCORES,
            f"k AS (SELECT count(*) FILTER (score >= {number(THRESHOLD)} AND y = 1) AS tp, "
            f"count(*) FILTER (score >= {number(THRESHOLD)} AND y <> 1) AS fp, "
            f"count(*) FILTER (score < {number(THRESHOLD)} AND y = 1) AS fn, "
            f"count(*) FILTER (score < {number(THRESHOLD)} AND y <> 1) AS tn FROM s)",
        ],
        f"SELECT {', '.join(COUNTS)}, {_RATIOS_SQL} FROM k",
    ),
)
def order_confusion(spark: SparkSession, folder: str) -> DataFrame:
    return confusion(orders(spark, folder), "x0", "y", THRESHOLD).select(*COUNTS, *_ratios())


_CALLED = "least(floor(l_quantity / 13), 3)"


@query(
    "class_scores",
    with_ctes(
        [
            f"m AS (SELECT CAST({_CALLED} AS DOUBLE) AS p, CASE l_returnflag WHEN 'A' THEN 0.0 WHEN 'N' THEN 1.0 ELSE 2.0 END::DOUBLE AS y FROM lineitem)",
            "k AS (SELECT class, count(*) FILTER (p = class AND y = class) AS tp, count(*) FILTER (p = class AND y <> class) AS fp, "
            "count(*) FILTER (p <> class AND y = class) AS fn FROM m, (SELECT p AS class FROM m UNION SELECT y FROM m) GROUP BY class)",
        ],
        f"SELECT class, tp, fp, fn, {_RATIOS_SQL} FROM k",
    ),
)
def quantity_classes(spark: SparkSession, folder: str) -> DataFrame:
    flag = F.col("l_returnflag")
    rows = table(spark, folder, "lineitem").select(
        F.least(F.floor(F.col("l_quantity") / 13), F.lit(3)).cast("double").alias("p"),
        F.when(flag == "A", 0.0).when(flag == "N", 1.0).otherwise(2.0).alias("y"),
    )
    return class_scores(rows, "p", "y").select("class", "tp", "fp", "fn", *_ratios())
