"""Hierarchical clustering by single linkage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colfit.models.linkage import Linkage, fit_single_linkage
from colfit.plans.registry import number, query, rounded, rounded_sql, with_ctes
from colfit.plans.views import CUS_FEATURES, CUS_SQL, customers, table

HEIGHT = 0.12
CLUSTERS = 6

_SUP_SQL = "sup AS (SELECT s_suppkey AS k, s_acctbal/1000 AS x, CAST(s_nationkey AS DOUBLE) AS y FROM supplier)"

# A tree grown from the first point: of the others each knows its first edge into the tree.
_TREE_SQL = [
    _SUP_SQL,
    "pts AS (SELECT list(struct_pack(k := k, x := x, y := y) ORDER BY k) AS p FROM sup)",
    """grown AS (
        SELECT 0 AS step, list_transform(p[2:], lambda u: struct_pack(d := (u.x - p[1].x) * (u.x - p[1].x) + (u.y - p[1].y) * (u.y - p[1].y),
            a := least(p[1].k, u.k), b := greatest(p[1].k, u.k), k := u.k, x := u.x, y := u.y)) AS rest,
            CAST(NULL AS STRUCT(d DOUBLE, a BIGINT, b BIGINT, k BIGINT, x DOUBLE, y DOUBLE)) AS edge FROM pts
        UNION ALL
        SELECT step + 1, list_transform(list_filter(rest, lambda u: u.k <> m.k), lambda u: CASE
            WHEN struct_pack(d := (u.x - m.x) * (u.x - m.x) + (u.y - m.y) * (u.y - m.y), a := least(m.k, u.k), b := greatest(m.k, u.k))
                < struct_pack(d := u.d, a := u.a, b := u.b)
            THEN struct_pack(d := (u.x - m.x) * (u.x - m.x) + (u.y - m.y) * (u.y - m.y),
                a := least(m.k, u.k), b := greatest(m.k, u.k), k := u.k, x := u.x, y := u.y) ELSE u END), m
        FROM (SELECT step, rest, list_min(rest) AS m FROM grown WHERE len(rest) > 0))""",
    "edges AS (SELECT edge.a AS a, edge.b AS b, sqrt(edge.d) AS distance FROM grown WHERE edge IS NOT NULL)",
]


def _clusters_sql(points: str, edges: str) -> list[str]:
    """CTE ``named(key, cluster)`` of ``points(key)`` and ``edges(a, b)``."""
    return [
        f"ways AS (SELECT a, b FROM {edges} UNION ALL SELECT b, a FROM {edges})",
        f"reach AS (SELECT key, key AS root FROM {points} UNION SELECT w.b, r.root FROM reach r JOIN ways w ON r.key = w.a)",
        "named AS (SELECT key, min(root) AS cluster FROM reach GROUP BY key)",
    ]


def _suppliers(spark: SparkSession, folder: str) -> Linkage:
    rows = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("k"), (F.col("s_acctbal") / 1000).alias("x"), F.col("s_nationkey").cast("double").alias("y")
    )
    return fit_single_linkage(rows, ["x", "y"], "k")


@query("linkage_fit", with_ctes(_TREE_SQL, f"SELECT a, b, {rounded_sql('distance')} AS distance FROM edges", recursive=True))
def linkage_fit(spark: SparkSession, folder: str) -> DataFrame:
    return _suppliers(spark, folder).edges.select("a", "b", rounded("distance").alias("distance"))


@query(
    "linkage_cut_into",
    with_ctes(
        [
            *_TREE_SQL,
            f"light AS (SELECT a, b FROM (SELECT *, row_number() OVER (ORDER BY distance DESC, a DESC, b DESC) AS place FROM edges) WHERE place > {CLUSTERS - 1})",
            "ids AS (SELECT k AS key FROM sup)",
            *_clusters_sql("ids", "light"),
        ],
        "SELECT key, cluster FROM named",
        recursive=True,
    ),
)
def linkage_cut_into(spark: SparkSession, folder: str) -> DataFrame:
    return _suppliers(spark, folder).cut_into(CLUSTERS)


@query(
    "linkage_cut",
    with_ctes(
        [
            CUS_SQL,
            "ids AS (SELECT c_custkey AS key FROM cus)",
            "near AS (SELECT p.c_custkey AS a, q.c_custkey AS b FROM cus p JOIN cus q ON p.c_custkey < q.c_custkey "
            f"AND sqrt((p.x0 - q.x0) * (p.x0 - q.x0) + (p.x1 - q.x1) * (p.x1 - q.x1)) <= {number(HEIGHT)})",
            *_clusters_sql("ids", "near"),
        ],
        "SELECT key, cluster FROM named",
        recursive=True,
    ),
)
def linkage_cut(spark: SparkSession, folder: str) -> DataFrame:
    return fit_single_linkage(customers(spark, folder), list(CUS_FEATURES), "c_custkey").cut(HEIGHT)
