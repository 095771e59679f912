"""K-means."""

from __future__ import annotations

from pyspark.sql import functions as F

from colfit.models import RANDOM, KMeans, KMeansModel, MaxIter, Tol
from colfit.models.kmeans import euclidean_distance
from colfit.plans.registry import number, query, rounded, rounded_sql, with_ctes
from colfit.plans.views import CUS_FEATURES, CUS_SQL, customers, embeddings

USER = ((0.0, 5.0), (3.0, 12.0), (8.0, 20.0))
SEED = 7

_EQUIDISTANT_SQL = (
    "c0 AS (SELECT i AS centroid_id, a0 + i*((b0 - a0)/{k}) AS x0, a1 + i*((b1 - a1)/{k}) AS x1 "
    "FROM (SELECT min(x0) AS a0, max(x0) AS b0, min(x1) AS a1, max(x1) AS b1 FROM cus), "
    "range({k}) r(i))"
)


def _equidistant_sql(k: int) -> str:
    return _EQUIDISTANT_SQL.format(k=k)


def _assigned_sql(name: str, centroids: str) -> str:
    """Nearest centroid per row; the lowest number wins ties."""
    distance = "sqrt((p.x0 - c.x0)*(p.x0 - c.x0) + (p.x1 - c.x1)*(p.x1 - c.x1))"
    return (
        f"{name} AS (SELECT c_custkey, x0, x1, cluster, d FROM (SELECT p.c_custkey, p.x0, p.x1, "
        f"c.centroid_id AS cluster, {distance} AS d, row_number() OVER (PARTITION BY p.c_custkey "
        f"ORDER BY {distance}, c.centroid_id) AS rn FROM cus p, {centroids} c) WHERE rn = 1)"
    )


def _rounds_sql(rounds: int) -> list[str]:
    ctes = []
    for r in range(rounds):
        ctes.append(_assigned_sql(f"a{r}", f"c{r}"))
        ctes.append(
            f"c{r + 1} AS (SELECT c.centroid_id, coalesce(avg(a.x0), any_value(c.x0)) AS x0, "
            f"coalesce(avg(a.x1), any_value(c.x1)) AS x1 FROM c{r} c "
            f"LEFT JOIN a{r} a ON a.cluster = c.centroid_id GROUP BY c.centroid_id)"
        )
    return ctes


def _centroids_sql(source: str) -> str:
    return (
        f"SELECT CAST(centroid_id AS INTEGER) AS centroid_id, {rounded_sql('x0')} AS x0, "
        f"{rounded_sql('x1')} AS x1 FROM {source}"
    )


def _fitted_sql(first: str, rounds: int) -> str:
    return with_ctes([CUS_SQL, first, *_rounds_sql(rounds)], _centroids_sql(f"c{rounds}"))


def _centroids(spark, model: KMeansModel):
    return model.to_df(spark).select(
        "centroid_id",
        *[rounded(F.col("coords")[j]).alias(x) for j, x in enumerate(model.features)],
    )


def _five_rounds(spark, folder) -> KMeansModel:
    return KMeans(4, MaxIter(5)).fit(customers(spark, folder), CUS_FEATURES)


@query(
    "kmeans_equidistant_init",
    with_ctes([CUS_SQL, _equidistant_sql(4)], _centroids_sql("c0")),
)
def _equidistant_init(spark, folder):
    return _centroids(
        spark, KMeans(4, MaxIter(5)).initial(customers(spark, folder), CUS_FEATURES)
    )


def _unit_sql(*parts: str) -> str:
    """The uniform number in [0, 1) that belongs to a seed and position."""
    text = " || ':' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST(CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496"


@query(
    "kmeans_random_init",
    with_ctes(
        [
            CUS_SQL,
            "c0 AS (SELECT i AS centroid_id, "
            f"{_unit_sql(str(SEED), 'i', '0')} * (b0 - a0) + a0 AS x0, "
            f"{_unit_sql(str(SEED), 'i', '1')} * (b1 - a1) + a1 AS x1 FROM "
            "(SELECT min(x0) AS a0, max(x0) AS b0, min(x1) AS a1, max(x1) AS b1 FROM cus), "
            "range(4) r(i))",
        ],
        _centroids_sql("c0"),
    ),
)
def _random_init(spark, folder):
    kmeans = KMeans(4, MaxIter(5), RANDOM, SEED)
    return _centroids(spark, kmeans.initial(customers(spark, folder), CUS_FEATURES))


@query(
    "euclidean_distance",
    "WITH first AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = 0) "
    "SELECT vec_id, "
    + rounded_sql("list_distance(CAST(embedding AS DOUBLE[]), q)")
    + " AS distance FROM embeddings, first",
)
def _euclidean_distance(spark, folder):
    """Distance of every embedding to the one numbered 0, a vector of fixed length."""
    rows = embeddings(spark, folder)
    first = rows.filter("vec_id = 0").first()["x"]
    return rows.select(
        "vec_id", rounded(euclidean_distance(F.col("x"), F.lit(first))).alias("distance")
    )


@query(
    "kmeans_assign",
    with_ctes(
        [CUS_SQL, _equidistant_sql(4), _assigned_sql("a0", "c0")],
        "SELECT c_custkey, CAST(cluster AS INTEGER) AS cluster FROM a0",
    ),
)
def _assign(spark, folder):
    rows = customers(spark, folder)
    model = KMeans(4, MaxIter(5)).initial(rows, CUS_FEATURES)
    return model.assign(rows).select("c_custkey", "cluster")


@query("kmeans_update", _fitted_sql(_equidistant_sql(4), 1))
def _update(spark, folder):
    rows = customers(spark, folder)
    return _centroids(spark, KMeans(4, MaxIter(5)).initial(rows, CUS_FEATURES).update(rows))


@query("kmeans_fit_maxiter", _fitted_sql(_equidistant_sql(4), 5))
def _fit_maxiter(spark, folder):
    return _centroids(spark, _five_rounds(spark, folder))


_USER_SQL = "c0 AS (SELECT * FROM (VALUES {}) v(centroid_id, x0, x1))".format(
    ", ".join(f"({i}, {number(a)}, {number(b)})" for i, (a, b) in enumerate(USER))
)


@query("kmeans_user_fit", _fitted_sql(_USER_SQL, 3))
def _user_fit(spark, folder):
    model = KMeans(3, MaxIter(3), USER).fit(customers(spark, folder), CUS_FEATURES)
    return _centroids(spark, model)


def _tol_sql(tolerance: float, most: int) -> str:
    """The centroids of the first round in which no coordinate moved further."""
    moves = [
        f"SELECT {r} AS r, max(greatest(abs(n.x0 - o.x0), abs(n.x1 - o.x1))) AS move "
        f"FROM c{r} n JOIN c{r - 1} o USING (centroid_id)"
        for r in range(1, most + 1)
    ]
    rounds = [f"SELECT {r} AS r, * FROM c{r}" for r in range(1, most + 1)]
    return with_ctes(
        [
            CUS_SQL,
            _equidistant_sql(4),
            *_rounds_sql(most),
            f"moves AS ({' UNION ALL '.join(moves)})",
            f"stop AS (SELECT min(r) AS r FROM moves WHERE move <= {number(tolerance)})",
            f"final AS (SELECT a.* FROM ({' UNION ALL '.join(rounds)}) a JOIN stop USING (r))",
        ],
        _centroids_sql("final"),
    )


@query("kmeans_fit_tol", _tol_sql(0.5, 16))
def _fit_tol(spark, folder):
    return _centroids(spark, KMeans(4, Tol(0.5)).fit(customers(spark, folder), CUS_FEATURES))


_AFTER_FIVE = [CUS_SQL, _equidistant_sql(4), *_rounds_sql(5), _assigned_sql("near", "c5")]


@query(
    "kmeans_predict",
    with_ctes(_AFTER_FIVE, "SELECT c_custkey, CAST(cluster AS DOUBLE) AS clusters FROM near"),
)
def _predict(spark, folder):
    model = _five_rounds(spark, folder)
    return model.predict(customers(spark, folder)).select("c_custkey", "clusters")


@query(
    "kmeans_predict_unfitted",
    with_ctes(
        [CUS_SQL, _equidistant_sql(5), _assigned_sql("near", "c0")],
        "SELECT c_custkey, CAST(cluster AS DOUBLE) AS clusters FROM near",
    ),
)
def _predict_unfitted(spark, folder):
    rows = KMeans(5, MaxIter(5)).predict(customers(spark, folder), CUS_FEATURES)
    return rows.select("c_custkey", "clusters")


@query(
    "kmeans_compactness",
    with_ctes(_AFTER_FIVE, f"SELECT {rounded_sql('sum(d*d)')} AS compactness FROM near"),
)
def _compactness(spark, folder):
    model = _five_rounds(spark, folder)
    return model.compactness(customers(spark, folder)).select(
        rounded("compactness").alias("compactness")
    )
