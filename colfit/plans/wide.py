"""Models on all 64 dimensions of the embeddings, and softmax in its other forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colfit.functions.activations import SOFTMAX
from colfit.functions.numeric import array_sum
from colfit.models import KMeans, MaxIter, fit_linear, fit_logistic, fit_svm
from colfit.models.gradient import PER_FEATURE
from colfit.operators import softmax, softmax_group_jacobian, spread_vector
from colfit.plans.registry import number, query, rounded, rounded_sql, with_ctes
from colfit.plans.views import CUS_FEATURES, CUS_SQL, WIDTH, customers, embeddings, table

CLUSTERS = 8
ROUNDS = 3
RATE = 0.5

_EMB = (
    "emb AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x, "
    "label / 10.0::DOUBLE AS level, CAST(label % 2 AS DOUBLE) AS odd FROM embeddings)"
)


def _rows(spark, folder) -> tuple[DataFrame, list[str]]:
    rows = embeddings(spark, folder).select(
        "vec_id",
        "x",
        (F.col("label") / 10.0).alias("level"),
        (F.col("label") % 2).cast("double").alias("odd"),
    )
    return spread_vector(rows, "x", WIDTH)


def _epochs_sql(label: str, prediction: str, step: str, intercept_step: str, gate: str = "1") -> str:
    """Epochs as CTEs; ``prediction`` is of the score z, the steps averages of terms in y and p."""
    ctes = [_EMB, f"w0 AS (SELECT 0.0::DOUBLE AS b, list_transform(range({WIDTH}), lambda i: 0.0::DOUBLE) AS w)"]
    for r in range(ROUNDS):
        ctes += [
            f"s{r} AS (SELECT vec_id, x, {label} AS y, b + list_dot_product(x, w) AS z FROM emb, w{r})",
            f"e{r} AS (SELECT vec_id, x, y, {prediction} AS p FROM s{r})",
            f"h{r} AS (SELECT {gate} AS gate FROM e{r} ORDER BY vec_id LIMIT 1)",
            f"i{r} AS (SELECT {intercept_step} AS step FROM e{r})",
            f"u{r} AS (SELECT y, p, unnest(range({WIDTH})) AS pos, unnest(x) AS xj FROM e{r})",
            f"g{r} AS (SELECT pos, {step} AS step FROM u{r} GROUP BY pos)",
            f"w{r + 1} AS (SELECT any_value(w{r}.b) + any_value(i{r}.step) AS b, "
            f"list(w[pos + 1] + gate * g{r}.step ORDER BY pos) AS w FROM g{r}, w{r}, h{r}, i{r})",
        ]
    last = f"w{ROUNDS}"
    terms = (
        f"SELECT 'intercept' AS term, b AS value FROM {last} UNION ALL "
        f"SELECT 'x_' || CAST(pos AS VARCHAR), w[pos + 1] FROM {last}, range({WIDTH}) r(pos)"
    )
    return with_ctes(ctes, f"SELECT term, {rounded_sql('value')} AS value FROM ({terms})")


def _terms(spark, model) -> DataFrame:
    return model.to_df(spark).select("term", rounded("value").alias("value"))


@query(
    "linear_fit_embeddings",
    _epochs_sql("level", "z", f"{2 * RATE} * avg((y - p) * xj)", f"{2 * RATE} * avg(y - p)"),
)
def _linear(spark, folder):
    rows, names = _rows(spark, folder)
    return _terms(spark, fit_linear(rows, names, "level", ROUNDS, RATE, gradient=PER_FEATURE))


@query(
    "logistic_fit_embeddings",
    _epochs_sql("odd", "1 / (1 + exp(-z))", f"{RATE} * avg((y - p) * xj)", f"{2 * RATE} * avg(y - p)"),
)
def _logistic(spark, folder):
    rows, names = _rows(spark, folder)
    return _terms(spark, fit_logistic(rows, names, "odd", ROUNDS, RATE, gradient=PER_FEATURE))


@query(
    "svm_fit_embeddings",
    _epochs_sql(
        "odd",
        "z",
        f"{RATE} * avg(xj)",
        f"-{RATE} * avg(CAST(y - p > 0 AS DOUBLE))",
        "CAST(y - p > 0 AS DOUBLE)",
    ),
)
def _svm(spark, folder):
    rows, names = _rows(spark, folder)
    return _terms(spark, fit_svm(rows, names, "odd", ROUNDS, RATE, "vec_id"))


def _clusters_sql() -> list[str]:
    ctes = [
        _EMB,
        f"flat AS (SELECT vec_id, unnest(range({WIDTH})) AS pos, unnest(x) AS xj FROM emb)",
        "span AS (SELECT pos, min(xj) AS a, max(xj) AS b FROM flat GROUP BY pos)",
        f"c0 AS (SELECT i AS cid, list(a + i * ((b - a) / {CLUSTERS}) ORDER BY pos) AS c "
        f"FROM span, range({CLUSTERS}) r(i) GROUP BY i)",
    ]
    for r in range(ROUNDS + 1):
        ctes.append(
            f"a{r} AS (SELECT vec_id, cid FROM (SELECT vec_id, cid, row_number() OVER (PARTITION BY vec_id "
            f"ORDER BY list_distance(x, c), cid) AS rn FROM emb, c{r}) WHERE rn = 1)"
        )
        ctes.append(
            f"m{r} AS (SELECT cid, list(m ORDER BY pos) AS c FROM (SELECT cid, pos, avg(xj) AS m "
            f"FROM flat JOIN a{r} USING (vec_id) GROUP BY cid, pos) GROUP BY cid)"
        )
        ctes.append(f"c{r + 1} AS (SELECT o.cid, coalesce(n.c, o.c) AS c FROM c{r} o LEFT JOIN m{r} n USING (cid))")
    return ctes


def _fitted(spark, folder):
    rows, names = _rows(spark, folder)
    return rows, KMeans(CLUSTERS, MaxIter(ROUNDS)).fit(rows, names)


@query(
    "kmeans_fit_embeddings",
    with_ctes(
        _clusters_sql(),
        f"SELECT CAST(cid AS INTEGER) AS centroid_id, CAST(pos AS INTEGER) AS pos, {rounded_sql('v')} AS value "
        f"FROM (SELECT cid, unnest(range({WIDTH})) AS pos, unnest(c) AS v FROM c{ROUNDS})",
    ),
)
def _kmeans_fit(spark, folder):
    _, model = _fitted(spark, folder)
    coords = model.to_df(spark).select("centroid_id", F.posexplode("coords").alias("pos", "value"))
    return coords.select("centroid_id", "pos", rounded("value").alias("value"))


@query(
    "kmeans_predict_embeddings",
    with_ctes(_clusters_sql(), f"SELECT vec_id, CAST(cid AS DOUBLE) AS clusters FROM a{ROUNDS}"),
)
def _kmeans_predict(spark, folder):
    rows, model = _fitted(spark, folder)
    return model.predict(rows).select("vec_id", "clusters")


@query(
    "kmeans_compactness_unfitted",
    with_ctes(
        [
            CUS_SQL,
            "c0 AS (SELECT i AS cid, a0 + i*((b0 - a0)/4) AS x0, a1 + i*((b1 - a1)/4) AS x1 FROM "
            "(SELECT min(x0) AS a0, max(x0) AS b0, min(x1) AS a1, max(x1) AS b1 FROM cus), range(4) r(i))",
            "near AS (SELECT min((p.x0 - c.x0)*(p.x0 - c.x0) + (p.x1 - c.x1)*(p.x1 - c.x1)) AS d "
            "FROM cus p, c0 c GROUP BY c_custkey)",
        ],
        f"SELECT {rounded_sql('sum(d)')} AS compactness FROM near",
    ),
)
def _compactness_unfitted(spark, folder):
    found = KMeans(4, MaxIter(1)).compactness(customers(spark, folder), CUS_FEATURES)
    return found.select(rounded("compactness").alias("compactness"))


@query(
    "act_softmax_by_order",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, "
    + rounded_sql("exp(l_quantity/50) / sum(exp(l_quantity/50)) OVER (PARTITION BY l_orderkey)")
    + " AS activated_values FROM lineitem",
)
def _softmax_by_order(spark, folder):
    """More groups than are broadcast."""
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", (F.col("l_quantity") / 50).alias("x")
    )
    found = softmax(rows, "x", ["l_orderkey"])
    return found.withColumn("activated_values", rounded("activated_values")).drop("x")


_SHARES = (
    "share AS (SELECT vec_id, list_transform(x, lambda v: exp(v) / list_sum(list_transform(x, lambda u: exp(u)))) AS s "
    "FROM emb)"
)


@query(
    "act_softmax_embeddings",
    with_ctes(
        [_EMB, _SHARES],
        f"SELECT vec_id, CAST(pos AS INTEGER) AS pos, {rounded_sql('v')} AS value "
        f"FROM (SELECT vec_id, unnest(range({WIDTH})) AS pos, unnest(s) AS v FROM share)",
    ),
)
def _softmax_embeddings(spark, folder):
    found = embeddings(spark, folder).select("vec_id", F.posexplode(SOFTMAX.activate_array(F.col("x"))).alias("pos", "v"))
    return found.select("vec_id", "pos", rounded("v").alias("value"))


@query(
    "grad_softmax_embeddings",
    with_ctes(
        [_EMB, _SHARES],
        f"SELECT vec_id, CAST(i AS INTEGER) AS i, {rounded_sql('s[i + 1] * (1 - s[i + 1])')} AS own, "
        + rounded_sql(f"-s[i + 1] * s[(i + 1) % {WIDTH} + 1]")
        + f" AS following, {rounded_sql('list_sum(row)')} AS row_sum, "
        + rounded_sql("list_sum(list_transform(row, lambda v: v * v)) * 1000")
        + " AS row_squares, "
        + rounded_sql(f"list_sum(list_transform(range({WIDTH}), lambda j: (j + 1) * row[j + 1]))")
        + f" AS row_moment FROM (SELECT vec_id, i, s, list_transform(range({WIDTH}), lambda j: "
        + f"CASE WHEN j = i THEN s[i + 1] * (1 - s[i + 1]) ELSE -s[i + 1] * s[j + 1] END) AS row FROM share, range({WIDTH}) r(i))",
    ),
)
def _softmax_gradient_embeddings(spark, folder):
    """Of every row of the Jacobian the diagonal value, the one after it, and sums over all its values."""
    n = F.lit(WIDTH)
    rows = embeddings(spark, folder).select("vec_id", SOFTMAX.gradient_array(F.col("x")).alias("j"))
    rows = rows.select("vec_id", "j", F.explode(F.sequence(F.lit(0), n - 1)).alias("i"))
    row = F.slice("j", F.col("i") * n + 1, n)
    moment = F.transform(row, lambda v, j: v * (j + 1))
    return rows.select(
        "vec_id",
        "i",
        rounded(F.get("j", F.col("i") * n + F.col("i"))).alias("own"),
        rounded(F.get("j", F.col("i") * n + (F.col("i") + 1) % n)).alias("following"),
        rounded(array_sum(row)).alias("row_sum"),
        rounded(array_sum(F.transform(row, lambda v: v * v)) * 1000).alias("row_squares"),
        rounded(array_sum(moment)).alias("row_moment"),
    )


@query(
    "grad_softmax_groups",
    with_ctes(
        [
            "v AS (SELECT s_nationkey AS g, s_suppkey AS k, s_acctbal / 1000 AS x FROM supplier)",
            "e AS (SELECT g, k, exp(x - max(x) OVER (PARTITION BY g)) AS e FROM v)",
            "s AS (SELECT g, k, e / sum(e) OVER (PARTITION BY g) AS s FROM e)",
        ],
        "SELECT a.g AS s_nationkey, a.k AS i, b.k AS j, "
        + rounded_sql("CASE WHEN a.k = b.k THEN a.s * (1 - a.s) ELSE -a.s * b.s END")
        + " AS value FROM s a JOIN s b USING (g)",
    ),
)
def _softmax_gradient_groups(spark, folder):
    """The Jacobian over the suppliers of each nation."""
    rows = table(spark, folder, "supplier").select("s_nationkey", "s_suppkey", (F.col("s_acctbal") / 1000).alias("x"))
    found = softmax_group_jacobian(rows, "x", ["s_nationkey"], "s_suppkey")
    return found.withColumn("value", rounded("value"))
