"""Decision trees and random forests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colfit.models import CLASSIFICATION, REGRESSION, fit_forest, fit_tree
from colfit.models.tree import LEAST_GAIN, POISSON, TreeModel
from colfit.plans.registry import number, query, rounded, rounded_sql, with_ctes
from colfit.plans.views import table

FEATURES = ("x0", "x1", "x2", "x3")
BINS = 16
LEAST_ROWS = 20
UNIT = 1e-6
SEED = 11
TREES = 4
DEPTH = 4

_SQL = (
    "src AS (SELECT row_number() OVER () AS id, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS key, "
    "l_quantity/50 AS x0, l_discount*10 AS x1, l_tax*10 AS x2, l_extendedprice/100000 AS x3, "
    "CASE l_returnflag WHEN 'A' THEN 0.0 WHEN 'N' THEN 1.0 ELSE 2.0 END::DOUBLE AS flag, l_extendedprice/100000 + l_discount AS price "
    "FROM lineitem)"
)


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return table(spark, folder, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("key"),
        (F.col("l_quantity") / 50).alias("x0"),
        (F.col("l_discount") * 10).alias("x1"),
        (F.col("l_tax") * 10).alias("x2"),
        (F.col("l_extendedprice") / 100000).alias("x3"),
        F.when(flag == "A", 0.0).when(flag == "N", 1.0).otherwise(2.0).alias("flag"),
        (F.col("l_extendedprice") / 100000 + F.col("l_discount")).alias("price"),
    )


def _uniform_sql(*parts: str) -> str:
    text = " || ':' || ".join(parts)
    return f"(CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) / {number(float(16**13))})"


def _grown_sql(
    features: Sequence[str], label: str, classes: Sequence[float], depth: int, trees: int | None, chosen: int | None
) -> list[str]:
    """CTEs that end with rows in their leaves, ``r<depth>(id, tree, node, y, w, bins)``, and splits ``b<level>``."""
    k, width = len(features), len(classes) or 2
    limits = ", ".join(f"min({x}) AS lo{i}, max({x}) AS hi{i}" for i, x in enumerate(features))
    bins = ", ".join(
        f"len(list_filter(range(1, {BINS}), lambda b: {x} >= lo{i} + (hi{i} - lo{i}) * b / {BINS}))" for i, x in enumerate(features)
    )
    y = f"list_position({[float(c) for c in classes]}, {label}) - 1" if classes else f"CAST(round_even({label} / {number(UNIT)}, 0) AS BIGINT)"
    weight = "1"
    if trees:
        u = _uniform_sql(f"'{SEED}'", "'row'", "CAST(tree AS VARCHAR)", "key")
        weight = f"len(list_filter([{', '.join(number(c) for c in POISSON)}], lambda c: u >= c))"
    drawn = f"SELECT *, {_uniform_sql(f"'{SEED}'", "'row'", 'CAST(tree AS VARCHAR)', 'key') if trees else '0.0'} AS u FROM lim, src, range({trees or 1}) t(tree)"
    ctes = [
        _SQL,
        f"lim AS (SELECT {limits} FROM src)",
        f"u AS MATERIALIZED ({drawn})",
        f"r0 AS MATERIALIZED (SELECT id, tree, 1 AS node, {y} AS y, {weight} AS w, [{bins}] AS bins FROM u)",
    ]
    stat = [f"(CASE WHEN y = {c} THEN w ELSE 0 END)" for c in range(width)] if classes else ["w", "w * y"]

    def size(of: str) -> str:
        return "(" + " + ".join(f"{of}{s}" for s in range(width)) + ")" if classes else f"{of}0"

    def purity(of: str) -> str:
        squares = [f"{of}{s} * {of}{s}" for s in (range(width) if classes else [1])]
        return f"(({' + '.join(squares)}) / {size(of)})"

    for d in range(depth):
        kept = f"SELECT * FROM cells{d}"
        if chosen:
            order = _uniform_sql(f"'{SEED}'", "'feature'", "CAST(tree AS VARCHAR)", "CAST(node AS VARCHAR)", "CAST(f AS VARCHAR)")
            kept = (
                f"SELECT c.* FROM cells{d} c JOIN (SELECT tree, node, f FROM (SELECT *, row_number() OVER (PARTITION BY tree, node "
                f"ORDER BY h, f) AS place FROM (SELECT *, {order} AS h FROM (SELECT DISTINCT tree, node FROM cells{d}), range({k}) g(f))) "
                f"WHERE place <= {chosen}) USING (tree, node, f)"
            )
        sums = ", ".join(f"sum({e}) AS s{s}" for s, e in enumerate(stat))
        left = ", ".join(f"CAST(sum(s{s}) OVER (PARTITION BY tree, node, f ORDER BY bin) AS DOUBLE) AS l{s}" for s in range(width))
        whole = ", ".join(f"CAST(sum(s{s}) OVER (PARTITION BY tree, node, f) AS DOUBLE) AS t{s}" for s in range(width))
        right = ", ".join(f"t{s} - l{s} AS q{s}" for s in range(width))
        ctes += [
            f"cells{d} AS (SELECT tree, node, f, bin, {sums} FROM (SELECT tree, node, y, w, unnest(range({k})) AS f, unnest(bins) AS bin "
            f"FROM r{d} WHERE w > 0) GROUP BY ALL)",
            f"sum{d} AS (SELECT *, {right} FROM (SELECT tree, node, f, bin, {left}, {whole} FROM ({kept})))",
            f"score{d} AS (SELECT *, {purity('l')} + {purity('q')} AS score, {purity('t')} AS none FROM sum{d} "
            f"WHERE {size('l')} >= {LEAST_ROWS} AND {size('q')} >= {LEAST_ROWS})",
            f"b{d} AS MATERIALIZED (SELECT tree, node, f, bin FROM (SELECT *, row_number() OVER (PARTITION BY tree, node "
            f"ORDER BY score DESC, f, bin) AS place FROM score{d} WHERE score > none * {number(1 + LEAST_GAIN)}) WHERE place = 1)",
            f"r{d + 1} AS MATERIALIZED (SELECT id, r.tree, CASE WHEN b.f IS NULL THEN r.node "
            f"ELSE 2 * r.node + CAST(bins[b.f + 1] > b.bin AS INT) END AS node, y, w, bins "
            f"FROM r{d} r LEFT JOIN b{d} b ON b.tree = r.tree AND b.node = r.node)",
        ]
    stats = ", ".join(f"sum({e}) AS s{s}" for s, e in enumerate(stat))
    value = (
        f"({[float(c) for c in classes]})[list_position([{', '.join(f's{s}' for s in range(width))}], "
        f"greatest({', '.join(f's{s}' for s in range(width))}))]"
        if classes
        else f"CASE WHEN s0 = 0 THEN 0.0 ELSE CAST(s1 AS DOUBLE) / s0 * {number(UNIT)} END"
    )
    every = " UNION ".join(f"SELECT tree, node, id, y, w FROM r{d}" for d in range(depth + 1))
    ctes.append(
        f"nodes AS MATERIALIZED (SELECT tree, node, CAST({size('s')} AS BIGINT) AS rows, CAST({value} AS DOUBLE) AS value "
        f"FROM (SELECT tree, node, {stats} FROM ({every}) GROUP BY tree, node))"
    )
    return ctes


def _nodes_sql(features: Sequence[str], *args) -> str:
    depth = args[2]
    splits = " UNION ALL ".join(f"SELECT * FROM b{d}" for d in range(depth))
    low = "[" + ", ".join(f"lo{i}" for i in range(len(features))) + "][f + 1]"
    high = low.replace("lo", "hi")
    threshold = f"{low} + ({high} - {low}) * (bin + 1) / {BINS}"
    return with_ctes(
        _grown_sql(features, *args),
        f"SELECT nodes.tree, nodes.node, {list(features)}[f + 1] AS feature, {rounded_sql(threshold)} AS threshold, "
        f"rows, {rounded_sql('value')} AS value FROM lim, nodes LEFT JOIN (SELECT DISTINCT * FROM ({splits})) b "
        "ON b.tree = nodes.tree AND b.node = nodes.node WHERE rows > 0",
    )


def _nodes(spark: SparkSession, model: TreeModel) -> DataFrame:
    nodes = model.to_df(spark)
    return nodes.select("tree", "node", "feature", rounded("threshold").alias("threshold"), "rows", rounded("value").alias("value"))


CLASSES = (0.0, 1.0, 2.0)
_VALUES = FEATURES[:3]
_CLASS_TREE = (FEATURES, "flag", CLASSES, DEPTH, None, None)
_VALUE_TREE = (_VALUES, "price", (), DEPTH, None, None)
_CLASS_FOREST = (FEATURES, "flag", CLASSES, 3, TREES, 2)
_VALUE_FOREST = (_VALUES, "price", (), 3, TREES, 1)
_OPTIONS = {"bins": BINS, "least_rows": LEAST_ROWS, "resolution": UNIT}


def _class_tree(lines: DataFrame) -> TreeModel:
    return fit_tree(lines, FEATURES, "flag", CLASSIFICATION, depth=DEPTH, **_OPTIONS)


def _value_tree(lines: DataFrame) -> TreeModel:
    return fit_tree(lines, _VALUES, "price", REGRESSION, depth=DEPTH, **_OPTIONS)


def _class_forest(lines: DataFrame) -> TreeModel:
    return fit_forest(lines, FEATURES, "flag", CLASSIFICATION, key="key", trees=TREES, features_per_node=2, seed=SEED, depth=3, **_OPTIONS)


def _value_forest(lines: DataFrame) -> TreeModel:
    return fit_forest(lines, _VALUES, "price", REGRESSION, key="key", trees=TREES, seed=SEED, depth=3, **_OPTIONS)


@query("tree_fit_classes", _nodes_sql(*_CLASS_TREE))
def tree_fit_classes(spark: SparkSession, folder: str) -> DataFrame:
    return _nodes(spark, _class_tree(_lines(spark, folder)))


@query("tree_fit_values", _nodes_sql(*_VALUE_TREE))
def tree_fit_values(spark: SparkSession, folder: str) -> DataFrame:
    return _nodes(spark, _value_tree(_lines(spark, folder)))


@query("forest_fit_classes", _nodes_sql(*_CLASS_FOREST))
def forest_fit_classes(spark: SparkSession, folder: str) -> DataFrame:
    return _nodes(spark, _class_forest(_lines(spark, folder)))


@query("forest_fit_values", _nodes_sql(*_VALUE_FOREST))
def forest_fit_values(spark: SparkSession, folder: str) -> DataFrame:
    return _nodes(spark, _value_forest(_lines(spark, folder)))


def _leaves(depth: int) -> str:
    return f"SELECT r.id, r.tree, value FROM r{depth} r JOIN nodes USING (tree, node)"


@query(
    "tree_predict",
    with_ctes(
        _grown_sql(*_CLASS_TREE),
        f"SELECT key, flag, value AS prediction, count(*) AS n FROM src JOIN ({_leaves(DEPTH)}) USING (id) GROUP BY ALL",
    ),
)
def tree_predict(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder)
    scored = _class_tree(lines).predict(lines)
    return scored.groupBy("key", "flag", "prediction").agg(F.count("*").alias("n"))


@query(
    "tree_accuracy",
    with_ctes(
        [*_grown_sql(*_VALUE_TREE), f"p AS (SELECT price, value FROM src JOIN ({_leaves(DEPTH)}) USING (id))"],
        f"SELECT {rounded_sql('1 - sum((price - value) * (price - value)) / sum((price - m) * (price - m))')} AS accuracy "
        "FROM p, (SELECT avg(price) AS m FROM src)",
    ),
)
def tree_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder)
    return _value_tree(lines).accuracy(lines).select(rounded("accuracy").alias("accuracy"))


_VOTED = (
    "v AS (SELECT id, value AS prediction FROM (SELECT id, value, row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, value) AS place "
    f"FROM ({_leaves(3)}) GROUP BY id, value) WHERE place = 1)"
)


@query(
    "forest_predict_classes",
    with_ctes(
        [*_grown_sql(*_CLASS_FOREST), _VOTED], "SELECT key, flag, prediction, count(*) AS n FROM src JOIN v USING (id) GROUP BY ALL"
    ),
)
def forest_predict_classes(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder)
    scored = _class_forest(lines).predict(lines)
    return scored.groupBy("key", "flag", "prediction").agg(F.count("*").alias("n"))


@query(
    "forest_accuracy",
    with_ctes(
        [*_grown_sql(*_CLASS_FOREST), _VOTED],
        f"SELECT {rounded_sql('avg(CAST(flag = prediction AS DOUBLE))')} AS accuracy FROM src JOIN v USING (id)",
    ),
)
def forest_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder)
    return _class_forest(lines).accuracy(lines).select(rounded("accuracy").alias("accuracy"))


@query(
    "forest_predict_values",
    with_ctes(
        _grown_sql(*_VALUE_FOREST),
        f"SELECT key, {rounded_sql('prediction')} AS prediction, count(*) AS n FROM src JOIN "
        f"(SELECT id, sum(value) / {TREES} AS prediction FROM ({_leaves(3)}) GROUP BY id) USING (id) GROUP BY ALL",
    ),
)
def forest_predict_values(spark: SparkSession, folder: str) -> DataFrame:
    lines = _lines(spark, folder)
    scored = _value_forest(lines).predict(lines)
    return scored.groupBy("key", rounded("prediction").alias("prediction")).agg(F.count("*").alias("n"))
