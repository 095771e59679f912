"""Softmax over a whole column, over groups of rows, or over the columns of a row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colfit.functions.activations import ACTIVATED, GRADIENTS, SOFTMAX
from colfit.functions.numeric import double, ratio, total
from colfit.operators.stats import require_columns
from colfit.session import persisted, shared_folder

# Group totals are broadcast up to this many groups.
BROADCAST_GROUPS = 10_000
# A group of more rows than this is not joined by shuffle, whatever the table's size.
LARGE_ROWS = 1_000_000
# Rows of a large group in one array of its Jacobian, on average; two arrays make a unit of cells.
JACOBIAN_TILE_ROWS = 1_000
# Cells of a Jacobian that one task yields, on average, once its groups are cut.
TASK_CELLS = 2_000_000
# If more groups than this have so many rows none is broadcast; then no group is a
# large part of the table either.
MOST_LARGE_GROUPS = 1_000_000


def softmax(
    df: DataFrame, value: str, by: Sequence[str] = (), column: str = ACTIVATED
) -> DataFrame:
    """``exp(x) / sum(exp(x))`` with the sum taken over the rows of each group.

    The sums are pre-aggregated on the map side, so a group of any size is one
    small row.  They return to the rows by broadcast join while there are at
    most ``BROADCAST_GROUPS`` groups.  With more, the groups of more than
    ``LARGE_ROWS`` rows are broadcast, a millionth of the table's rows at most,
    and the rest, none of them large, join by shuffle.
    """
    require_columns(df, [value, *by])
    x = double(value)
    if not by:
        return df.withColumn(column, SOFTMAX.over_column(df, x))

    names = [f"__by{i}" for i in range(len(by))]
    totals = df.groupBy(*[F.col(f"`{b}`").alias(n) for b, n in zip(by, names, strict=True)]).agg(
        F.sum(F.exp(x)).alias("__total"), F.count("*").alias("__rows")
    )
    same = _same(by, names)
    helpers = [*names, "__total", "__rows"]

    def scored(joined: DataFrame) -> DataFrame:
        return joined.withColumn(column, SOFTMAX.activate(x, F.col("__total"))).drop(*helpers)

    spark = df.sparkSession
    with persisted(totals):
        few = totals.limit(BROADCAST_GROUPS + 1).collect()
        if len(few) <= BROADCAST_GROUPS:
            small = spark.createDataFrame(few, totals.schema)
            return scored(df.join(F.broadcast(small), same))
        shared_folder(spark)
        totals = totals.checkpoint()

    large = totals.filter(F.col("__rows") > LARGE_ROWS).limit(MOST_LARGE_GROUPS + 1).collect()
    if not large or len(large) > MOST_LARGE_GROUPS:
        return scored(df.join(totals, same))
    hot = F.broadcast(spark.createDataFrame(large, totals.schema))
    rest = df.join(hot, same, "left_anti").join(totals, same)
    return scored(df.join(hot, same)).unionByName(scored(rest))


def softmax_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace the columns by their softmax within each row."""
    return _shares(df, columns, None).drop("__total")


def softmax_jacobian(
    df: DataFrame, columns: Sequence[str], column: str = GRADIENTS
) -> DataFrame:
    """The columns' softmax Jacobian within each row, as ``column_0, column_1, ...``.

    Row-major, n*n columns for n.  Values are shifted by their maximum first.
    For longer vectors use an array and ``Softmax.gradient_array``.
    """
    names = [f"__share{i}" for i in range(len(columns))]
    inputs = df.withColumns({n: double(c) for n, c in zip(names, columns, strict=True)})
    most = F.greatest(*[F.col(n) for n in names]) if len(names) > 1 else F.col(names[0])
    shares = _shares(inputs.withColumn("__most", most), names, F.col("__most"))
    cells = [
        F.col(a) * (F.lit(1.0) - F.col(a)) if a == b else -F.col(a) * F.col(b)
        for a in names
        for b in names
    ]
    return shares.withColumns({f"{column}_{i}": c for i, c in enumerate(cells)}).drop(
        "__total", "__most", *names
    )


def softmax_group_jacobian(
    df: DataFrame, value: str, by: Sequence[str], key: str, most_rows: int | None = None
) -> DataFrame:
    """The softmax Jacobian over the rows of each group: ``by..., i, j, value`` for two keys of a group.

    A group of n rows has n*n cells.  If a group is larger than ``JACOBIAN_TILE_ROWS`` the
    groups are cut into arrays of about that many rows by a hash of their keys, and every two
    arrays of a group are a unit of cells; units are dealt over the tasks, so that neither
    memory nor the longest task grows with a group.  With ``most_rows`` a group of more rows
    raises; a key that is null or repeats in its group always does.  Values are
    shifted by their group's maximum first.  A null value makes its row's and column's cells
    null and adds nothing to the total; a null in ``by`` is a group; no rows give none.
    """
    require_columns(df, [value, key, *by])
    names = [f"__by{i}" for i in range(len(by))]
    rows = df.select(*[F.col(f"`{b}`").alias(n) for b, n in zip(by, names, strict=True)], F.col(f"`{key}`").alias("k"), double(value).alias("x"))
    keys = rows.groupBy(*names, "k").agg(F.count("*").alias("n"))
    sizes = keys.groupBy(*names).agg(F.sum("n").alias("n"), F.max("n").alias("times"), F.count_if(F.col("k").isNull()).alias("null"))
    squares = F.sum(F.col("n").cast("double") * F.col("n"))
    largest, times, nulls, cells = sizes.agg(F.max("n"), F.max("times"), F.sum("null"), squares).first()
    if largest is None:
        largest, times, nulls, cells = 0, 1, 0, 0.0
    if nulls or times > 1:
        raise ValueError(f"key {key!r} must be there and unique in its group")
    if most_rows is not None and largest > most_rows:
        raise ValueError(f"a group has {largest} rows, more than {most_rows}")
    tiles = max(1, -(-largest // JACOBIAN_TILE_ROWS))
    shares = _tiled_shares(rows, names, tiles)
    others = [f"__to{i}" for i in range(len(by))]
    tile_i = shares.toDF(*names, "tile_i", "k_i", "s_i")
    tile_j = shares.toDF(*others, "tile_j", "k_j", "s_j")
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(o)) for n, o in zip(names, others, strict=True)], F.lit(True))
    units = tile_i.join(tile_j, same).drop(*others)
    if tiles > 1:
        units = units.repartition(1 + int(cells // TASK_CELLS), *names, "tile_i", "tile_j")
    first = units.select(*names, "tile_i", "tile_j", "k_i", "k_j", "s_j", F.posexplode("s_i").alias("at_i", "a"))
    first = first.withColumn("i", F.get("k_i", F.col("at_i"))).drop("k_i")
    pairs = first.select(*names, "tile_i", "tile_j", "at_i", "i", "a", "k_j", F.posexplode("s_j").alias("at_j", "b"))
    own = F.col("a") * (F.lit(1.0) - F.col("a"))
    diagonal = (F.col("tile_i") == F.col("tile_j")) & (F.col("at_i") == F.col("at_j"))
    return pairs.select(
        *[F.col(n).alias(b) for b, n in zip(by, names, strict=True)],
        "i",
        F.get("k_j", F.col("at_j")).alias("j"),
        F.when(diagonal, own).otherwise(-F.col("a") * F.col("b")).alias("value"),
    )


def _tiled_shares(rows: DataFrame, names: Sequence[str], tiles: int) -> DataFrame:
    """``names..., tile, k, s``: keys of a group's tile in order and their shares of the group's sum.

    Sums run in the order of keys in a tile, then of tiles, whatever the partitions.
    """
    group = Window.partitionBy(*names)
    tile = F.pmod(F.xxhash64("k"), F.lit(tiles)).cast("int")
    parts = rows.groupBy(*names, tile.alias("tile")).agg(F.array_sort(F.collect_list(F.struct("k", "x"))).alias("rows"))
    parts = parts.withColumn("most", F.max(F.array_max("rows.x")).over(group))
    exps = parts.select(*names, "tile", F.col("rows.k").alias("k"), F.transform("rows", lambda r: F.exp(r.x - F.col("most"))).alias("e"))
    exps = exps.withColumn("sum", F.aggregate("e", F.lit(0.0), lambda a, v: a + F.coalesce(v, F.lit(0.0))))
    sums = F.array_sort(F.collect_list(F.struct("tile", "sum")).over(group))
    total = exps.withColumn("t", F.aggregate(sums, F.lit(0.0), lambda a, v: a + v["sum"]))
    return total.select(*names, "tile", "k", F.transform("e", lambda v: ratio(v, F.col("t"))).alias("s"))


def _shares(df: DataFrame, columns: Sequence[str], shift: Column | None) -> DataFrame:
    require_columns(df, columns)
    exps = {c: F.exp(double(c) if shift is None else double(c) - shift) for c in columns}
    return (
        df.withColumns(exps)
        .withColumn("__total", total(columns))
        .withColumns({c: ratio(F.col(f"`{c}`"), F.col("__total")) for c in columns})
    )


def _same(by: Sequence[str], names: Sequence[str]) -> Column:
    """Null-safe equality of group columns, so a NULL group is a group too."""
    pairs = [F.col(f"`{b}`").eqNullSafe(F.col(n)) for b, n in zip(by, names, strict=True)]
    return reduce(lambda a, b: a & b, pairs)
