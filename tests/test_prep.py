import importlib
import math
import sys

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from colfit.functions import transforms
from colfit.operators import (
    get_col_by_index,
    min_max_norm_cols,
    softmax,
    softmax_columns,
    softmax_group_jacobian,
    softmax_jacobian,
    transform_cols,
    z_norm_cols,
)
from colfit.sources import load_csv

NAN, INF = math.nan, math.inf


def approx(values, tol=1e-9):
    return pytest.approx(values, abs=tol, nan_ok=True)


def test_load_csv(spark, tmp_path):
    path = tmp_path / "numbers.csv"
    path.write_text("1\n2\n3\n")
    df = load_csv(spark, str(path))
    assert df.columns == ["1"]
    assert sorted(r[0] for r in df.collect()) == [2, 3]
    typed = load_csv(spark, str(path), schema="`1` double")
    assert sorted(r[0] for r in typed.collect()) == [2.0, 3.0]


def test_load_csv_missing_path(spark, tmp_path):
    with pytest.raises(AnalysisException):
        load_csv(spark, str(tmp_path / "absent.csv"))


def test_load_csv_malformed_line(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a,b\n1,2\nx,3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        load_csv(spark, str(path), schema="a int, b int").collect()


@pytest.mark.parametrize(
    ("function", "inputs", "expected"),
    [
        (lambda c: c * 2, [1, 2, 3], [2, 4, 6]),
        (transforms.identity(), [1, 2, 3], [1, 2, 3]),
        (transforms.power(2), [1, 2, 3], [1, 4, 9]),
        (transforms.power(0.5), [-8, None, 4], [NAN, None, 2]),
        (transforms.log(2), [1, 2, 4], [0, 1, 2]),
        (transforms.log(2), [0, -1, None, NAN, INF], [-INF, NAN, None, NAN, INF]),
        (transforms.log(0.5), [0, 4], [INF, -2]),
    ],
)
def test_transform_cols(column, values, function, inputs, expected):
    result = values(transform_cols(column(inputs), ["x"], function))
    assert [v is None for v in result] == [v is None for v in expected]
    assert [v for v in result if v is not None] == approx([v for v in expected if v is not None])


def test_transform_reads_the_input_once(table, values):
    df = table(a=[1, 2], b=[3, 4])
    twice = transform_cols(df, ["a", "a", "b"], lambda c: c * 2)
    assert values(twice, "a") == [2, 4]
    assert values(twice, "b") == [6, 8]
    added = transform_cols(df, ["a"], lambda c: c * 2, rename=lambda n: f"{n}_twice")
    assert added.columns == ["row_id", "a", "b", "a_twice"]


def test_unknown_column(column):
    for step in (z_norm_cols, min_max_norm_cols):
        with pytest.raises(ValueError, match="not found"):
            step(column([1]), ["absent"])
    with pytest.raises(ValueError, match="not found"):
        transform_cols(column([1]), ["absent"], transforms.identity())


@pytest.mark.parametrize("base", [0, -1, 1, NAN, INF])
def test_log_rejects_base(base):
    with pytest.raises(ValueError, match="base"):
        transforms.log(base)


def test_z_norm(column, values):
    root = math.sqrt(2)
    assert values(z_norm_cols(column([1, 2, 3, 4, 5]), ["x"])) == approx(
        [(x - 3) / root for x in range(1, 6)]
    )


def test_chained(column, values):
    df = (
        column([1, 2, 4])
        .transform(transform_cols, ["x"], transforms.power(2))
        .transform(transform_cols, ["x"], transforms.log(2))
        .transform(transform_cols, ["x"], transforms.identity())
        .transform(z_norm_cols, ["x"])
    )
    assert values(df) == approx([-1.224744871, 0, 1.224744871])


def test_min_max(column, values):
    assert values(min_max_norm_cols(column([1, 2, 3, 4, 5]), ["x"])) == approx(
        [0, 0.25, 0.5, 0.75, 1]
    )
    assert values(min_max_norm_cols(column([1, NAN, 3]), ["x"])) == approx([0, NAN, 1])


def test_integers_are_normalised_as_doubles(spark, values):
    df = spark.createDataFrame([(0, 1), (1, 2), (2, 4)], "row_id bigint, x int")
    assert values(min_max_norm_cols(df, ["x"])) == approx([0, 1 / 3, 1])


@pytest.mark.parametrize("step", [z_norm_cols, min_max_norm_cols])
def test_constant_column_is_nan(column, values, step):
    result = values(step(column([7, 7, None]), ["x"]))
    assert result[:2] == approx([NAN, NAN])
    assert result[2] is None


@pytest.mark.parametrize("step", [z_norm_cols, min_max_norm_cols])
def test_empty_column(column, step):
    with pytest.raises(ValueError, match="no values"):
        step(column([]), ["x"])
    with pytest.raises(ValueError, match="no values"):
        step(column([None]), ["x"])


def test_statistics_take_one_pass(table, values):
    df = table(a=[1, 2, 3], b=[10, 20, 30])
    both = min_max_norm_cols(df, ["a", "b", "a"])
    assert values(both, "a") == values(both, "b") == approx([0, 0.5, 1])


def test_get_col_by_index(table):
    df = table(a=[1], b=[2])
    assert get_col_by_index(df, 2).columns == ["b"]
    for bad in (3, -1):
        with pytest.raises(IndexError):
            get_col_by_index(df, bad)


def test_column_names_with_dots(table):
    df = min_max_norm_cols(table(**{"a.b": [1, 2, 3]}), ["a.b"])
    assert df.columns == ["row_id", "a.b"]
    assert sorted(row["a.b"] for row in df.collect()) == [0, 0.5, 1]


def brute_softmax(rows):
    totals = {}
    for _, g, x in rows:
        totals[g] = totals.get(g, 0.0) + math.exp(x)
    return [math.exp(x) / totals[g] for _, g, x in rows]


@pytest.mark.parametrize("limit", [10_000, 4])
def test_softmax_by_group(spark, values, monkeypatch, limit):
    monkeypatch.setattr(sys.modules["colfit.operators.softmax"], "BROADCAST_GROUPS", limit)
    # One group holds a third of the rows; NULL is a group of its own.
    groups = ["hot"] * 20 + [None] * 4 + [f"g{i % 12}" for i in range(36)]
    rows = [(i, g, (i * 7 % 11) / 5.0) for i, g in enumerate(groups)]
    df = spark.createDataFrame(rows, "row_id bigint, g string, x double")
    result = softmax(df, "x", ["g"])
    assert result.count() == len(rows)
    assert values(result, "activated_values") == approx(brute_softmax(rows))


def test_softmax_whole_column(column, values):
    assert values(softmax(column([1, 2, 3]), "x"), "activated_values") == approx(
        [0.090030573, 0.244728471, 0.665240956]
    )


def test_softmax_within_row(table):
    df = table(a=[1], b=[2], c=[3])
    row = softmax_columns(df, ["a", "b", "c"]).first()
    assert [row.a, row.b, row.c] == approx([0.090030573, 0.244728471, 0.665240956])
    jacobian = softmax_jacobian(df, ["a", "b", "c"]).first()
    assert [jacobian.a, jacobian.b, jacobian.c] == [1, 2, 3]
    assert [jacobian[f"gradients_{i}"] for i in (0, 1, 4, 8)] == approx(
        [0.081925, -0.022033, 0.184836, 0.222695], 1e-6
    )


def test_softmax_sum_is_one(column):
    total = softmax(column([0.5, -1, 3, 2]), "x").agg(F.sum("activated_values")).first()[0]
    assert total == approx(1.0)


def test_group_jacobian(spark):
    rows = [("a", 1, 0.5), ("a", 2, -1.0), ("a", 7, 3.0), (None, 1, 2.0), ("b", 4, 800.0), ("b", 5, 799.0), ("n", 1, None), ("n", 2, 1.0)]
    df = spark.createDataFrame(rows, "g string, k int, x double").repartition(4)
    found = {(r["g"], r["i"], r["j"]): r["value"] for r in softmax_group_jacobian(df, "x", ["g"], "k").collect()}
    assert len(found) == 9 + 1 + 4 + 4
    for group in ("a", None, "b"):
        own = {k: x for g, k, x in rows if g == group}
        total = sum(math.exp(x - max(own.values())) for x in own.values())
        share = {k: math.exp(x - max(own.values())) / total for k, x in own.items()}
        for i in own:
            for j in own:
                expected = share[i] * (1 - share[i]) if i == j else -share[i] * share[j]
                assert found[group, i, j] == pytest.approx(expected, abs=1e-12)
    assert found["n", 1, 2] is None and found["n", 2, 2] == 0.0
    assert softmax_group_jacobian(df.limit(0), "x", ["g"], "k").count() == 0
    clashing = df.selectExpr("g AS k", "k AS s", "x AS rows", "1 AS e")
    assert softmax_group_jacobian(clashing, "rows", ["k"], "s").count() == len(found)
    with pytest.raises(ValueError, match="3 rows"):
        softmax_group_jacobian(df, "x", ["g"], "k", most_rows=2)
    for bad in ([("a", 1, 0.0)], [("a", None, 0.0)]):
        with pytest.raises(ValueError, match="unique"):
            softmax_group_jacobian(df.union(spark.createDataFrame(bad, df.schema)), "x", ["g"], "k")


def test_group_jacobian_of_large_groups(spark, monkeypatch):
    module = importlib.import_module("colfit.operators.softmax")  # the package's attribute is the function
    rows = [("big", i, (i * 37 % 101) / 25) for i in range(2001)] + [(None, 3, 1.0), (None, 4, None), ("few", 1, 2.0)]
    df = spark.createDataFrame(rows, "g string, k int, x double").repartition(3)
    found = softmax_group_jacobian(df, "x", ["g"], "k")
    sums = found.groupBy("g").agg(F.count("*"), F.sum(F.expr("i * 2001L + j")), F.sum("value"), F.sum(F.when(F.expr("i = j"), F.col("value"))))
    own = [math.exp(x - max(r[2] for r in rows if r[0] == "big")) for g, _, x in rows if g == "big"]
    share = [e / sum(own) for e in own]
    of = {g: tuple(more) for g, *more in sums.collect()}
    assert of["big"] == (2001**2, 2001**2 * (2001**2 - 1) // 2, pytest.approx(0.0, abs=1e-9), approx(sum(s * (1 - s) for s in share)))
    assert of["few"] == (1, 2002, 0.0, 0.0) and of[None][:2] == (4, 14 * 2002)
    monkeypatch.setattr(module, "JACOBIAN_TILE_ROWS", 7)
    monkeypatch.setattr(module, "TASK_CELLS", 50)
    small = df.where("k < 40")
    cut = {(r["g"], r["i"], r["j"]): r["value"] for r in softmax_group_jacobian(small, "x", ["g"], "k").collect()}
    monkeypatch.undo()
    whole = {(r["g"], r["i"], r["j"]): r["value"] for r in softmax_group_jacobian(small, "x", ["g"], "k").collect()}
    assert len(whole) == 40**2 + 4 + 1 and cut.keys() == whole.keys()
    assert all(cut[c] == (v if v is None else pytest.approx(v, abs=1e-12)) for c, v in whole.items())
    assert softmax_group_jacobian(small.where("g = 'big'"), "x", [], "k").count() == 40**2
