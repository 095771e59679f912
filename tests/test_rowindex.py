import random

import pytest

from colfit.operators import rowindex, select_rows, split, with_row_index


@pytest.fixture
def shuffled(spark):
    """Unique keys in random order over several partitions, values by key rank."""

    def make(n, key=lambda i: i * 3 - 50):
        order = list(range(n))
        random.Random(n).shuffle(order)
        rows = [(key(i), float(i)) for i in order]
        return spark.createDataFrame(rows, "k bigint, rank double").repartition(5)

    return make


def test_row_index_is_the_key_rank(shuffled):
    rows = with_row_index(shuffled(1000), "k").collect()
    assert len(rows) == 1000
    assert all(row["row_index"] == row["rank"] for row in rows)


def test_row_index_on_two_columns(spark):
    rows = [(i // 10, f"{i % 10}", float(i)) for i in range(100)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "a int, b string, rank double")
    assert all(r["row_index"] == r["rank"] for r in with_row_index(df, ["a", "b"]).collect())


def test_row_index_rejects_null_keys(spark):
    df = spark.createDataFrame([(1,), (None,)], "k bigint")
    with pytest.raises(ValueError, match="nulls"):
        with_row_index(df, "k")
    with pytest.raises(ValueError, match="nulls"):
        split(df, 0.5, "k")


@pytest.mark.parametrize(
    ("size", "n", "train"), [(0.8, 5, 4), (0.29, 100, 28), (0.0, 5, 0), (1.0, 5, 5), (2.0, 5, 5)]
)
def test_split_sizes(shuffled, size, n, train):
    first, rest = split(shuffled(n), size, "k")
    assert sorted(r["rank"] for r in first.collect()) == [float(i) for i in range(train)]
    assert sorted(r["rank"] for r in rest.collect()) == [float(i) for i in range(train, n)]


@pytest.mark.parametrize("size", [-0.1, float("nan"), float("inf")])
def test_split_rejects(shuffled, size):
    with pytest.raises(ValueError, match="train_size"):
        split(shuffled(5), size, "k")


@pytest.mark.parametrize("key", [lambda i: i, lambda i: i**3, lambda i: 2**60 + i])
@pytest.mark.parametrize("size", [0.001, 0.5, 0.777, 0.9995])
def test_split_by_narrowing(shuffled, monkeypatch, key, size):
    monkeypatch.setattr(rowindex, "SORT_LIMIT", 20)
    n = 3000
    first, rest = split(shuffled(n, key), size, "k")
    cut = int(n * size)
    assert sorted(r["rank"] for r in first.collect()) == [float(i) for i in range(cut)]
    assert rest.count() == n - cut


def test_split_by_string_key(spark):
    rows = [(f"{i:04d}", float(i)) for i in range(200)]
    random.Random(3).shuffle(rows)
    first, rest = split(spark.createDataFrame(rows, "k string, rank double"), 0.3, ["k"])
    assert sorted(r["rank"] for r in first.collect()) == [float(i) for i in range(60)]
    assert rest.count() == 140


def test_split_by_two_columns(spark):
    rows = [(i // 7, i % 7, float(i)) for i in range(100)]
    random.Random(4).shuffle(rows)
    df = spark.createDataFrame(rows, "a int, b int, rank double")
    first, rest = split(df, 0.5, ["a", "b"])
    assert sorted(r["rank"] for r in first.collect()) == [float(i) for i in range(50)]
    assert sorted(r["rank"] for r in rest.collect()) == [float(i) for i in range(50, 100)]


def test_split_repeated_key_at_cut(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k bigint")
    with pytest.raises(ValueError, match="not unique"):
        split(df, 0.5, "k")


def test_split_of_no_rows(spark):
    first, rest = split(spark.createDataFrame([], "k bigint"), 0.5, "k")
    assert first.count() == rest.count() == 0


def test_split_filter_reaches_the_scan(shuffled, tmp_path, spark):
    path = str(tmp_path / "keys")
    shuffled(100).write.parquet(path)
    first, _ = split(spark.read.parquet(path), 0.5, "k")
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(k), LessThan(k," in plan
    assert "Exchange" not in plan


def test_select_rows(table, values):
    df = table(a=[1, 2, 3, 4, 5], b=[1, 2, 3, 4, 5])
    result = select_rows(df, [4, 0, 2, 2], "row_id")
    assert values(result, "a") == values(result, "b") == [1, 3, 5]
    assert select_rows(df, [], "row_id").count() == 0


@pytest.mark.parametrize("limit", [100_000, 3])
def test_select_rows_many(shuffled, monkeypatch, limit):
    monkeypatch.setattr(rowindex, "BROADCAST_ROWS", limit)
    wanted = [i for i in range(500) if i % 7 == 3]
    rows = select_rows(shuffled(500), wanted, "k").collect()
    assert sorted(r["rank"] for r in rows) == [float(i) for i in wanted]


@pytest.mark.parametrize("key", [lambda i: i, lambda i: i**3, lambda i: 2**60 + i])
def test_select_rows_by_narrowing(shuffled, monkeypatch, key):
    monkeypatch.setattr(rowindex, "SORT_LIMIT", 20)
    wanted = [0, 1, 17, 1500, 1501, 2998, 2999]
    rows = select_rows(shuffled(3000, key), wanted, "k").collect()
    assert sorted(r["rank"] for r in rows) == [float(i) for i in wanted]


def test_select_rows_by_float_key(spark, monkeypatch):
    monkeypatch.setattr(rowindex, "SORT_LIMIT", 20)
    keys = [random.Random(i).uniform(-5, 5) for i in range(800)]
    df = spark.createDataFrame([(k,) for k in keys], "k double").repartition(3)
    rows = select_rows(df, [0, 400, 799], "k").collect()
    assert sorted(r["k"] for r in rows) == [sorted(keys)[i] for i in (0, 400, 799)]


def test_select_rows_by_string_key(spark):
    rows = [(f"{i:03d}", float(i)) for i in range(100)]
    random.Random(8).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, rank double")
    assert sorted(r["rank"] for r in select_rows(df, [3, 99, 3], "k").collect()) == [3.0, 99.0]


@pytest.mark.parametrize("bad", [5, -1])
def test_select_rows_out_of_range(table, bad):
    with pytest.raises(IndexError):
        select_rows(table(a=[1, 2, 3, 4, 5]), [0, bad], "row_id")


def test_order_by_is_required(table):
    with pytest.raises(ValueError, match="order_by"):
        select_rows(table(a=[1]), [0], [])
    with pytest.raises(ValueError, match="not found"):
        split(table(a=[1]), 0.5, "absent")


@pytest.fixture
def twice(spark):
    """Forty rows, each key twice, of three kinds."""
    rows = [(i // 2, f"{i // 2:03d}", i // 2 // 5, float(i)) for i in range(40)]
    return spark.createDataFrame(rows, "k bigint, s string, a int, rank double").repartition(3)


@pytest.mark.parametrize("key", ["k", "s", ["a", "k"]])
@pytest.mark.parametrize("positions", [[5], [0, 8, 21], range(16), range(17)])
def test_repeated_keys_raise_on_every_path(twice, key, positions):
    with pytest.raises(ValueError, match="not unique"):
        select_rows(twice, positions, key).collect()


@pytest.mark.parametrize("key", ["k", "s", ["a", "k"]])
def test_repeated_key_at_the_cut(twice, key):
    with pytest.raises(ValueError, match="not unique"):
        split(twice, 0.525, key)


@pytest.mark.parametrize("key", ["k", "s", ["a", "k"]])
def test_row_index_rejects_repeated_keys(twice, key):
    with pytest.raises(ValueError, match="not unique"):
        with_row_index(twice, key)


@pytest.mark.parametrize("key", ["k", "s", ["a", "s"]])
@pytest.mark.parametrize("positions", [[3], range(3, 23)])
def test_repeats_elsewhere_do_not_matter(spark, key, positions):
    rows = [(min(i, 30), f"{min(i, 30):03d}", min(i, 30) // 7, float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "k bigint, s string, a int, rank double").repartition(3)
    assert sorted(r["rank"] for r in select_rows(df, positions, key).collect()) == [float(i) for i in positions]


@pytest.mark.parametrize("keys", [["s"], ["a", "s"], ["d", "a"]])
def test_narrowing_by_a_sample(spark, monkeypatch, keys):
    monkeypatch.setattr(rowindex, "SORT_LIMIT", 20)
    monkeypatch.setattr(rowindex, "SAMPLE_KEYS", 100)
    order = list(range(4000))
    random.Random(5).shuffle(order)
    rows = [(f"{i:05d}", i // 900 if keys[0] == "a" else i % 13, float(i // 13), float(i)) for i in order]
    df = spark.createDataFrame(rows, "s string, a int, d double, rank double").repartition(4)
    first, rest = split(df, 0.37, keys)
    assert sorted(r["rank"] for r in first.collect()) == [float(i) for i in range(1480)]
    assert rest.count() == 2520
    wanted = [0, 1, 700, 701, 3999]
    assert sorted(r["rank"] for r in select_rows(df, wanted, keys).collect()) == [float(i) for i in wanted]


def test_jobs_do_not_grow_with_positions(shuffled, spark):
    df = shuffled(2000).persist()
    df.count()

    def jobs(positions):
        group = f"positions-{len(positions)}"
        spark.sparkContext.setJobGroup(group, "")
        select_rows(df, positions, "k")
        spark.sparkContext.setJobGroup("", "")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs([7]) == jobs(list(range(0, 1600, 100)))
    df.unpersist()
