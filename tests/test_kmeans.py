import math
import os
import random
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from colfit.models import RANDOM, KMeans, KMeansModel, MaxIter, Tol
from colfit.models import kmeans as module
from colfit.models.kmeans import centroids_from_wide, converged, euclidean_distance

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
ONE = [1, 2, 3, 101, 102, 103]
THREE = [1, 2, 3, 101, 102, 103, 201, 202, 203]


def approx(values, tol=1e-9):
    return pytest.approx(values, abs=tol, nan_ok=True)


def distance(p, q):
    return math.sqrt(sum((a - b) ** 2 for a, b in zip(p, q, strict=True)))


def brute_rounds(points, centroids, rounds):
    for _ in range(rounds):
        members = [[] for _ in centroids]
        for p in points:
            gaps = [distance(p, c) for c in centroids]
            members[gaps.index(min(gaps))].append(p)
        centroids = [
            [sum(x) / len(m) for x in zip(*m, strict=True)] if m else c
            for m, c in zip(members, centroids, strict=True)
        ]
    return centroids


@pytest.fixture
def one(table):
    return table(f=ONE)


@pytest.fixture
def three(table):
    return table(f0=THREE, f1=THREE, f2=THREE)


F3 = ["f0", "f1", "f2"]


@pytest.mark.parametrize("end", [Tol(0.0), MaxIter(100)])
def test_user_centroids(one, three, values, end):
    model = KMeans(2, end, [[1], [101]]).fit(one, ["f"])
    assert values(model.predict(one), "clusters") == [0.0, 0, 0, 1, 1, 1]
    assert model.centroids == ((2.0,), (102.0,))
    start = [[1, 1.1, 1.2], [101, 101.1, 101.2], [201, 201.1, 201.2]]
    model = KMeans(3, end, start).fit(three, F3)
    assert values(model.predict(three), "clusters") == [0.0] * 3 + [1.0] * 3 + [2.0] * 3


@pytest.mark.parametrize("end", [Tol(0.0), MaxIter(100)])
def test_equidistant(one, three, values, end):
    kmeans = KMeans(2, end)
    assert kmeans.initial(one, ["f"]).centroids == ((1.0,), (52.0,))
    model = kmeans.fit(one, ["f"])
    assert model.centroids == ((2.0,), (102.0,))
    assert model.compactness(one).first()[0] == approx(4.0)
    model = KMeans(3, end).fit(three, F3)
    assert model.centroids == ((2.0,) * 3, (102.0,) * 3, (202.0,) * 3)
    assert model.compactness(three).first()[0] == approx(18.0)
    assert values(model.assign(three), "cluster") == [0] * 3 + [1] * 3 + [2] * 3


def test_random_init_is_seeded_and_in_range(table):
    df = table(a=[0, 10, 5], b=[100, 200, 150])
    first = KMeans(5, MaxIter(1), RANDOM, 3).initial(df, ["a", "b"])
    assert first == KMeans(5, MaxIter(1), RANDOM, 3).initial(df.repartition(3), ["a", "b"])
    assert first != KMeans(5, MaxIter(1), RANDOM, 4).initial(df, ["a", "b"])
    assert all(0 <= a <= 10 and 100 <= b <= 200 for a, b in first.centroids)


def test_random_init_inertia_never_rises(table):
    rng = random.Random(5)
    df = table(a=[rng.random() for _ in range(60)], b=[rng.random() for _ in range(60)])
    model = KMeans(4, MaxIter(0), RANDOM, 1).fit(df, ["a", "b"])
    spread = [model.compactness(df).first()[0]]
    for _ in range(5):
        model = model.update(df)
        spread.append(model.compactness(df).first()[0])
    assert all(b <= a + 1e-12 for a, b in zip(spread, spread[1:], strict=False))


@pytest.mark.parametrize("limit", [512, 3])
def test_rounds_equal_brute_force(table, monkeypatch, limit):
    """Expression and batch forms."""
    monkeypatch.setattr(module, "MAX_EXPRESSION_COORDINATES", limit)
    rng = random.Random(9)
    # A third of the rows fall in one place.
    cols = [[0.5] * 20 + [rng.random() * 3 for _ in range(40)] for _ in range(3)]
    df = table(f0=cols[0], f1=cols[1], f2=cols[2])
    start = [[0, 0, 0], [1, 2, 1], [3, 3, 3], [50, 50, 50]]
    model = KMeans(4, MaxIter(3), start).fit(df, F3)
    expected = brute_rounds(list(zip(*cols, strict=True)), start, 3)
    for got, want in zip(model.centroids, expected, strict=True):
        assert list(got) == approx(want)
    total = sum(
        min(distance(p, c) for c in expected) ** 2 for p in zip(*cols, strict=True)
    )
    assert model.compactness(df).first()[0] == approx(total)


@pytest.mark.parametrize("limit", [512, 1])
def test_ties_nan_and_null(column, values, monkeypatch, limit):
    monkeypatch.setattr(module, "MAX_EXPRESSION_COORDINATES", limit)
    model = KMeansModel(("x",), ((0.0,), (2.0,), (2.0,)))
    df = column([1, 2, math.nan, math.inf, None, -5])
    assert values(model.predict(df), "clusters") == [0, 1, 0, 0, None, 0]


def test_empty_cluster_keeps_its_centroid(one):
    for end in (MaxIter(5), Tol(0.0)):
        model = KMeans(3, end, [[1], [101], [10_000]]).fit(one, ["f"])
        assert model.centroids == ((2.0,), (102.0,), (10_000.0,))


def test_tolerance_stops_on_coordinates(one):
    # The first round moves the second centroid by 50, the first by 1.
    model = KMeans(2, Tol(60.0)).fit(one, ["f"])
    assert model == KMeans(2, MaxIter(1)).fit(one, ["f"])
    assert converged(((0.0, 0.0),), ((1.0, 1.0),), 1.0)
    assert not converged(((0.0, 0.0),), ((0.0, 1.1),), 1.0)


def test_tolerance_cap_raises(one):
    with pytest.raises(RuntimeError, match="after 1 rounds"):
        KMeans(2, Tol(0.0, max_rounds=1)).fit(one, ["f"])
    with pytest.raises(ValueError, match="tolerance"):
        KMeans(2, Tol(-1.0)).fit(one, ["f"])


def test_no_rounds_and_unfitted(one, values):
    assert KMeans(2, MaxIter(0)).fit(one, ["f"]).centroids == ((1.0,), (52.0,))
    assert values(KMeans(2, MaxIter(9)).predict(one, ["f"]), "clusters") == [0, 0, 0, 1, 1, 1]


def test_bad_inputs(one, column, table):
    with pytest.raises(ValueError, match="centroids given"):
        KMeans(3, MaxIter(1), [[1], [2]]).fit(one, ["f"])
    with pytest.raises(ValueError, match="coordinate"):
        KMeans(1, MaxIter(1), [[1, 2]]).fit(one, ["f"])
    with pytest.raises(ValueError, match="nulls"):
        KMeans(1, MaxIter(1)).fit(column([1, None]), ["x"])
    with pytest.raises(ValueError, match="no rows"):
        KMeans(1, MaxIter(1)).fit(column([]), ["x"])
    with pytest.raises(ValueError, match="not found"):
        KMeans(1, MaxIter(1)).fit(one, ["absent"])
    with pytest.raises(ValueError, match="init"):
        KMeans(1, MaxIter(1), "other").fit(one, ["f"])
    with pytest.raises(ValueError, match="n_clusters"):
        KMeans(0, MaxIter(1)).fit(one, ["f"])
    skipped = KMeans(1, MaxIter(1)).fit(column([1, None, 3]), ["x"], handle_invalid="skip")
    assert skipped.centroids == ((2.0,),)


def test_one_row(column):
    model = KMeans(2, MaxIter(3)).fit(column([7]), ["x"])
    assert model.centroids == ((7.0,), (7.0,))


def test_distance_of_arrays(spark):
    df = spark.createDataFrame([([1.0, 2.0], [4.0, 6.0])], "a array<double>, b array<double>")
    assert df.select(euclidean_distance(F.col("a"), F.col("b"))).first()[0] == 5.0


def test_centroid_tables(spark):
    model = KMeansModel(("a", "b"), ((1.0, 2.0), (3.0, 4.0)))
    assert [(r.centroid_id, r.coords) for r in model.to_df(spark).collect()] == [
        (0, [1.0, 2.0]),
        (1, [3.0, 4.0]),
    ]
    wide = model.to_wide(spark)
    assert wide.columns == ["feature", "0", "1"]
    assert centroids_from_wide(wide, ["b", "a"]) == [[2.0, 1.0], [4.0, 3.0]]
    with pytest.raises(ValueError, match="features"):
        centroids_from_wide(wide, ["a", "c"])


def test_partitions_do_not_matter(three):
    one_part = KMeans(3, MaxIter(5)).fit(three.coalesce(1), F3)
    assert one_part == KMeans(3, MaxIter(5)).fit(three.repartition(8), F3)


def test_nothing_stays_cached(one, spark):
    KMeans(2, MaxIter(5)).fit(one, ["f"])
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_compactness_of_an_unfitted_model(three):
    model = KMeans(3, MaxIter(1))
    expected = model.initial(three, F3).compactness(three).first()[0]
    assert model.compactness(three, F3).first()[0] == approx(expected)


def test_many_centroids_in_a_fresh_process(tmp_path):
    """Workers get the package whatever folder and path they start with."""
    code = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
from colfit.models import KMeans, MaxIter
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
df = spark.range(300).selectExpr("cast(id as double) a", "cast(id % 7 as double) b")
model = KMeans(65, MaxIter(1)).fit(df, ["a", "b"])
print("rows", model.predict(df).where("clusters >= 0").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=200)
    assert "rows 300" in done.stdout, done.stderr[-2000:]
