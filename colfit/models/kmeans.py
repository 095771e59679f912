"""K-means clustering.

A round is one aggregate: assign each row to its nearest centroid, average per
cluster.  Averages are combined on the map side, so a cluster of any size is
one row per task; the driver holds the centroids.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colfit.functions.numeric import INF, any_null, double, sql_column, sql_double
from colfit.functions.uniform import uniform_value
from colfit.operators.stats import (
    check_counts,
    check_invalid,
    column_statistics,
    number_max,
    number_min,
    require_columns,
)
from colfit.session import persisted, ship_package

EQUIDISTANT = "equidistant"
RANDOM = "random"
# Beyond this many coordinates, of all centroids, distances are computed on Arrow
# batches instead of as one expression; the results are the same.
MAX_EXPRESSION_COORDINATES = 128

Centroids = tuple[tuple[float, ...], ...]


@dataclass(frozen=True)
class MaxIter:
    """At most ``rounds`` rounds; fewer when no centroid moves."""

    rounds: int


@dataclass(frozen=True)
class Tol:
    """Until no coordinate moves by more than ``tolerance``.

    Raises if the centroids come round to earlier ones, or after ``max_rounds`` if given.
    """

    tolerance: float
    max_rounds: int | None = None


@dataclass(frozen=True)
class KMeansModel:
    features: tuple[str, ...]
    centroids: Centroids

    def nearest(self) -> Column:
        """``struct(distance, cluster)`` of the nearest centroid.

        Ties go to the lowest cluster number; NaN and infinite distances never
        win, so a row with no finite distance is cluster 0.  NULL for rows with
        null features.
        """
        if self._on_batches():
            best = _nearest_on_batches(self.centroids)(*[double(f) for f in self.features])
        else:
            candidates = ", ".join(
                f"named_struct('distance', nanvl({_distance_sql(self.features, c)}, "
                f"{sql_double(INF)}), 'cluster', {i})"
                for i, c in enumerate(self.centroids)
            )
            best = F.expr(f"array_min(array({candidates}))")
        return F.when(~any_null(self.features), best)

    def _on_batches(self) -> bool:
        return len(self.features) * len(self.centroids) > MAX_EXPRESSION_COORDINATES

    def _prepare(self, df: DataFrame) -> None:
        require_columns(df, self.features)
        if self._on_batches():
            ship_package(df.sparkSession)

    def assign(self, df: DataFrame, column: str = "cluster") -> DataFrame:
        """``df`` with the number of the nearest centroid."""
        self._prepare(df)
        return df.withColumn(column, self.nearest()["cluster"])

    def predict(self, df: DataFrame, column: str = "clusters") -> DataFrame:
        """``df`` with the cluster number as a double."""
        self._prepare(df)
        return df.withColumn(column, self.nearest()["cluster"].cast("double"))

    def compactness(self, df: DataFrame) -> DataFrame:
        """Sum of squared distances to the own centroid, as column ``compactness``."""
        self._prepare(df)
        near = df.select(self.nearest()["distance"].alias("d"))
        return near.agg(F.sum(F.col("d") * F.col("d")).alias("compactness"))

    def update(self, df: DataFrame) -> KMeansModel:
        """One round: each centroid becomes the mean of its rows; empty ones stay."""
        self._prepare(df)
        moved = {row["cluster"]: row["coords"] for row in self._cluster_means(df).collect()}
        return KMeansModel(
            self.features,
            tuple(tuple(moved.get(i, c)) for i, c in enumerate(self.centroids)),
        )

    def _cluster_means(self, df: DataFrame) -> DataFrame:
        """``(cluster, coords)``, at most one row per centroid."""
        if self._on_batches():
            return self._cluster_means_on_batches(df)
        names = [f"x{i}" for i in range(len(self.features))]
        rows = df.select(
            self.nearest()["cluster"].alias("cluster"),
            *[double(f).alias(n) for f, n in zip(self.features, names, strict=True)],
        )
        means = rows.groupBy("cluster").agg(*[F.avg(n).alias(n) for n in names])
        return means.select("cluster", F.array(*names).alias("coords"))

    def _cluster_means_on_batches(self, df: DataFrame) -> DataFrame:
        """Sums per cluster within each task, then added up: k rows per task."""
        points = np.array(self.centroids, dtype=float)

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count, total = np.zeros(len(points)), np.zeros_like(points)
            for batch in batches:
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
                _, cluster = _nearest_points(x, points)
                count += np.bincount(cluster, minlength=len(points))
                for i in np.unique(cluster):
                    total[i] += x[cluster == i].sum(axis=0)
            seen = np.flatnonzero(count)
            yield pa.RecordBatch.from_pydict(
                {
                    "cluster": pa.array(seen.astype(np.int32)),
                    "n": pa.array(count[seen]),
                    "total": pa.array(list(total[seen]), pa.list_(pa.float64())),
                }
            )

        rows = df.filter(~any_null(self.features)).select(*[double(f) for f in self.features])
        parts = rows.mapInArrow(sums, "cluster int, n double, total array<double>")
        return (
            parts.select("cluster", "n", F.posexplode("total").alias("pos", "value"))
            .groupBy("cluster", "pos")
            .agg((F.sum("value") / F.sum("n")).alias("mean"))
            .groupBy("cluster")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "mean")))["mean"].alias("coords"))
        )

    def to_df(self, spark: SparkSession) -> DataFrame:
        """Centroids as rows ``(centroid_id, coords)``."""
        return spark.createDataFrame(
            [(i, list(c)) for i, c in enumerate(self.centroids)],
            "centroid_id int, coords array<double>",
        )

    def to_wide(self, spark: SparkSession) -> DataFrame:
        """One column per centroid, named by its number, and one row per feature."""
        names = ", ".join(f"`{i}` double" for i in range(len(self.centroids)))
        rows = [
            (f, *coords)
            for f, *coords in zip(self.features, *self.centroids, strict=True)
        ]
        return spark.createDataFrame(rows, f"feature string, {names}")


@dataclass(frozen=True)
class KMeans:
    """``init`` is EQUIDISTANT, RANDOM (with ``seed``) or a list of centroids."""

    n_clusters: int
    end: MaxIter | Tol
    init: str | Sequence[Sequence[float]] = EQUIDISTANT
    seed: int = 0

    def initial(
        self, df: DataFrame, features: Sequence[str], handle_invalid: str = "error"
    ) -> KMeansModel:
        """The centroids before the first round."""
        rows = _rows(df, features, handle_invalid)
        return self._initial(rows, tuple(features))

    def fit(
        self, df: DataFrame, features: Sequence[str], handle_invalid: str = "error"
    ) -> KMeansModel:
        rows = _rows(df, features, handle_invalid)
        most = self.end.rounds if isinstance(self.end, MaxIter) else self.end.max_rounds
        tolerance = 0.0 if isinstance(self.end, MaxIter) else self.end.tolerance
        if not tolerance >= 0:
            raise ValueError(f"tolerance must be >= 0, got {tolerance}")
        seen: set[Centroids] = set()
        with persisted(rows):
            model = self._initial(rows, tuple(features))
            while most is None or len(seen) < most:
                if model.centroids in seen:
                    raise RuntimeError(f"the centroids repeat and never come within {tolerance}")
                seen.add(model.centroids)
                before, model = model, model.update(rows)
                if converged(before.centroids, model.centroids, tolerance):
                    return model
        if isinstance(self.end, Tol):
            raise RuntimeError(f"not within {tolerance} after {most} rounds")
        return model

    def predict(
        self, df: DataFrame, features: Sequence[str], column: str = "clusters"
    ) -> DataFrame:
        """Assignments of an unfitted model: centroids are initialised from ``df``."""
        return self.initial(df, features).predict(df, column)

    def compactness(self, df: DataFrame, features: Sequence[str]) -> DataFrame:
        """Of an unfitted model: centroids are initialised from ``df``."""
        return self.initial(df, features).compactness(df)

    def _initial(self, rows: DataFrame, features: tuple[str, ...]) -> KMeansModel:
        if self.n_clusters < 1:
            raise ValueError("n_clusters must be at least 1")
        user = None if isinstance(self.init, str) else [list(c) for c in self.init]
        if user is not None:
            if len(user) != self.n_clusters:
                raise ValueError(f"{len(user)} centroids given for {self.n_clusters} clusters")
            if any(len(c) != len(features) for c in user):
                raise ValueError(f"centroids need one coordinate for each of {features}")
        elif self.init not in (EQUIDISTANT, RANDOM):
            raise ValueError(f"unknown init {self.init!r}")
        low, high = _ranges(rows, features)
        if user is not None:
            centroids = user
        elif self.init == EQUIDISTANT:
            centroids = [
                [a + i * ((b - a) / self.n_clusters) for a, b in zip(low, high, strict=True)]
                for i in range(self.n_clusters)
            ]
        else:
            centroids = [
                [
                    uniform_value(a, b, self.seed, i, j)
                    for j, (a, b) in enumerate(zip(low, high, strict=True))
                ]
                for i in range(self.n_clusters)
            ]
        return KMeansModel(features, tuple(tuple(map(float, c)) for c in centroids))


def _distance_sql(features: Sequence[str], point: Sequence[float]) -> str:
    """Euclidean distance of a row to a fixed point."""
    gaps = [
        f"({sql_column(x)} - {sql_double(c)})" for x, c in zip(features, point, strict=True)
    ]
    return f"sqrt({' + '.join(f'{g} * {g}' for g in gaps)})"


def euclidean_distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two ``array<double>`` columns of equal length."""
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, s: acc + s))


def converged(old: Centroids, new: Centroids, tolerance: float) -> bool:
    """True when every coordinate moved by at most ``tolerance``."""
    return not any(
        abs(a - b) > tolerance
        for before, after in zip(old, new, strict=True)
        for a, b in zip(before, after, strict=True)
    )


def centroids_from_wide(df: DataFrame, features: Sequence[str]) -> list[list[float]]:
    """User centroids from a table as ``to_wide`` writes it.

    Rows are matched to features by name; there is one row per feature.
    """
    require_columns(df, ["feature"])
    rows = {row["feature"]: row for row in df.limit(len(features) + 1).collect()}
    if set(rows) != set(features):
        raise ValueError(f"centroid table has features {sorted(rows)}, not {list(features)}")
    return [[float(rows[f][c]) for f in features] for c in df.columns if c != "feature"]


def _rows(df: DataFrame, features: Sequence[str], handle_invalid: str) -> DataFrame:
    check_invalid(handle_invalid)
    require_columns(df, features)
    rows = df.select(*[double(f).alias(f) for f in features])
    return rows.dropna() if handle_invalid == "skip" else rows


def _ranges(rows: DataFrame, features: Sequence[str]) -> tuple[list[float], list[float]]:
    """Per-feature minimum and maximum, NaN left out; raises on nulls and no rows."""
    missing = F.when(any_null(features), F.lit(1.0)).otherwise(F.lit(0.0))
    (_, nulls), *extremes = column_statistics(
        rows, [missing, *[double(f) for f in features]], [number_min, number_max]
    )
    check_counts(nulls is not None, nulls)
    if any(None in pair for pair in extremes):
        raise ValueError("a feature has only NaN values")
    return [low for low, _ in extremes], [high for _, high in extremes]


def _nearest_points(x: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distance and number of the nearest point for each row of ``x``."""
    best = np.full(len(x), np.inf)
    cluster = np.zeros(len(x), dtype=np.int32)
    for i, point in enumerate(points):
        distance = np.sqrt(((x - point) ** 2).sum(axis=1))
        closer = distance < best
        best[closer] = distance[closer]
        cluster[closer] = i
    return best, cluster


def _nearest_on_batches(centroids: Centroids):
    points = np.array(centroids, dtype=float)

    @F.pandas_udf("struct<distance: double, cluster: int>")
    def nearest(*features: pd.Series) -> pd.DataFrame:
        # A null arrives as NaN; the caller turns such rows into NULL.
        distance, cluster = _nearest_points(np.column_stack(features), points)
        return pd.DataFrame({"distance": distance, "cluster": cluster})

    return nearest
