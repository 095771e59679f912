"""Connected components of a table of edges."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colfit.session import remove_folder, shared_folder

#: Edges up to which components are found on the driver.
FEW_EDGES = 100_000
MOST_ROUNDS = 100


def _labelled(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the edges and the least node that each reaches."""
    nodes, place = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = place[: len(a)], place[len(a) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[left], label[right])
        new = label.copy()
        for side in (left, right):
            np.minimum.at(new, label[side], least)
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def connected(edges: DataFrame) -> DataFrame:
    """``node, component`` of every node of ``edges(a bigint, b bigint)``; the least node names it.

    Few edges are looked at on the driver.  Otherwise each round hooks every component that
    an edge joins to a smaller one onto the least of those, follows the hooks to their
    end, which at least halves the components that are still joined, and keeps one edge for
    each two that are, until the edges are few.  An edge from a node to
    itself only names the node; without edges there are no rows.
    """
    spark = edges.sparkSession
    shared_folder(spark)
    edges = edges.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")).checkpoint()
    if edges.count() <= FEW_EDGES:
        return _on_driver(edges).toDF("node", "component")
    written = _Written(spark)
    labels = edges.select("a").union(edges.select("b")).distinct().toDF("node").withColumn("component", F.col("node"))
    edges = written(_between(edges))
    for _ in range(MOST_ROUNDS):
        left = edges.count()
        if not left:
            return written.last(labels)
        hooks = _on_driver(edges) if left <= FEW_EDGES else _followed(edges.groupBy("a").agg(F.min("b").alias("b")), written)
        hooks = hooks.toDF("component", "to")
        labels = labels.join(hooks, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        if left <= FEW_EDGES:
            return written.last(labels)
        labels = written(labels)
        of_a, of_b = (hooks.toDF(side, f"{side}_to") for side in "ab")
        moved = edges.join(of_a, "a", "left").join(of_b, "b", "left")
        edges = written(_between(moved.select(F.coalesce("a_to", "a").alias("a"), F.coalesce("b_to", "b").alias("b"))))
    raise RuntimeError(f"components not settled after {MOST_ROUNDS} rounds")


def _between(edges: DataFrame) -> DataFrame:
    """The edges once each, from the larger end ``a`` to the smaller ``b``."""
    return edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _on_driver(edges: DataFrame) -> DataFrame:
    """``a, b``: nodes of few edges and the least node that each reaches."""
    found = edges.toArrow()
    nodes, least = _labelled(found.column("a").to_numpy(), found.column("b").to_numpy())
    return edges.sparkSession.createDataFrame(list(zip(nodes.tolist(), least.tolist(), strict=True)), "a bigint, b bigint")


def _followed(hooks: DataFrame, written: _Written) -> DataFrame:
    """``a, b`` with every hook led to its end; hooks lead to smaller numbers."""
    hooks = written(hooks)
    if hooks.count() <= FEW_EDGES:
        return _on_driver(hooks)
    for _ in range(MOST_ROUNDS):
        further = hooks.select(F.col("a").alias("b"), F.col("b").alias("next"))
        moved = written(hooks.join(further, "b", "left").select("a", "b", "next"))
        if moved.where("next IS NOT NULL").isEmpty():
            return hooks
        hooks = moved.select("a", F.coalesce("next", "b").alias("b"))
    raise RuntimeError(f"hooks not followed after {MOST_ROUNDS} rounds")


class _Written:
    """Tables of a loop, written to the shared folder and read back.

    A checkpoint passes on the size that was guessed for it; that of a join is the product of
    its sides', and in a loop soon has more digits than can be multiplied.  A file's is known.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.tables = spark, f"{shared_folder(spark)}/connected-{uuid.uuid4().hex}", 0

    def __call__(self, df: DataFrame, at: str | None = None) -> DataFrame:
        self.tables += 1
        path = at or f"{self.folder}/{self.tables}"
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def last(self, df: DataFrame) -> DataFrame:
        """The table that is returned; all others are deleted."""
        found = self(df, f"{self.folder}-found")
        remove_folder(self.spark, self.folder)
        return found
