"""Connected components of a large, possibly skewed, edge list."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colfit.llm.common import attach, cut, map_batches

#: Edges that one task reduces to a forest before the rounds.
FOREST_EDGES = 1_000_000

#: Rounds after which the method is taken to have failed; it needs about log of the path length.
MOST_ROUNDS = 100


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the same values as the pairs do, at most one per value."""
    values, index = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = index[: len(a)], index[len(a) :]
    label = np.arange(len(values))
    while True:
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        np.minimum.at(new, label, new)  # roots follow their members
        new = new[new]
        if (new == label).all():
            break
        label = new
    apart = label != np.arange(len(values))
    return values[apart], values[label[apart]]


def _contracted(edges: DataFrame) -> DataFrame:
    """The edges ``a, b`` of integers, each task's part of them reduced to a forest.

    A dense group, whose edges may be many times its nodes, enters the rounds as a few
    trees.  Nothing is shuffled and a task holds a bounded number of edges.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> pa.RecordBatch:
            a, b = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(x) for x in forest(a, b)], ["a", "b"])

        for batch in batches:
            held.append(tuple(batch.column(c).to_numpy().astype(np.int64) for c in ("a", "b")))
            n += batch.num_rows
            if n >= FOREST_EDGES:
                yield flush()
                n = 0
        if held:
            yield flush()

    parts = max(1, -(-edges.count() // FOREST_EDGES))
    return map_batches(edges.coalesce(parts), run, "a bigint, b bigint")


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step of the alternating star method on ``edges(a, b)``, a > b.

    Large: every node hands its larger neighbours to its smallest neighbour or
    itself.  Small: it hands its smaller neighbours and itself to the smallest.
    The smallest is a partial aggregate, and the join that follows can be split,
    so a node with very many neighbours doesn't fill a task.
    """
    both = edges.union(edges.select("b", "a")) if large else edges
    both = both.toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    least = cut(least)
    joined = attach(both, least, ["u"])
    if large:
        linked = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        linked = joined.where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return linked.where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)``; the smallest node names it."""
    high, low = F.greatest("a", "b"), F.least("a", "b")
    current = cut(edges.select(high.alias("a"), low.alias("b")).where("a != b").distinct())
    if dict(current.dtypes)["a"] in ("bigint", "int", "smallint", "tinyint"):
        kind = dict(current.dtypes)["a"]
        current = cut(_contracted(current).select(F.col("a").cast(kind).alias("a"), F.col("b").cast(kind).alias("b")))
    before = None
    for _ in range(MOST_ROUNDS):
        current = cut(_stars(_stars(current, True), False))
        mark = current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                current.select("b", "b").distinct()
            )
        before = mark
    raise RuntimeError(f"components not settled after {MOST_ROUNDS} rounds")
