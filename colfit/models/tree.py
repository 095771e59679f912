"""Decision trees and random forests, grown level by level.

Features are put into bins once, between the least and largest finite value or at given
edges, and kept as bytes.  A level is one pass over the kept rows for all open nodes of
all trees: every task finds its rows' nodes from the splits so far and adds up, by node,
feature and bin, the rows of each class or the rows and labels; Spark adds the tasks' cells
and picks each node's split with windows over at most ``bins`` cells.  The driver holds
splits, not cells.  Nodes are numbered 1 for the root and 2i, 2i + 1 for the children of i;
a row goes right if its value is at least the threshold.

All sums are of whole numbers: a regression label counts as a whole multiple of a
``resolution``.  Splits therefore don't depend on partitions or order.  Of equally good splits
that of the first feature, then of the lowest bin is taken; of equally frequent classes the
least.

A forest's trees see each row as often as a Poisson number drawn from a hash of seed, tree
and key says, and each node the features whose hashes of seed, tree, node and feature are
least; so any run draws the same.

Results by case: nulls in features or label raise, or their rows are left out with
``handle_invalid="skip"``; scoring a null feature gives null; NaN is above every threshold;
a regression label that is not finite raises; a table without rows raises; a constant
feature is never split; rows that repeat a key are drawn together.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colfit.functions.numeric import any_null, double, double_array, ratio
from colfit.functions.uniform import uniform_column, uniform_value
from colfit.operators.stats import check_counts, check_invalid, column_statistics, number_max, number_min, require_columns
from colfit.session import persisted, ship_package

CLASSIFICATION = "classification"
REGRESSION = "regression"

#: Bins are stored in a byte.
MOST_BINS = 256
MOST_CLASSES = 100
MOST_DEPTH = 20
#: Cells a task adds up at once; the open nodes of a level are taken in parts.
CELLS_AT_ONCE = 4_000_000
#: A split must be better than none by this share, which is more than rounding.
LEAST_GAIN = 1e-12
#: Levels of a label on either side of zero, if no resolution is given.
LABEL_LEVELS = 1 << 30
#: Probabilities of a Poisson number of mean one up to each value; larger ones don't occur.
POISSON = tuple(sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)) for k in range(8))


@dataclass(frozen=True)
class Tree:
    """Arrays by node; feature -1 is a leaf, and nodes that don't exist have no rows."""

    feature: tuple[int, ...]
    threshold: tuple[float, ...]
    rows: tuple[int, ...]
    value: tuple[float, ...]

    @property
    def depth(self) -> int:
        return len(self.feature).bit_length() - 2


@dataclass(frozen=True)
class TreeModel:
    """One tree, or several that vote (classes, ties to the least) or are averaged (values)."""

    kind: str
    features: tuple[str, ...]
    label: str
    trees: tuple[Tree, ...]
    classes: tuple[float, ...] = ()

    def _value(self, tree: Tree, values: Column) -> Column:
        """The value of the leaf that an array of features ends in."""
        feature = F.expr(f"array({', '.join(str(f + 1) for f in tree.feature)})")
        threshold, value = double_array(tree.threshold), double_array(tree.value)

        def step(node: Column, _: Column) -> Column:
            asked = F.element_at(feature, node + 1)
            right = F.element_at(values, asked) >= F.element_at(threshold, node + 1)
            return F.when(asked == 0, node).otherwise(node * 2 + right.cast("int"))

        leaf = F.lit(1)
        if tree.depth:
            leaf = F.aggregate(F.sequence(F.lit(1), F.lit(tree.depth)), F.lit(1), step)
        return F.element_at(value, leaf + 1)

    @property
    def prediction(self) -> Column:
        """Null where a feature is null."""
        values = F.array(*[double(f) for f in self.features])
        each = F.array(*[self._value(t, values) for t in self.trees])
        if self.kind == REGRESSION:
            found = F.aggregate(each, F.lit(0.0), lambda a, x: a + x) / len(self.trees)
        elif len(self.trees) == 1:
            found = F.element_at(each, 1)
        else:
            votes = F.transform(
                double_array(self.classes),
                lambda c: F.struct(F.size(F.filter(each, lambda x: x == c)).alias("votes"), (-c).alias("least")),
            )
            found = -F.array_max(votes).getField("least")
        return F.when(~any_null(self.features), found)

    def predict(self, df: DataFrame, column: str = "prediction") -> DataFrame:
        require_columns(df, self.features)
        return df.withColumn(column, self.prediction)

    def accuracy(self, df: DataFrame) -> DataFrame:
        """Share of rows predicted right, or R squared, as column ``accuracy``."""
        require_columns(df, [*self.features, self.label])
        y, p = double(self.label), self.prediction
        if self.kind == CLASSIFICATION:
            return df.agg(F.avg((y == p).cast("double")).alias("accuracy"))
        mean = df.agg(F.avg(y)).first()[0]
        if mean is None:
            return df.agg(F.lit(None).cast("double").alias("accuracy"))
        spread = F.sum((y - F.lit(mean)) * (y - F.lit(mean)))
        share = ratio(F.sum((y - p) * (y - p)), spread)
        return df.agg(F.when(spread == 0, F.lit(1.0)).otherwise(F.lit(1.0) - share).alias("accuracy"))

    def to_df(self, spark: SparkSession) -> DataFrame:
        """All nodes: ``tree, node, feature, threshold, rows, value``; a leaf has neither feature nor threshold."""
        nodes = [
            (t, i, self.features[f] if f >= 0 else None, tree.threshold[i] if f >= 0 else None, tree.rows[i], tree.value[i])
            for t, tree in enumerate(self.trees)
            for i, f in enumerate(tree.feature)
            if i and tree.rows[i]
        ]
        return spark.createDataFrame(nodes, "tree int, node int, feature string, threshold double, rows bigint, value double")


@dataclass
class _Node:
    """A node while its tree grows: what its rows add up to, and its split."""

    stats: tuple[int, ...]
    feature: int = -1
    bin: int = -1


@dataclass(frozen=True)
class _Plan:
    kind: str
    bins: int
    depth: int
    least_rows: int
    classes: tuple[float, ...]
    features: int

    @property
    def width(self) -> int:
        """Numbers added up in a cell."""
        return len(self.classes) if self.kind == CLASSIFICATION else 2

    def rows(self, stats: Sequence[int]) -> int:
        return sum(stats) if self.kind == CLASSIFICATION else stats[0]


def equal_edges(low: float | None, high: float | None, bins: int) -> list[float]:
    """Between ``bins`` equally wide bins; a value belongs to the bin of the last edge not above it."""
    if low is None or high is None:
        return [0.0] * (bins - 1)
    return [low + (high - low) * b / bins for b in range(1, bins)]


def _edges(rows: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    finite = [F.when(F.abs(double(f)) < F.lit(float("inf")), double(f)) for f in features]
    limits = column_statistics(rows, finite, [number_min, number_max])
    return [equal_edges(low, high, bins) for low, high in limits]


def _binned(rows: DataFrame, edges: Sequence[Sequence[float]], label: Column, weights: Sequence[Column]) -> DataFrame:
    """``bins, y, weights`` of rows of features ``f0 ...``: a byte for each feature and for each tree."""
    limits = [np.array(e) for e in edges]
    names = [f"f{i}" for i in range(len(edges))]
    drawn = [f"w{t}" for t in range(len(weights))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed(columns: list[np.ndarray], n: int) -> pa.Array:
            width = len(columns)
            flat = np.column_stack(columns).astype(np.uint8) if width else np.zeros((n, 0), np.uint8)
            offsets = pa.array(np.arange(n + 1, dtype=np.int32) * width)
            return pa.Array.from_buffers(pa.binary(), n, [None, offsets.buffers()[1], pa.py_buffer(flat.tobytes())])

        for batch in batches:
            n = batch.num_rows
            bins = [np.searchsorted(e, batch.column(c).to_numpy(), "right") for c, e in zip(names, limits, strict=True)]
            times = [batch.column(c).to_numpy() for c in drawn]
            yield pa.RecordBatch.from_arrays([packed(bins, n), batch.column("y"), packed(times, n)], ["bins", "y", "weights"])

    ship_package(rows.sparkSession)
    chosen = rows.select(*names, label.alias("y"), *[w.alias(c) for w, c in zip(weights, drawn, strict=True)])
    return chosen.mapInArrow(run, "bins binary, y bigint, weights binary")


def poisson_column(seed: int, tree: int, key: Column) -> Column:
    """How often a tree sees a row."""
    u = uniform_column(0, 1, seed, "row", tree, key)
    steps = F.transform(F.array(u), lambda v: sum((F.when(v >= F.lit(c), 1).otherwise(0) for c in POISSON), F.lit(0)))
    return steps.getItem(0)


def node_features(seed: int, tree: int, node: int, features: int, chosen: int) -> list[int]:
    """The features a node may split by."""
    if chosen >= features:
        return list(range(features))
    order = sorted(range(features), key=lambda f: (uniform_value(0, 1, seed, "feature", tree, node, f), f))
    return sorted(order[:chosen])


def _splits_so_far(trees: Sequence[dict[int, _Node]], level: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each tree: feature and bin by node, for nodes above the level."""
    out = []
    for tree in trees:
        feature, cut = np.full(1 << level, -1, np.int64), np.zeros(1 << level, np.int64)
        for number, node in tree.items():
            if node.feature >= 0 and number < 1 << level:
                feature[number], cut[number] = node.feature, node.bin
        out.append((feature, cut))
    return out


def _cells(rows: DataFrame, plan: _Plan, trees: Sequence[dict[int, _Node]], level: int, open_: Sequence[tuple[int, int, list[int]]]) -> DataFrame:
    """``slot, feature, bin, s0 ...``: sums of the rows of open nodes ``(tree, node, features)``."""
    splits = _splits_so_far(trees, level)
    slots: dict[int, np.ndarray] = {}
    allowed = np.zeros((len(open_), plan.features), bool)
    for slot, (tree, node, features) in enumerate(open_):
        slots.setdefault(tree, np.full(2 << level, -1, np.int64))[node] = slot
        allowed[slot, features] = True
    n_features, n_bins, width, classes = plan.features, plan.bins, plan.width, plan.kind == CLASSIFICATION

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(open_) * n_features * n_bins * width, np.int64)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            bins, weights = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(n, -1) for c in ("bins", "weights")
            )
            y = batch.column("y").to_numpy()
            for tree, slot_of in slots.items():
                feature, cut = splits[tree]
                node = np.ones(n, np.int64)
                for at in range(level):
                    inner = np.flatnonzero(node >> at == 1)  # reached this level
                    asked = feature[node[inner]]
                    inner, asked = inner[asked >= 0], asked[asked >= 0]
                    node[inner] = 2 * node[inner] + (bins[inner, asked] > cut[node[inner]])
                slot = slot_of[node]
                times = weights[:, tree].astype(np.int64) if weights.shape[1] else np.ones(n, np.int64)
                here = np.flatnonzero((slot >= 0) & (times > 0))
                for f in range(n_features):
                    rows_f = here[allowed[slot[here], f]]
                    cell = ((slot[rows_f] * n_features + f) * n_bins + bins[rows_f, f]) * width
                    if classes:
                        np.add.at(sums, cell + y[rows_f], times[rows_f])
                    else:
                        np.add.at(sums, cell, times[rows_f])
                        np.add.at(sums, cell + 1, times[rows_f] * y[rows_f])
        table = sums.reshape(-1, width)
        found = np.flatnonzero(table.any(axis=1))
        for at in range(0, len(found), 100_000):
            cell = found[at : at + 100_000]
            keys = (cell // (n_features * n_bins), cell // n_bins % n_features, cell % n_bins)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(k.astype(np.int32)) for k in keys), *(pa.array(table[cell, s]) for s in range(width))],
                ["slot", "feature", "bin", *(f"s{s}" for s in range(width))],
            )

    stats = [f"s{s}" for s in range(width)]
    found = rows.mapInArrow(run, "slot int, feature int, bin int, " + ", ".join(f"{s} bigint" for s in stats))
    # Sums of very many labels outgrow 64 bits.
    return found.groupBy("slot", "feature", "bin").agg(*[F.sum(F.col(s).cast("decimal(38,0)")).alias(s) for s in stats])


def _best(cells: DataFrame, plan: _Plan) -> DataFrame:
    """``slot, feature, bin, l0 ...``: each node's best split, and what goes left, if any is allowed."""
    stats = range(plan.width)
    whole = Window.partitionBy("slot", "feature")
    so_far = whole.orderBy("bin")  # at most as many cells as bins
    summed = cells.select(
        "slot",
        "feature",
        "bin",
        *[F.sum(f"s{s}").over(so_far).alias(f"l{s}") for s in stats],
        *[F.sum(f"s{s}").over(whole).alias(f"t{s}") for s in stats],
    )
    left = [F.col(f"l{s}").cast("double") for s in stats]
    right = [(F.col(f"t{s}") - F.col(f"l{s}")).cast("double") for s in stats]
    all_ = [F.col(f"t{s}").cast("double") for s in stats]

    def size(of: Sequence[Column]) -> Column:
        return sum(of[1:], of[0]) if plan.kind == CLASSIFICATION else of[0]

    def weight(of: Sequence[Column]) -> Column:
        """Larger for purer rows."""
        squares = [x * x for x in (of if plan.kind == CLASSIFICATION else of[1:])]
        return sum(squares[1:], squares[0]) / size(of)

    enough = (size(left) >= plan.least_rows) & (size(right) >= plan.least_rows)
    scored = summed.where(enough).select("*", (weight(left) + weight(right)).alias("score"), weight(all_).alias("none"))
    better = scored.where(F.col("score") > F.col("none") * (1 + LEAST_GAIN))
    first = F.max_by(
        F.struct("feature", "bin", *[f"l{s}" for s in stats]),
        F.struct("score", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b")),
    )
    return better.groupBy("slot").agg(first.alias("split")).select("slot", "split.*")


def _roots(rows: DataFrame, plan: _Plan, trees: int) -> list[dict[int, _Node]]:
    """Each tree's root, with what its rows add up to in any feature's cells."""
    roots = [{1: _Node((0,) * plan.width)} for _ in range(trees)]
    stats = [f"s{s}" for s in range(plan.width)]
    for part in _parts([(t, 1, [0]) for t in range(trees)], plan):
        cells = _cells(rows, plan, roots, 0, part)
        for row in cells.groupBy("slot").agg(*[F.sum(s).alias(s) for s in stats]).collect():  # a row per tree
            roots[part[row["slot"]][0]][1].stats = tuple(int(row[s]) for s in stats)
    return roots


def _parts(open_: list, plan: _Plan) -> Iterator[list]:
    at_once = max(1, CELLS_AT_ONCE // (plan.features * plan.bins * plan.width))
    for at in range(0, len(open_), at_once):
        yield open_[at : at + at_once]


def _grow(rows: DataFrame, plan: _Plan, n_trees: int, allowed: Callable[[int, int], list[int]]) -> list[dict[int, _Node]]:
    trees = _roots(rows, plan, n_trees)
    for level in range(plan.depth):
        open_ = [
            (t, i, allowed(t, i))
            for t, tree in enumerate(trees)
            for i, node in tree.items()
            if i >> level == 1 and plan.rows(node.stats) >= 2 * plan.least_rows
        ]
        for part in _parts(open_, plan):
            for row in _best(_cells(rows, plan, trees, level, part), plan).collect():  # a row per node
                tree, number, _ = part[row["slot"]]
                node = trees[tree][number]
                left = tuple(int(row[f"l{s}"]) for s in range(plan.width))
                node.feature, node.bin = row["feature"], row["bin"]
                trees[tree][2 * number] = _Node(left)
                trees[tree][2 * number + 1] = _Node(tuple(a - b for a, b in zip(node.stats, left, strict=True)))
    return trees


def _finished(tree: dict[int, _Node], plan: _Plan, edges: Sequence[Sequence[float]], unit: float) -> Tree:
    size = 2 << (max(tree).bit_length() - 1)
    feature, threshold, rows, value = [-1] * size, [0.0] * size, [0] * size, [0.0] * size
    for i, node in tree.items():
        rows[i] = plan.rows(node.stats)
        if plan.kind == CLASSIFICATION:
            value[i] = plan.classes[max(range(plan.width), key=lambda c: (node.stats[c], -c))]
        else:
            value[i] = node.stats[1] / node.stats[0] * unit if node.stats[0] else 0.0
        if node.feature >= 0:
            feature[i], threshold[i] = node.feature, float(edges[node.feature][node.bin])
    return Tree(tuple(feature), tuple(threshold), tuple(rows), tuple(value))


def _fit(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    kind: str,
    depth: int,
    bins: int,
    least_rows: int,
    edges: Sequence[Sequence[float]] | None,
    resolution: float | None,
    handle_invalid: str,
    n_trees: int,
    weight: Callable[[int], Column] | None,
    allowed: Callable[[int, int], list[int]],
    key: str | None,
) -> TreeModel:
    features = tuple(features)
    if kind not in (CLASSIFICATION, REGRESSION):
        raise ValueError(f"kind must be {CLASSIFICATION!r} or {REGRESSION!r}, got {kind!r}")
    if not features:
        raise ValueError("need at least one feature")
    if not 0 <= depth <= MOST_DEPTH or not 2 <= bins <= MOST_BINS or least_rows < 1:
        raise ValueError(f"need a depth of 0 to {MOST_DEPTH}, 2 to {MOST_BINS} bins and at least one row a leaf")
    if edges is not None and (len(edges) != len(features) or any(len(e) >= MOST_BINS or list(e) != sorted(e) for e in edges)):
        raise ValueError(f"need rising edges, fewer than {MOST_BINS}, for every feature")
    check_invalid(handle_invalid)
    require_columns(df, [*features, label, *([key] if key else [])])
    needed = dict.fromkeys([*features, label])
    missing = any_null(list(needed))
    rows = df.where(~missing) if handle_invalid == "skip" else df
    y = double(label)
    finite = F.abs(y) < F.lit(float("inf"))
    n, nulls, infinite, largest = rows.agg(F.count("*"), F.count_if(missing), F.count_if(~finite), F.max(F.abs(y))).first()
    check_counts(n, nulls)
    classes, unit = (), 1.0
    if kind == CLASSIFICATION:
        distinct = rows.select(y.alias("y")).distinct().limit(MOST_CLASSES + 1).collect()
        classes = tuple(sorted(r["y"] for r in distinct))
        if len(classes) > MOST_CLASSES:
            raise ValueError(f"more than {MOST_CLASSES} classes")
    else:
        if infinite:
            raise ValueError("labels must be finite")
        unit = resolution or 2.0 ** (math.ceil(math.log2(largest)) if largest else 0) / LABEL_LEVELS
    if edges is None:
        edges = _edges(rows, features, bins)
    else:
        bins = max(2, max(map(len, edges)) + 1)
    plan = _Plan(kind, bins, depth, least_rows, classes, len(features))
    named = rows.select(
        *[double(f).alias(f"f{i}") for i, f in enumerate(features)], y.alias("y"), *([F.col(f"`{key}`").alias("key")] if key else [])
    )
    y = F.col("y")
    target = F.array_position(double_array(classes), y) - 1 if classes else F.rint(y / F.lit(unit)).cast("bigint")
    weights = [weight(t) for t in range(n_trees)] if weight else []
    with persisted(_binned(named, edges, target, weights)) as kept:
        trees = _grow(kept, plan, n_trees, allowed)
    return TreeModel(kind, features, label, tuple(_finished(t, plan, edges, unit) for t in trees), classes)


def fit_tree(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    kind: str = CLASSIFICATION,
    *,
    depth: int = 5,
    bins: int = 32,
    least_rows: int = 1,
    edges: Sequence[Sequence[float]] | None = None,
    resolution: float | None = None,
    handle_invalid: str = "error",
) -> TreeModel:
    """A tree of at most ``depth`` splits on a path; a leaf has at least ``least_rows`` rows.

    Splits are those of least Gini impurity or squared error.  ``edges`` gives the possible
    thresholds of every feature, else they are equally spaced.
    """
    every = list(range(len(features)))
    return _fit(df, features, label, kind, depth, bins, least_rows, edges, resolution, handle_invalid, 1, None, lambda t, i: every, None)


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    kind: str = CLASSIFICATION,
    *,
    key: str,
    trees: int = 10,
    features_per_node: int | None = None,
    seed: int = 0,
    depth: int = 5,
    bins: int = 32,
    least_rows: int = 1,
    edges: Sequence[Sequence[float]] | None = None,
    resolution: float | None = None,
    handle_invalid: str = "error",
) -> TreeModel:
    """Trees on rows drawn by ``key`` and on some features at each node, a third or the root of them by default."""
    k = len(features)
    if trees < 1:
        raise ValueError("need at least one tree")
    if features_per_node is None:
        features_per_node = max(1, round(math.sqrt(k)) if kind == CLASSIFICATION else k // 3)
    return _fit(
        df,
        features,
        label,
        kind,
        depth,
        bins,
        least_rows,
        edges,
        resolution,
        handle_invalid,
        trees,
        lambda t: poisson_column(seed, t, F.col("key")),
        lambda t, i: node_features(seed, t, i, k, features_per_node),
        key,
    )
