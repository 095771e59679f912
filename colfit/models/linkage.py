"""Hierarchical clustering by single linkage: a minimum spanning tree, then cuts.

Cutting the tree's edges above a height leaves the clusters of single linkage.  Equal points
hang on the one of the least key, which stands for them.  Space is cut into regions by a sample, and a
task cuts its region into tiles of at most ``TILE_ROWS`` points and finds each tile's own tree.
An edge of that is certain if one of the two parts it joins is farther from the tile's walls
than the edge is long; certain edges make the first components.  Then the tree grows in rounds:
every component takes the lightest edge that leaves it, and these edges join components, of which
at most half remain.  The lightest edge inside a tile is one of the tile's own tree, and
bounds the search: a point only asks the tiles whose box is within its component's bound, and not
those that lie in the component as a whole.  A component that fills its tiles is bounded by the
distances of some of its outermost points to those of other tiles.

A round reads all points, in parts of bounded memory, and takes the distances that the bounds
leave.  In few dimensions those are of points near a tile's walls, or between neighbours among
clusters; in many dimensions boxes tell little apart and the work is that of all distances.

Results by case: edges are ordered by distance, then smaller key, then larger, so equal
distances give one tree whatever the partitions; equal points join at height 0, before others so
near that their squared distance is rounded to 0; a null key, or
one that repeats, raises, as do nulls and values that are not finite, or those rows are left
out with ``handle_invalid="skip"``; one point is a cluster of its own; an empty table raises, as
do tiles between which all squared distances overflow.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colfit.functions.numeric import any_null, double
from colfit.operators.connected import connected
from colfit.operators.stats import check_counts, check_invalid, require_columns
from colfit.session import shared_folder, ship_package

#: Points in a tile at most, and in a block of distances to a tile's points.
TILE_ROWS = 2000
BLOCK_ROWS = 256
#: Tiles in a region on average, unless the sample has fewer than ``LEAST_SAMPLED`` points for it.
REGION_TILES = 4
#: Points of a region in the sample, on average and at least, and numbers in the whole sample.
SAMPLED = 200
LEAST_SAMPLED = 50
SAMPLE_NUMBERS = 2_000_000
#: First components up to which their labels are broadcast.
BROADCAST_PARTS = 1_000_000
#: Dimensions along which a tile's outermost points are kept, and pairs of point and tile in a batch.
MARK_DIMENSIONS = 4
BATCH_PAIRS = 32_768

EDGE = "component bigint, square double, a bigint, b bigint, other bigint"
#: What a region's task yields: rows of several kinds.
POINT, TREE, BOX, MARK, MEMBER = range(5)
PIECE = "kind int, tile bigint, part bigint, a bigint, b bigint, other bigint, square double, x array<double>"
ASK = "met bigint, asked boolean, a bigint, x array<double>, component bigint, bound double"


@dataclass(frozen=True)
class Linkage:
    """The tree's edges ``a, b, distance`` between keys, a < b, and the keys in column ``a`` of ``points``."""

    edges: DataFrame
    points: DataFrame

    def cut(self, height: float) -> DataFrame:
        """``key, cluster``: points joined by edges of at most the height; the least key names a cluster."""
        return self._clusters(self.edges.where(F.col("distance") <= F.lit(float(height))))

    def cut_into(self, clusters: int) -> DataFrame:
        """The same for a number of clusters, by leaving out the heaviest edges, of equal ones the last."""
        if clusters < 1:
            raise ValueError("need at least one cluster")
        heavy = self.edges.orderBy(F.desc("distance"), F.desc("a"), F.desc("b")).limit(clusters - 1)
        return self._clusters(self.edges.join(F.broadcast(heavy.select("a", "b")), ["a", "b"], "left_anti"))

    def _clusters(self, edges: DataFrame) -> DataFrame:
        found = connected(edges.select("a", "b")).withColumnRenamed("node", "key")
        named = self.points.withColumnRenamed("a", "key").join(found, "key", "left")
        return named.select("key", F.coalesce("component", "key").alias("cluster"))


def fit_single_linkage(df: DataFrame, features: Sequence[str], key: str, *, handle_invalid: str = "error") -> Linkage:
    """The minimum spanning tree of Euclidean distances; ``key`` is a unique whole number."""
    check_invalid(handle_invalid)
    require_columns(df, [*features, key])
    if not features:
        raise ValueError("need at least one feature")
    spark = df.sparkSession
    shared_folder(spark)
    x = F.array(*[double(f) for f in features])
    invalid = any_null(features) | F.exists(x, lambda v: F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    rows = df.select(F.col(f"`{key}`").cast("bigint").alias("a"), x.alias("x"), invalid.alias("invalid"))
    if handle_invalid == "skip":
        rows = rows.where(~F.col("invalid") & F.col("a").isNotNull())
    rows = rows.checkpoint()
    n, bad, keys, known = rows.agg(F.count("*"), F.count_if("invalid"), F.count_distinct("a"), F.count("a")).first()
    check_counts(n, bad)
    if known < n or keys < n:
        raise ValueError(f"key {key!r} must be there and unique")
    first = rows.groupBy("x").agg(F.min("a").alias("first")).checkpoint()
    equal = rows.join(first, "x").where("a != first").select(F.col("first").alias("a"), F.col("a").alias("b"), F.lit(0.0).alias("distance"))
    distinct = first.select(F.col("first").alias("a"), "x")
    pieces = _pieces(distinct, first.count(), len(features)).checkpoint()
    tree = pieces.where(F.col("kind") == TREE)
    edges = [equal, _edges(tree.where("part = other"))]
    loose = tree.where("part != other").select("part", F.col("other").alias("to"), "a", "b", "square").checkpoint()
    labels = pieces.where(F.col("kind") == MEMBER).select("part", F.col("part").alias("component")).checkpoint()
    parts = left = labels.count()
    while left > 1:
        chosen = _lightest(pieces, loose, labels, len(features), parts <= BROADCAST_PARTS).checkpoint()
        edges.append(_edges(chosen).distinct())
        joined = connected(chosen.select(F.col("component").alias("a"), F.col("other").alias("b")))
        joined = joined.withColumnRenamed("component", "root").withColumnRenamed("node", "component")
        labels = labels.join(joined, "component", "left").select("part", F.coalesce("root", "component").alias("component")).checkpoint()
        before, left = left, labels.select("component").distinct().count()
        if left == before:
            raise ValueError("squared distances between points overflow")
    tree = edges[0]
    for more in edges[1:]:
        tree = tree.union(more)
    return Linkage(tree.checkpoint(), rows.select("a"))


def _edges(found: DataFrame) -> DataFrame:
    return found.select("a", "b", F.sqrt("square").alias("distance"))


def _pieces(points: DataFrame, n: int, width: int) -> DataFrame:
    """Tiles of the points: the points, trees, boxes, outermost points and first components of each."""
    ship_package(points.sparkSession)
    regions = -(-n // (REGION_TILES * TILE_ROWS))
    sample = np.zeros((0, width))
    if regions > 1:
        rows = max(1, min(SAMPLED * regions, SAMPLE_NUMBERS // width))
        some = points.where(F.pmod(F.xxhash64("a"), F.lit(-(-n // rows))) == 0)
        sample = _matrix(some.select("x").toArrow().column("x"), width)
        regions = max(1, min(regions, len(sample) // LEAST_SAMPLED))
    space, most = _Space(sample, -(-len(sample) // regions)), TILE_ROWS

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            region = pa.array(space.regions_of(_matrix(batch.column("x"), width)))
            yield pa.RecordBatch.from_arrays([region, batch.column("a"), batch.column("x")], ["region", "a", "x"])

    def run(table: pa.Table) -> pa.Table:
        region = table.column("region")[0].as_py()
        return _pieces_of_region(table, region, space.low[region], space.high[region], most)

    dealt = points.select("a", "x").mapInArrow(deal, "region bigint, a bigint, x array<double>")
    return dealt.groupBy("region").applyInArrow(run, PIECE)


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Points by rows of a column of arrays."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _arrays(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def _halves(x: np.ndarray) -> tuple[int, np.ndarray, int] | None:
    """The widest dimension, the points' order along it and the place nearest the middle where it changes."""
    if len(x) < 2:
        return None
    widest = int((x.max(axis=0) / 2 - x.min(axis=0) / 2).argmax())
    order = np.argsort(x[:, widest], kind="stable")
    steps = np.flatnonzero(np.diff(x[order, widest]) > 0) + 1
    return (widest, order, int(steps[np.abs(2 * steps - len(x)).argmin()])) if len(steps) else None


class _Space:
    """Regions with at most so many points of a sample each, and their walls."""

    def __init__(self, sample: np.ndarray, most: int):
        self.nodes: list[list] = []
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        wall = np.full(sample.shape[1], np.inf)
        self.top = self._grown(sample, max(1, most), -wall, wall)
        self.nodes = self.nodes or [[0, 0.0, -1, -1]]
        self.dimension, self.value, self.left, self.right = (np.array(c) for c in zip(*self.nodes, strict=True))

    def _grown(self, x: np.ndarray, most: int, low: np.ndarray, high: np.ndarray) -> int:
        """The number of a new node, or of a new region, negative and less one."""
        half = _halves(x) if len(x) > most else None
        if half is None:
            self.low.append(low)
            self.high.append(high)
            return -len(self.low)
        d, order, at = half
        before, after = x[order[at - 1], d], x[order[at], d]
        between = before / 2 + after / 2
        value = between if before < between < after else after
        node = len(self.nodes)
        self.nodes.append([d, value, 0, 0])
        to, start = high.copy(), low.copy()
        to[d] = start[d] = value
        self.nodes[node][2] = self._grown(x[order[:at]], most, low, to)
        self.nodes[node][3] = self._grown(x[order[at:]], most, start, high)
        return node

    def regions_of(self, x: np.ndarray) -> np.ndarray:
        place = np.full(len(x), self.top, np.int64)
        while len(inner := np.flatnonzero(place >= 0)):
            at = place[inner]
            place[inner] = np.where(x[inner, self.dimension[at]] < self.value[at], self.left[at], self.right[at])
        return -place - 1


def _pieces_of_region(table: pa.Table, region: int, low: np.ndarray, high: np.ndarray, most: int) -> pa.Table:
    """Its points cut into tiles of at most so many, every cut where a coordinate changes nearest the middle."""
    key, x = table.column("a").to_numpy(), _matrix(table.column("x"), len(low))
    order = np.argsort(key)
    key, x = key[order], x[order]
    found: list[pa.RecordBatch] = []
    todo, tiles = [(np.arange(len(key)), low, high)], 0
    while todo:
        rows, low, high = todo.pop()
        half = _halves(x[rows]) if len(rows) > most else None
        if half is None:
            rows = np.sort(rows)
            found += _pieces_of_tile((region << 24) + tiles, key[rows], x[rows], low, high)
            tiles += 1
            continue
        d, order, at = half
        to, start = high.copy(), low.copy()
        to[d], start[d] = x[rows[order[at]], d], x[rows[order[at - 1]], d]
        todo += [(rows[order[:at]], low, to), (rows[order[at:]], start, high)]
    return pa.Table.from_batches(found)


def _pieces_of_tile(tile: int, key: np.ndarray, x: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[pa.RecordBatch]:
    """Points come in the order of keys; all points elsewhere are at a wall or beyond it."""
    a, b, square = _tree(x.T)
    to_wall = np.minimum((x - low).min(axis=1), (high - x).min(axis=1)) ** 2
    part = key[_parts(a, b, square, to_wall)]
    wide = np.argsort(x.min(axis=0) / 2 - x.max(axis=0) / 2, kind="stable")[:MARK_DIMENSIONS]
    marks = np.unique(np.concatenate((x[:, wide].argmin(axis=0), x[:, wide].argmax(axis=0))))
    box = np.concatenate((x.min(axis=0), x.max(axis=0)))[None]
    of = np.unique(part)
    return [
        _piece(POINT, tile, len(key), part=part, a=key, x=x),
        _piece(TREE, tile, len(a), part=part[a], a=key[a], b=key[b], other=part[b], square=square),
        _piece(BOX, tile, 1, x=box),
        _piece(MARK, tile, len(marks), part=part[marks], a=key[marks], x=x[marks]),
        _piece(MEMBER, tile, len(of), part=of),
    ]


def _piece(kind: int, tile: int, rows: int, x: np.ndarray | None = None, **columns: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(np.full(rows, kind, np.int32)), pa.array(np.full(rows, tile, np.int64))]
    for name in ("part", "a", "b", "other", "square"):
        empty = pa.nulls(rows, pa.float64() if name == "square" else pa.int64())
        arrays.append(pa.array(columns[name]) if name in columns else empty)
    arrays.append(pa.nulls(rows, pa.list_(pa.float64())) if x is None else _arrays(x).cast(pa.list_(pa.float64())))
    return pa.RecordBatch.from_arrays(arrays, ["kind", "tile", "part", "a", "b", "other", "square", "x"])


def _tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tree of columns of coordinates, grown from the first: places a < b and the squared distance."""
    n = x.shape[1]
    x, place = x.copy(), np.arange(n)
    best, to = np.full(n, np.inf), np.zeros(n, np.int64)
    ends, squares = np.zeros((max(0, n - 1), 2), np.int64), np.zeros(max(0, n - 1))
    at = 0
    for left in range(n - 1, 0, -1):
        new, here = int(place[at]), x[:, at].copy()
        for column in (place, best, to):
            column[at] = column[left]
        x[:, at] = x[:, left]
        square = np.zeros(left)
        for d, value in enumerate(here):
            square += (x[d, :left] - value) ** 2
        least, known = best[:left], to[:left]
        closer = (square < least) | ((square == least) & (new < known))
        least[closer] = square[closer]
        known[closer] = new
        at = int(least.argmin())
        if len(ties := np.flatnonzero(least == least[at])) > 1:
            p, q = place[ties], known[ties]
            at = int(ties[np.lexsort((np.maximum(p, q), np.minimum(p, q)))[0]])
        ends[left - 1], squares[left - 1] = (place[at], to[at]), best[at]
    return ends.min(axis=1, initial=n), ends.max(axis=1, initial=-1), squares


def _parts(a: np.ndarray, b: np.ndarray, square: np.ndarray, to_wall: np.ndarray) -> np.ndarray:
    """Of each point the first it is joined to by certain edges of the tile's tree.

    By weight every edge joins two sets of points of which it is the lightest that leaves
    them inside the tile; those outside are no lighter than a set's distance to the walls.
    """
    joined, certain, room = list(range(len(to_wall))), list(range(len(to_wall))), to_wall.tolist()

    def top(sets: list[int], at: int) -> int:
        while sets[at] != at:
            sets[at] = at = sets[sets[at]]
        return at

    for e in np.lexsort((b, a, square)).tolist():
        p, q, weight = int(a[e]), int(b[e]), float(square[e])
        first, second = top(joined, p), top(joined, q)
        if weight < room[first] or weight < room[second]:
            low, high = sorted((top(certain, p), top(certain, q)))
            certain[high] = low
        joined[second] = first
        room[first] = min(room[first], room[second])
    return np.array([top(certain, i) for i in range(len(certain))], np.int64)


def _lightest(pieces: DataFrame, loose: DataFrame, labels: DataFrame, width: int, few: bool) -> DataFrame:
    """``component, square, a, b, other``: of each component the first edge that leaves it; ``few`` labels are broadcast."""
    others = labels.select(F.col("part").alias("to"), F.col("component").alias("other"))
    ends = loose.join(labels, "part").join(others, "to").where("component != other").select("component", "square", "a", "b", "other")
    back = ends.select(F.col("other").alias("component"), "square", "a", "b", F.col("component").alias("other"))
    inside = _first_of(ends.union(back)).checkpoint()

    bounds = labels.join(inside.select("component", F.col("square").alias("bound")), "component", "left")
    members = pieces.where(F.col("kind") == MEMBER).select("tile", "part").join(bounds, "part")
    of_tile = members.groupBy("tile").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.max("bound").alias("bound"))
    boxes = pieces.where(F.col("kind") == BOX).select("tile", "x").join(of_tile, "tile").toArrow()
    tile, least, most = (boxes.column(c).to_numpy() for c in ("tile", "least", "most"))
    box, whole = _matrix(boxes.column("x"), 2 * width), least == most
    low, high = box[:, :width], box[:, width:]
    bare = np.unique(least[boxes.column("bound").is_null().to_numpy()])
    if len(bare):
        marks = pieces.where(F.col("kind") == MARK).select("part", "x").join(labels, "part").toArrow()
        found = _bounds_of(bare, marks.column("component").to_numpy(), _matrix(marks.column("x"), width))
        known = pa.table({"component": bare, "found": found})
        bounds = bounds.join(pieces.sparkSession.createDataFrame(known), "component", "left")
        bounds = bounds.select("part", "component", F.coalesce("bound", "found").alias("bound"))

    rows, pairs = BLOCK_ROWS, BATCH_PAIRS

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _asked(batch, tile, low, high, least, whole, pairs)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _answers(batches, width, rows)

    points = pieces.where(F.col("kind") == POINT).select("tile", "part", "a", "x")
    bounds = bounds.select("part", "component", "bound")
    bounded = points.join(F.broadcast(bounds) if few else bounds, "part")
    asked = bounded.select("tile", "a", "x", "component", "bound").mapInArrow(ask, ASK)
    between = asked.repartition("met").sortWithinPartitions("met", "asked", "a").mapInArrow(search, EDGE)
    return _first_of(inside.union(between))


def _first_of(edges: DataFrame) -> DataFrame:
    first = F.min(F.struct("square", "a", "b", "other")).alias("first")
    return edges.groupBy("component").agg(first).select("component", "first.*")


def _bounds_of(components: np.ndarray, of: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Of some components the least squared distance of their points to those of others."""
    found = np.full(len(components), np.inf)
    some = np.flatnonzero(np.isin(of, components))
    for at in range(0, len(some), BLOCK_ROWS):
        block = some[at : at + BLOCK_ROWS]
        square = _squares(x[block], x)
        square[of[block][:, None] == of] = np.inf
        np.minimum.at(found, np.searchsorted(components, of[block]), square.min(axis=1))
    return found


def _squares(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    square = np.zeros((len(p), len(q)))
    for d in range(p.shape[1]):
        square += (p[:, d][:, None] - q[:, d]) ** 2
    return square


def _box_squares(low: np.ndarray, high: np.ndarray, to_low: np.ndarray, to_high: np.ndarray) -> np.ndarray:
    """At most the squared distances of points in two rows of boxes, as ``_squares`` rounds them."""
    square = np.zeros((len(low), len(to_low)))
    for d in range(low.shape[1]):
        gap = np.maximum(to_low[:, d] - high[:, d][:, None], low[:, d][:, None] - to_high[:, d])
        square += np.maximum(gap, 0.0) ** 2
    return square


def _asked(
    batch: pa.RecordBatch, tile: np.ndarray, low: np.ndarray, high: np.ndarray, component: np.ndarray, whole: np.ndarray, pairs: int
) -> Iterator[pa.RecordBatch]:
    """The points under their own tile, and once more under each that they ask.

    ``component`` is that of a tile if it has one only, which is when it is ``whole``; about
    ``pairs`` of a point and a tile are looked at together.
    """
    own, a, of, bound = (batch.column(c).to_numpy() for c in ("tile", "a", "component", "bound"))
    x = _matrix(batch.column("x"), low.shape[1])
    yield _ask(own, False, a, x, of, bound)
    order = np.argsort(own, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(own[order])) + 1) if len(order) else ():
        p, c, most = x[rows], of[rows], bound[rows]
        square = _box_squares(p.min(axis=0)[None], p.max(axis=0)[None], low, high)[0]
        near = (square <= most.max()) & (tile != own[rows[0]])
        if (c == c[0]).all():
            near &= ~(whole & (component == c[0]))
        near = np.flatnonzero(near)
        step = max(1, pairs // len(rows))
        for at in range(0, len(near), step):
            met = near[at : at + step]
            reached = _box_squares(p, p, low[met], high[met]) <= most[:, None]
            reached &= ~(whole[met] & (component[met] == c[:, None]))
            i, j = np.nonzero(reached)
            if len(i):
                yield _ask(tile[met[j]], True, a[rows[i]], p[i], c[i], most[i])


def _ask(met: np.ndarray, asked: bool, a: np.ndarray, x: np.ndarray, of: np.ndarray, bound: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(met), pa.array(np.full(len(met), asked)), pa.array(a), _arrays(x), pa.array(of), pa.array(bound)]
    return pa.RecordBatch.from_arrays(arrays, ["met", "asked", "a", "x", "component", "bound"])


def _answers(batches: Iterator[pa.RecordBatch], width: int, block_rows: int) -> Iterator[pa.RecordBatch]:
    """Edges of points that ask a tile; the tile's own points come first, in the order of their keys."""
    tile, held = None, []
    for batch in batches:
        met, asked, a, of, bound = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("met", "asked", "a", "component", "bound"))
        x = _matrix(batch.column("x"), width)
        for rows in np.split(np.arange(len(met)), np.flatnonzero(np.diff(met)) + 1) if len(met) else ():
            if met[rows[0]] != tile:
                tile, held = met[rows[0]], []
            own, ask = rows[~asked[rows]], rows[asked[rows]]
            if len(own):
                held.append((a[own], x[own], of[own]))
            if len(ask):
                held = [tuple(np.concatenate(c) for c in zip(*held, strict=True))]
                yield _edges_between(a[ask], x[ask], of[ask], bound[ask], *held[0], block_rows)


def _edges_between(
    a: np.ndarray, x: np.ndarray, of: np.ndarray, bound: np.ndarray, to_a: np.ndarray, to_x: np.ndarray, to_of: np.ndarray, block_rows: int
) -> pa.RecordBatch:
    """Of each component of some points its first edge to others within its bound; ``to_a`` is in order.

    So the first of equal distances is to the smaller key, and makes the first edge.
    """
    along = np.argsort(x[:, (x.max(axis=0) / 2 - x.min(axis=0) / 2).argmax()], kind="stable")
    a, x, of, bound = a[along], x[along], of[along], bound[along]
    names, component = np.unique(of, return_inverse=True)
    least = np.full(len(names), np.inf)
    best, to = np.full(len(a), np.inf), np.zeros(len(a), np.int64)
    for at in range(0, len(a), block_rows):
        block = slice(at, at + block_rows)
        most = np.minimum(bound[block], least[component[block]])
        p = x[block]
        near = _box_squares(p.min(axis=0)[None], p.max(axis=0)[None], to_x, to_x)[0] <= most.max()
        if (of[block] == of[at]).all():
            near &= to_of != of[at]
        near = np.flatnonzero(near)
        if not len(near):
            continue
        square = _squares(p, to_x[near])
        square[of[block][:, None] == to_of[near]] = np.inf
        nearest = square.argmin(axis=1)
        best[block], to[block] = square[np.arange(len(p)), nearest], near[nearest]
        np.minimum.at(least, component[block], best[block])
    found = np.flatnonzero((best <= bound) & (best < np.inf))
    low, high = np.minimum(a[found], to_a[to[found]]), np.maximum(a[found], to_a[to[found]])
    own, other = of[found], to_of[to[found]]
    order = np.lexsort((high, low, best[found], own))
    first = order[np.flatnonzero(np.append(True, own[order][1:] != own[order][:-1]))] if len(order) else order
    columns = (own[first], best[found][first], low[first], high[first], other[first])
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["component", "square", "a", "b", "other"])
