"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors of cosine c or more lie within squared distance 2 - 2c.  The vectors are
rotated, which keeps distances, and cut into blocks.  If every block's squared distance
were over its proportional share of the budget, the sum would be over the budget; so a
close pair is close in some block.  Each block is range-joined on its own: vectors are
dealt into cells as wide as the range along the block's first axis, meet those of their
own and the next cell, and pairs within the block's budget become candidates.  A
candidate is checked by its cosine in double precision, in the first block that finds
it only, so the union needs no second pass.

Equal vectors of a label are one class from the start.  A cell of more than a bounded
number of rows is cut into tiles whose pairs are units of their own.  A task reports
link counts per vector and a spanning forest, never the pairs themselves.

Results by case: a vector that is null, empty, zero or holds null, NaN or infinity
links with nothing, as does one whose label or id is null; vectors of different lengths
don't link; vectors that share an id share its links; a pair at exactly the cosine links; an
empty table gives no rows; only ``vec_id``, ``label`` and ``embedding`` are read, whatever
other columns are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colfit.llm.common import attach, cut, map_batches
from colfit.llm.components import components, forest

COSINE = 0.93
BLOCKS = 8
SEED = 20
#: Rows of one cell compared as one unit; larger cells are cut into tiles.
TILE_ROWS = 2_000
#: Rounding allowed to squared distances of rotated vectors; candidates are checked exactly.
SLACK = 1e-9


def rotation(dimensions: int) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def rotate(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors, rotated; row by row the same whatever rows stand beside."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.einsum("ij,jk->ik", unit, rotation(vectors.shape[1]))


def _bounds(dimensions: int, blocks: int) -> np.ndarray:
    return np.linspace(0, dimensions, min(blocks, dimensions) + 1).astype(int)


def _classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows with the node of their class, and the classes with their vector.

    A class is a label and a vector; its node is the smallest id of its rows.
    """
    usable = (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
        & F.exists("embedding", lambda x: x != 0)
    )
    label = F.col("label").cast("string")  # led by its length, as it may have commas
    key = F.sha2(F.concat_ws(",", F.char_length(label).cast("string"), label, F.col("embedding").cast("array<string>")), 256)
    rows = vectors.select(
        "vec_id", F.col("label").cast("string").alias("label"), "embedding", F.when(usable, key).alias("class")
    )
    classes = cut(
        rows.where("class IS NOT NULL")
        .groupBy("class")
        .agg(
            F.min("vec_id").alias("node"),
            F.count("*").alias("members"),
            F.first("label").alias("label"),
            F.first("embedding").alias("embedding"),
        )
    )
    return rows.select("vec_id", "class"), classes


PLACE = ["label", "size", "block", "cell"]


def _dealt(classes: DataFrame, cosine: float, blocks: int) -> DataFrame:
    """``label, size, block, cell, own, node, members, embedding``: each class in its own
    cell and, as a guest, in the one before, for each block."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column("embedding")).to_numpy()
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                part = batch.take(pa.array(rows))
                rotated = rotate(_matrix(part.column("embedding")))
                bounds = _bounds(size, blocks)
                for b, reach in enumerate(np.sqrt(_shares(size, cosine, blocks))):
                    cell = np.floor(rotated[:, bounds[b]] / (reach * (1 + 1e-9))).astype(np.int64)
                    for back in (0, 1):
                        yield pa.RecordBatch.from_arrays(
                            [
                                part.column("label"),
                                pa.array(np.full(len(rows), size, np.int32)),
                                pa.array(np.full(len(rows), b, np.int32)),
                                pa.array(cell - back),
                                pa.array(np.full(len(rows), back == 0)),
                                part.column("node"),
                                part.column("members"),
                                part.column("embedding"),
                            ],
                            [*PLACE, "own", "node", "members", "embedding"],
                        )

    rows = classes.select("label", "node", "members", "embedding")
    kinds = dict(rows.dtypes)
    schema = (
        "label string, size int, block int, cell bigint, own boolean, "
        f"node {kinds['node']}, members bigint, embedding {kinds['embedding']}"
    )
    return map_batches(rows, deal, schema)


def _matrix(lists: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return pc.list_flatten(lists).to_numpy().astype(np.float64).reshape(len(lists), -1)


def _shares(size: int, cosine: float, blocks: int) -> np.ndarray:
    """The blocks' parts of the squared distance that the cosine allows."""
    return (2 - 2 * cosine) * np.diff(_bounds(size, blocks)) / size + SLACK


def linked_pairs(
    vectors: np.ndarray, own: np.ndarray, tile: np.ndarray, two_tiles: bool, node: np.ndarray,
    block: int, cosine: float, blocks: int,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of one unit that link and that no earlier block finds, in bounded parts.

    Rows of the cell itself meet each other once, and the guests.  In a unit of two
    tiles only rows of different tiles meet.
    """
    size = vectors.shape[1]
    norms = np.linalg.norm(vectors, axis=1)
    rotated = rotate(vectors)
    bounds, shares = _bounds(size, blocks), _shares(size, cosine, blocks)
    part = rotated[:, bounds[block] : bounds[block + 1]]
    square = (part**2).sum(axis=1)
    homes = np.flatnonzero(own)
    for at in range(0, len(homes), 128):
        h = homes[at : at + 128]
        near = square[h][:, None] + square[None, :] - 2 * part[h] @ part.T <= shares[block] + 1e-10
        i, j = np.nonzero(near)
        a, b = h[i], j
        keep = (~own[b] & (node[a] != node[b])) | (node[a] < node[b])
        if two_tiles:
            keep &= tile[a] != tile[b]
        a, b = a[keep], b[keep]
        for k in range(0, len(a), 100_000):
            x, y = a[k : k + 100_000], b[k : k + 100_000]
            cosines = (vectors[x] * vectors[y]).sum(axis=1) / (norms[x] * norms[y])
            good = cosines >= cosine
            x, y = x[good], y[good]
            # A pair within an earlier block's budget lay in adjacent cells there.
            within = np.add.reduceat((rotated[x] - rotated[y]) ** 2, bounds[:-1], axis=1) <= shares
            first = within[:, block] & ~within[:, :block].any(axis=1)
            yield x[first], y[first]


def links(classes: DataFrame, cosine: float = COSINE, blocks: int = BLOCKS) -> DataFrame:
    """``a, b, count``: edges of a forest with count 0, and where a = b the number of
    rows, of all classes linked to a, that one task found."""
    dealt = _dealt(classes, cosine, blocks)
    large = cut(
        dealt.groupBy(*PLACE)
        .count()
        .where(F.col("count") > TILE_ROWS)
        .select(*PLACE, F.ceil(F.col("count") / TILE_ROWS).cast("int").alias("tiles"))
    )
    tiled = attach(dealt, large, PLACE, "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    # Tile t of a cell meets tile u in the unit of both; alone in its own unit, itself.
    units = tiled.withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    )
    unit = F.concat_ws(":", "size", "block", "cell", F.least("tile", "other"), F.greatest("tile", "other"), "label")
    two = F.col("tile") != F.col("other")
    rows = units.select(unit.alias("unit"), "block", "tile", two.alias("two"), "own", "node", "members", "embedding")

    def report(table: pa.Table) -> pa.RecordBatch:
        vectors = _matrix(table.column("embedding"))
        node, members = table.column("node").to_numpy(), table.column("members").to_numpy()
        own, tile = table.column("own").to_numpy(), table.column("tile").to_numpy()
        block, two_tiles = table.column("block")[0].as_py(), table.column("two")[0].as_py()
        sums = np.zeros(len(node), np.int64)
        edges = [(node[:0], node[:0])]
        for a, b in linked_pairs(vectors, own, tile, two_tiles, node, block, cosine, blocks):
            np.add.at(sums, a, members[b])
            np.add.at(sums, b, members[a])
            if len(a):
                edges.append(forest(node[a], node[b]))
        p, q = (np.concatenate(x) for x in zip(*edges, strict=True))
        if len(edges) > 2:
            p, q = forest(p, q)
        some = np.flatnonzero(sums)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate((p, node[some]))),
                pa.array(np.concatenate((q, node[some]))),
                pa.array(np.concatenate((np.zeros(len(p), np.int64), sums[some]))),
            ],
            ["a", "b", "count"],
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of one unit, which may span batches
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            index = batch.column("unit").dictionary_encode().indices.to_numpy()
            starts = [0, *(np.flatnonzero(index[1:] != index[:-1]) + 1).tolist()]
            for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                unit = batch.column("unit")[start].as_py()
                if held and last != unit:
                    yield report(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(start, end - start))
                last = unit
        if held:
            yield report(pa.Table.from_batches(held))

    partitions = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = rows.repartition(partitions, "unit").sortWithinPartitions("unit")
    kind = dict(classes.dtypes)["node"]
    return map_batches(sorted_rows, compare, f"a {kind}, b {kind}, count bigint")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, blocks: int = BLOCKS) -> DataFrame:
    """Per row: ``vec_id, n_links, component_id, kept``."""
    rows, classes = _classes(vectors)
    found = cut(links(classes, cosine, blocks))
    joined = components(found.where("a != b").select("a", "b"))
    others = found.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("count").alias("others"))
    facts = cut(
        classes.select("class", "node", "members")
        .join(joined, "node", "left")
        .join(others, "node", "left")
        .select(
            "class",
            (F.col("members") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    component = F.coalesce("component_id", "vec_id")
    return attach(rows, facts, ["class"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
