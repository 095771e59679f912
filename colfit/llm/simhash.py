"""Near-duplicate texts by SimHash and anchor-point covering.

A fingerprint of 64 bits is cut into three blocks.  Of two fingerprints that differ in
at most four bits, some block differs in at most one (pigeonhole), so blocks are joined
at distance one.  The anchors of a block are the words of a covering code: the Hamming
code of length 15, of covering radius one, beside the block's remaining bits as they
are.  Every block has one nearest anchor, its home, at distance at most one; a block at
distance one from another therefore has the other's home within distance two.  So each
fingerprint stands once at its home and is replicated to all anchors within two, and
fingerprints are compared per anchor, home against replica, over all 64 bits.

Equal fingerprints are one from the start.  Inside a task the pairs found are reduced
to a spanning forest, so a group of near copies never yields all its pairs.

The work of comparing grows with the square of the distinct fingerprints over the number
of anchors, 2^17 a block.

Results by case: a null or empty text, or one of white space, has fingerprint zero,
which links like any other; a text of any length is taken whole, its shingles' hashes being
counted in parts; rows that repeat an id give one row each; ties cannot arise, as the
smallest id names a group; an empty table gives no rows; only ``doc_id`` and ``text`` are
read, whatever other columns are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colfit.llm.common import attach, cut, map_batches
from colfit.llm.components import components, forest

SHINGLE_WORDS = 4
SEED = 42
MOST_BITS = 4
#: Lowest bit and width of the blocks; five differing bits leave one with at most one.
BLOCKS = ((0, 21), (21, 21), (42, 22))
#: Length of the Hamming code on a block's low bits.
CODE_BITS = 15
#: Rows of one anchor compared as one unit; larger anchors are cut into units of pairs of tiles.
TILE_ROWS = 20_000
#: Places of fingerprints that a task makes or compares on average, of which each
#: fingerprint has about so many.
TASK_ROWS = 400_000
PLACES = 42
#: Pairs of 64-bit words compared at once.
PAIRS_AT_ONCE = 1_000_000


def fingerprint(text: str | None) -> int:
    """SimHash of the whole text."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(lengths[:-1] + 1)))
    if len(words) < SHINGLE_WORDS:
        return _majority(np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64))
    ends = (starts + lengths)[SHINGLE_WORDS - 1 :]
    digest, seed = xxhash.xxh64_intdigest, SEED
    hashes = [digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist(), strict=False)]
    return _majority(np.array(hashes, np.uint64))


def _majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fp``: the fingerprint as a signed 64-bit number."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(values.view(np.int64))], ["doc_id", "fp"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(docs.select("doc_id", "text"), compute, f"doc_id {kind}, fp bigint")


def _syndromes(bits: np.ndarray) -> np.ndarray:
    """Of the Hamming code whose position p, from 1, has the check p."""
    syndrome = np.zeros(len(bits), np.int64)
    for i in range(CODE_BITS):
        syndrome ^= np.where((bits >> i) & 1, i + 1, 0)
    return syndrome


def anchors_within_two(block: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each block value: its number, an anchor within distance two, and if that is home."""
    mask = (1 << CODE_BITS) - 1
    code, rest = block & mask, block & ~mask
    syndrome = _syndromes(code)
    flip = np.where(syndrome > 0, 1 << np.maximum(syndrome - 1, 0), 0)
    nearest = code ^ flip
    number = np.arange(len(block))
    found = [(number, nearest | rest, np.ones(len(block), bool))]
    off = syndrome > 0
    extra = [1 << i for i in range(CODE_BITS, width)]
    # The home's anchor with one other of the remaining bits, or two if the code part fits.
    for i, a in enumerate(extra):
        found.append((number, (nearest | rest) ^ a, None))
        for b in extra[i + 1 :]:
            found.append((number[~off], (nearest | rest)[~off] ^ a ^ b, None))
    # Code words at distance two: flip two positions whose checks sum to the syndrome.
    for i in range(1, CODE_BITS + 1):
        j = syndrome ^ i
        pair = off & (j > i)
        flipped = code[pair] ^ (1 << (i - 1)) ^ (1 << np.maximum(j[pair] - 1, 0))
        found.append((number[pair], flipped | rest[pair], None))
    numbers = np.concatenate([f[0] for f in found])
    anchors = np.concatenate([f[1] for f in found])
    home = np.concatenate([np.zeros(len(f[0]), bool) if f[2] is None else f[2] for f in found])
    return numbers, anchors, home


def _placed(distinct: DataFrame) -> DataFrame:
    """``anchor, home, fp`` of ``distinct(fp)``: each fingerprint at its anchors.

    The anchor carries the block, so only blocks of the same kind meet.
    """

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint64)
            for at in range(0, len(values), 20_000):
                part = values[at : at + 20_000]
                for number, (low, width) in enumerate(BLOCKS):
                    block = ((part >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)
                    index, anchor, home = anchors_within_two(block, width)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(anchor | (number << 32)),
                            pa.array(home),
                            pa.array(part[index].view(np.int64)),
                        ],
                        ["anchor", "home", "fp"],
                    )

    return map_batches(distinct.select("fp"), place, "anchor bigint, home boolean, fp bigint")


def _links(
    unit: np.ndarray, home: np.ndarray, fp: np.ndarray, bits: int
) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs, as a forest, of rows sorted by unit."""
    starts = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
    group = np.repeat(np.arange(len(starts)), np.diff(np.concatenate((starts, [len(unit)]))))
    counts = np.bincount(group)
    homes = np.flatnonzero(home)
    sizes = counts[group[homes]]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    ends = np.cumsum(sizes)
    at = 0
    while at < len(homes):  # as many homes at once as keep the pairs bounded
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + PAIRS_AT_ONCE, "right")))
        of, n = homes[at:to], sizes[at:to]
        left = np.repeat(of, n)
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        right = starts[group[left]] + offset
        x, y = fp[left], fp[right]
        near = (x != y) & (np.bitwise_count(x ^ y) <= bits)
        if near.any():
            found.append(forest(x[near].view(np.int64), y[near].view(np.int64)))
        at = to
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    return forest(a, b) if len(found) > 1 else (a, b)


def links(distinct: DataFrame, bits: int = MOST_BITS) -> DataFrame:
    """``a, b``: a forest of links of ``distinct(fp)``, per unit of comparison.

    ``bits`` may be up to five, for which the blocks leave one with at most one.  An
    anchor with more than ``TILE_ROWS`` rows is cut into k tiles; its homes of tile i
    meet its replicas of tile j in unit (i, j), so every pair still meets.
    """
    tasks = max(distinct.sparkSession.sparkContext.defaultParallelism, -(-distinct.count() * PLACES // TASK_ROWS))
    placed = _placed(distinct.repartition(tasks))  # quicker to make twice than to write
    large = cut(
        placed.groupBy("anchor")
        .count()
        .where(F.col("count") > TILE_ROWS)
        .select("anchor", F.ceil(F.col("count") / TILE_ROWS).cast("int").alias("tiles"))
    )
    tiled = attach(placed, large, ["anchor"], "left").withColumn("tiles", F.coalesce("tiles", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    all_tiles = F.sequence(F.lit(0), F.col("tiles") - 1)
    # Home rows go as homes to (own, j) and, as replicas too, to (i, own).
    as_home = F.when(F.col("home"), F.transform(all_tiles, lambda j: F.struct(own.alias("i"), j.alias("j"), F.lit(True).alias("home"))))
    as_other = F.transform(all_tiles, lambda i: F.struct(i.alias("i"), own.alias("j"), F.lit(False).alias("home")))
    units = tiled.select(
        "anchor",
        "fp",
        F.explode(
            F.when(F.col("tiles") > 1, F.concat(F.coalesce(as_home, F.array().cast("array<struct<i:int,j:int,home:boolean>>")), as_other))
            .otherwise(F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.col("home").alias("home"))))
        ).alias("unit"),
    ).select("anchor", F.col("unit.i").alias("i"), F.col("unit.j").alias("j"), F.col("unit.home").alias("home"), "fp")
    hashed = units.select(F.xxhash64("anchor", "i", "j").alias("unit"), "home", "fp")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(parts):
            unit, home, fp = (np.concatenate(x) for x in zip(*parts, strict=True))
            a, b = _links(unit, home, fp, bits)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        held: list[tuple] = []  # rows so far, up to the last whole unit
        rows = 0
        for batch in batches:
            unit = batch.column("unit").to_numpy()
            home = batch.column("home").to_numpy(zero_copy_only=False)
            fp = batch.column("fp").to_numpy().view(np.uint64)
            if not len(unit):
                continue
            ready = rows >= 200_000
            first = np.flatnonzero(unit != unit[0])
            if ready and held:
                to = 0 if held[-1][0][-1] != unit[0] else (first[0] if len(first) else len(unit))
                if to < len(unit):
                    held.append((unit[:to], home[:to], fp[:to]))
                    yield flush(held)
                    held, rows = [], 0
                    unit, home, fp = unit[to:], home[to:], fp[to:]
            held.append((unit, home, fp))
            rows += len(unit)
        if held:
            yield flush(held)

    # A collision of the unit hash only brings more rows together.
    dealt = hashed.repartition(tasks, "unit").sortWithinPartitions("unit")
    return map_batches(dealt, compare, "a bigint, b bigint")


def near_groups(docs: DataFrame) -> DataFrame:
    """Per row: ``doc_id, fp, component_id``, the smallest id reachable by links."""
    rows = cut(fingerprints(docs))
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    joined = cut(components(links(distinct)))
    members = distinct.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("component"), "least"
    )
    named = members.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = cut(members.select("fp", "component").join(named, "component").select("fp", "component_id"))
    return attach(rows, classes, ["fp"]).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, whole, less all but the smallest id of each group of ``near_groups``.

    Rows with a null id are kept; rows that repeat an id are kept or go together.
    """
    grouped = near_groups(docs.where("doc_id IS NOT NULL"))
    gone = cut(grouped.where("doc_id != component_id").select("doc_id").distinct())
    return attach(docs, gone, ["doc_id"], "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
