"""Shards of near equal bytes by Karmarkar-Karp differencing.

Equal texts are one indivisible group.  A partial partition is a row of as many bins as
there are shards; differencing takes the two partial partitions of the largest spread and
adds them in opposite order, largest bin to smallest, until one is left.

One task cannot hold all groups, so rounds reduce them first.  In a round the light
groups are dealt by hash into blocks of a few thousand, each block is differenced into
bins, and the bins go on as groups of their own, called grains.  Blocks hold half the
groups, a quarter and so on down to single ones, so grains come in all sizes and the
last differencing can fill up around heavy groups, which go on whole.  Rounds repeat
until one bounded differencing is left.

Results by case: a null text weighs as empty and goes with the empty texts; a text of any
length is one weight; of equal weights the group that was numbered first is taken first, and
groups are numbered by their digests; rows that repeat an id are rows of their own; an empty
table gives no rows; only ``doc_id`` and ``text`` are read, whatever other columns are called.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colfit.llm.common import attach, cut, number_within
from colfit.session import ship_package

SHARDS = 24
ROW_BYTES = 8
#: Groups in a block of a round.
BLOCK_ROWS = 4_096
#: Groups, besides heavy ones, that the last differencing takes.
LAST_ROWS = 16_384
#: A group is heavy above this part of a shard; there are at most SHARDS times as many.
HEAVY_PART = 64


def differencing(weights: list[int], ways: int) -> np.ndarray:
    """The bin, from 0 to ways - 1, of each weight."""
    n = len(weights)
    if n == 0:
        return np.empty(0, np.int64)
    sums: dict[int, np.ndarray] = {}
    for i, w in enumerate(weights):
        sums[i] = np.zeros(ways, np.int64)
        sums[i][0] = w
    heap = [(-int(w), i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    merged: list[tuple[int, int, np.ndarray]] = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        total = sums.pop(a) + sums.pop(b)[::-1]
        order = np.argsort(-total, kind="stable")
        total = total[order]
        node = n + len(merged)
        sums[node] = total - total[-1]  # only differences matter from here
        merged.append((a, b, order))
        heapq.heappush(heap, (-int(sums[node][0]), node))
    bins = np.empty(n, np.int64)
    place = {heap[0][1]: np.arange(ways)}
    for node in range(n + len(merged) - 1, -1, -1):
        own = place.pop(node)  # where each of its bins ended
        if node < n:
            bins[node] = own[0]
            continue
        a, b, order = merged[node - n]
        left, right = np.empty(ways, np.int64), np.empty(ways, np.int64)
        left[order] = own
        right[ways - 1 - order] = own
        place[a], place[b] = left, right
    return bins


def _differenced(items: DataFrame, ways: int) -> DataFrame:
    """``item, block, bin``: every block of ``items(item, weight, block)`` on its own."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("item", kind="stable")
        return pd.DataFrame(
            {
                "item": rows["item"].to_numpy(),
                "block": rows["block"].to_numpy(),
                "bin": differencing(rows["weight"].tolist(), ways),
            }
        )

    ship_package(items.sparkSession)
    return items.groupBy("block").applyInPandas(run, "item string, block string, bin long")


def assign(groups: DataFrame, shards: int = SHARDS, last_rows: int = LAST_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``item, shard`` of ``groups(item, weight)``, item a unique string."""
    items = cut(groups.select("item", F.col("weight").cast("bigint").alias("weight")))
    moves: list[DataFrame] = []
    while True:
        n, total = items.agg(F.count("*"), F.sum("weight")).first()
        heavy = F.col("weight") * (shards * HEAVY_PART) > (total or 0)
        light = items.where(~heavy)
        if n <= last_rows + shards * HEAVY_PART:
            break
        # 31 hash bits for the share 1/2, 1/4, ... and others for the block within it.
        level = F.lit(31) - F.length(F.regexp_replace(F.bin(F.pmod(F.xxhash64("item", F.lit(len(moves))), F.lit(2**31))), "^0+", ""))
        blocks = F.ceil(F.lit(float(n)) / F.pow(F.lit(2.0), F.col("level") + 1) / F.lit(block_rows)).cast("bigint")
        dealt = (
            light.withColumn("level", level)
            .withColumn("sub", F.pmod(F.xxhash64(F.lit(len(moves)), "item"), F.greatest(blocks, F.lit(1))))
            .withColumn("block", F.concat_ws(":", F.lit(f"r{len(moves)}"), "level", "sub"))
        )
        binned = cut(_differenced(dealt.select("item", "weight", "block"), shards))
        move = binned.select("item", F.concat_ws(":", "block", "bin").alias("grain"))
        grains = light.join(move, "item").groupBy("grain").agg(F.sum("weight").alias("weight"))
        moves.append(move)
        items = cut(items.where(heavy).union(grains))
    placed = cut(
        _differenced(items.withColumn("block", F.lit("last")), shards).select(
            "item", F.col("bin").cast("int").alias("shard")
        )
    )
    for move in reversed(moves):
        through = attach(move, placed.withColumnRenamed("item", "grain"), ["grain"]).select("item", "shard")
        placed = cut(through.union(placed))
    return placed


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per row: ``doc_id, size, text_crc32, shard, slot``; equal texts share a shard."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.sha2(text, 256).alias("item"),
    )
    rows = cut(rows)
    placed = assign(rows.groupBy("item").agg(F.sum("size").alias("weight")), shards)
    sharded = cut(attach(rows, placed, ["item"]).drop("item"))
    return number_within(sharded, "shard", ["doc_id", "size", "text_crc32"], "slot")
