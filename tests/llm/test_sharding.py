import random
import zlib
from collections import defaultdict

import numpy as np

from colfit.llm import sharding


def test_differencing_by_hand():
    weights = [8, 7, 6, 5, 4]
    bins = sharding.differencing(weights, 2)
    sums = np.bincount(bins, weights)
    assert sorted(sums) == [14, 16]  # the classic example: the difference is two


def test_differencing_is_tight():
    rng = random.Random(1)
    weights = [rng.randrange(1, 10_000) for _ in range(2000)]
    sums = np.bincount(sharding.differencing(weights, 24), weights)
    assert sums.max() - sums.min() <= 2


def test_rounds_keep_balance(spark):
    rng = random.Random(2)
    weights = [rng.randrange(1, 3000) for _ in range(3000)] + [120_000, 90_000]
    groups = spark.createDataFrame([(f"g{i}", w) for i, w in enumerate(weights)], "item string, weight bigint")
    placed = {r["item"]: r["shard"] for r in sharding.assign(groups, 8, last_rows=200, block_rows=100).collect()}
    assert len(placed) >= len(weights)
    sums = np.bincount([placed[f"g{i}"] for i in range(len(weights))], weights)
    assert sums.max() - sums.min() < 0.01 * sums.mean()


def test_documents(docs, rows):
    found = sharding.shard_documents(docs, 5).collect()
    assert len(found) == len(rows)
    text = {r[0]: r[1] or "" for r in rows}
    shard_of, slots = {}, defaultdict(list)
    for r in found:
        data = text[r["doc_id"]].encode()
        assert r["size"] == len(data) + 8
        assert r["text_crc32"] == zlib.crc32(data)
        assert shard_of.setdefault(data, r["shard"]) == r["shard"]
        slots[r["shard"]].append(r["slot"])
    for numbers in slots.values():
        assert sorted(numbers) == list(range(len(numbers)))


def test_empty_and_repeated(no_docs, repeated, rows):
    assert sharding.shard_documents(no_docs, 5).count() == 0
    assert sharding.shard_documents(repeated, 5).count() == 2 * len(rows)
