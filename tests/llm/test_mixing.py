from collections import Counter

import pytest
from pyspark.sql import functions as F

from colfit.llm import mixing


def plain_targets(sizes, weights):
    """Share, stop at three times the size, share the excess, until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    stopped, left = {}, sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in stopped]
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return {**stopped, **share}
        for s in over:
            stopped[s] = 3 * sizes[s]
            left -= 3 * sizes[s]


def words(text):
    return len((text or "").encode().split())


def test_targets_and_words_taken(docs, rows):
    found = mixing.mix(docs).select("doc_id", "doc.source", "size", "source_size", "target", "copies", "taken").collect()
    assert len(found) == len(rows)
    text = {r[0]: r[1] for r in rows}
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += words(r[1])
    goal = plain_targets(sizes, mixing.WEIGHTS)
    taken, largest = Counter(), Counter()
    for r in found:
        assert r["size"] == words(text[r["doc_id"]])
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(goal[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, target in goal.items():
        fits = [r["size"] for r in found if r["source"] == source and 0 < r["size"]]
        assert taken[source] <= target + 1e-6
        # No document that was passed over still fits the gap by much.
        assert target - taken[source] <= 0.05 * target + min(fits, default=0)


def test_same_again_and_by_other_partitions(docs):
    once = sorted(map(tuple, mixing.mix(docs).select("doc_id", "taken").collect()), key=repr)
    again = sorted(map(tuple, mixing.mix(docs.repartition(7, "lang")).select("doc_id", "taken").collect()), key=repr)
    assert once == again


def test_copies_come_out_whole(docs):
    expected = mixing.mix(docs).agg(F.sum("copies")).first()[0]
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert out.count() == expected


def test_empty(no_docs):
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mixed(no_docs).count() == 0


def test_repeated_rows_are_taken_alike(repeated):
    found = mixing.mix(repeated).groupBy("doc_id").agg(F.countDistinct("taken").alias("n")).where("n > 1")
    assert found.count() == 0
