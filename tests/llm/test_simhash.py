import numpy as np
import pytest
import xxhash

from colfit.llm import simhash


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_groups(pairs):
    """Smallest id reachable, by rounds over all pairs."""
    label = {i: i for i, _ in pairs}
    while True:
        before = dict(label)
        for i, x in pairs:
            for j, y in pairs:
                if (x ^ y).bit_count() <= 4:
                    label[i] = min(label[i], label[j])
        if label == before:
            return label


def test_against_all_pairs(docs, rows):
    known = [r for r in rows if r[0] is not None]
    prints = {r[0]: plain_fingerprint(r[1]) for r in known if len(r[1] or "") < 100_000}
    found = {r["doc_id"]: r for r in simhash.near_groups(docs.where("doc_id IS NOT NULL")).collect()}
    assert len(found) == len(known)
    for i, fp in prints.items():
        assert found[i]["fp"] & (1 << 64) - 1 == fp
    groups = plain_groups([(i, found[i]["fp"] & (1 << 64) - 1) for i in found])
    assert {i: r["component_id"] for i, r in found.items()} == groups


def test_anchors_are_those_within_two():
    rng = np.random.default_rng(5)
    width = 17
    code = [c for c in range(1 << simhash.CODE_BITS) if simhash._syndromes(np.array([c]))[0] == 0]
    words = np.array([c | r << simhash.CODE_BITS for c in code for r in range(4)])
    blocks = rng.integers(0, 1 << width, 40)
    number, anchor, home = simhash.anchors_within_two(blocks, width)
    for i, block in enumerate(blocks):
        far = np.bitwise_count((words ^ block).astype(np.uint64))
        mine = anchor[number == i]
        assert sorted(mine) == sorted(words[far <= 2])
        assert far.min() <= 1
        assert home[number == i].sum() == 1


def test_tiles_and_chunks_lose_no_link(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 1 << 62))
    prints = {centre ^ sum(1 << int(b) for b in rng.choice(64, 2, replace=False)) for _ in range(150)}
    prints |= {int(x) for x in rng.integers(0, 1 << 62, 150)}
    distinct = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp bigint")
    monkeypatch.setattr(simhash, "TILE_ROWS", 7)
    edges = {tuple(r) for r in simhash.links(distinct).collect()}
    parent = {p: p for p in prints}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = a & (1 << 64) - 1, b & (1 << 64) - 1
        parent[max(top(a), top(b))] = min(top(a), top(b))
    assert {p: top(p) for p in prints} == plain_groups([(p, p) for p in prints])


@pytest.mark.parametrize("tile", [20_000, 3])
def test_one_of_each_group_stays(docs, rows, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE_ROWS", tile)
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert len(ids) == len(set(ids))
    groups = plain_groups([(r[0], plain_fingerprint(r[1])) for r in rows if r[0] is not None])
    assert set(ids) == set(groups.values()) | {None}
    assert len(ids) < len(rows)


def test_empty(no_docs):
    assert simhash.near_groups(no_docs).count() == 0
    assert simhash.keep_one(no_docs).count() == 0


def test_repeated_rows(repeated, rows):
    assert simhash.near_groups(repeated).count() == 2 * len(rows)
    groups = plain_groups([(r[0], plain_fingerprint(r[1])) for r in rows if r[0] is not None])
    assert simhash.keep_one(repeated).count() == 2 * (len(set(groups.values())) + 1)
