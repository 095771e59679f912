import math

import numpy as np
import pytest

from colfit.llm import subspace

SCHEMA = "vec_id bigint, embedding array<float>, label int, n_links string, class string"


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    out = []
    for label in (0, 1):
        for centre in rng.standard_normal((25, 64)):
            for noise in (0.0, 0.02, 0.06, 0.2, 0.35):
                out.append((centre + noise * rng.standard_normal(64), label))
    out += [(out[0][0], 0)] * 40 + [(3 * out[0][0], 0), (out[0][0], 1)]
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, (v, label) in enumerate(out)]
    n = len(rows)
    bad = [[0.0] * 64, None, [], [1.0, None], [float("nan")] * 64, [float("inf")] + [1.0] * 63]
    rows += [(n + i, v, 0) for i, v in enumerate(bad)]
    rows += [(n + 10, rows[0][1], None), (n + 11, [1.0, 2.0], 0), (n + 12, [2.0, 4.0], 0)]
    return rows


def plain(rows):
    """Links over all pairs."""
    def ok(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links = {i: set() for i, _, _ in rows}
    usable = [(i, np.array(v, float), label) for i, v, label in rows if label is not None and ok(v)]
    for a, x, l in usable:
        for b, y, m in usable:
            if a < b and l == m and len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= subspace.COSINE:
                links[a].add(b)
                links[b].add(a)
    label = {i: i for i in links}
    changed = True
    while changed:
        new = {i: min([label[i], *(label[j] for j in links[i])]) for i in links}
        changed, label = new != label, new
    return {i: (len(links[i]), label[i], label[i] == i) for i in links}


@pytest.mark.parametrize("tile", [2000, 9])
def test_against_all_pairs(spark, vectors, monkeypatch, tile):
    monkeypatch.setattr(subspace, "TILE_ROWS", tile)
    df = spark.createDataFrame([(*r, "x", "y") for r in vectors], SCHEMA).repartition(3)
    found = subspace.near_vectors(df).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in found} == plain(vectors)


def test_empty_and_null_id(spark, vectors):
    df = spark.createDataFrame([(None, vectors[0][1], 0, "", ""), (1, vectors[0][1], 0, "", "")], SCHEMA)
    assert {tuple(r) for r in subspace.near_vectors(df).collect()} == {(None, 0, None, True), (1, 0, 1, True)}
    assert subspace.near_vectors(df.limit(0)).count() == 0


def test_rotation_keeps_distances():
    q = subspace.rotation(64)
    assert np.allclose(q @ q.T, np.eye(64))
