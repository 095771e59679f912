import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from colfit.llm import spelling

UP = str.maketrans(spelling.UPPER, spelling.LOWER)


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def plain_counts(texts):
    """Words and their counts, of (doc_id, text)."""
    counts = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UP)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def plain_variants(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    best = {w: min(v, key=lambda x: (-counts[x], x)) for w, v in near.items() if v}
    form = {w: b for w, b in best.items() if counts[b] >= 2 * counts[w]}
    out = {}
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (n, len(near[w]), form.get(w), counts[form[w]] if w in form else None, root)
    return out


def some_words(seed, letters, n, longest):
    chosen = random.Random(seed)
    words = {"".join(chosen.choice(letters) for _ in range(chosen.randrange(5, longest))) for _ in range(n)}
    for word in sorted(words)[: n // 2]:
        at = chosen.randrange(len(word))
        words |= {word[:at] + chosen.choice(letters) + word[at:], word[:at] + chosen.choice(letters) + word[at + 1 :]}
        if len(word) > 5:
            words.add(word[:at] + word[at + 1 :])
    return {w: chosen.randrange(3, 200) for w in sorted(words)}


def found_variants(spark, counts):
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3)
    return {r["word"]: (r["n_near"], r["best_n"], r["best"]) for r in spelling.near_words(words).collect()}


def expected_near(counts):
    out = {}
    for w in counts:
        near = [v for v in counts if one_edit(w, v)]
        if near:
            best = min(near, key=lambda x: (-counts[x], x))
            out[w] = (len(near), counts[best], best)
    return out


@pytest.mark.parametrize(("letters", "longest"), [("ab", 9), ("abc", 12), ("aézÿß", 14)])
def test_near_words(spark, letters, longest):
    counts = some_words(len(letters), letters, 150, longest)
    assert found_variants(spark, counts) == expected_near(counts)


def test_hot_keys_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TILE_WORDS", 5)
    counts = some_words(9, "ab", 200, 8)
    assert found_variants(spark, counts) == expected_near(counts)


@pytest.mark.parametrize("at_once", [1, 3, 70])
def test_bounded_parts(monkeypatch, at_once):
    """Small chunks, windows and lanes give the same pairs."""
    counts = sorted(w for w in some_words(5, "abcd", 400, 9) if len(w) in (6, 7))
    rows = [w for w in counts]
    unit, asks = np.ones(len(rows), int), np.ones(len(rows), bool)
    whole = [set(zip(*(x.tolist() for x in spelling.near_pairs(6, p, unit, rows, asks, asks)), strict=True)) for p in range(3)]
    monkeypatch.setattr(spelling, "CELLS_AT_ONCE", at_once)
    monkeypatch.setattr(spelling, "LANES_AT_ONCE", at_once)
    parts = [set(zip(*(x.tolist() for x in spelling.near_pairs(6, p, unit, rows, asks, asks)), strict=True)) for p in range(3)]
    assert parts == whole
    # Whatever the unit, each pair is found in exactly one part; two longer words are not compared.
    assert sum(map(len, whole)) == len(set.union(*whole))
    pairs = {(i, j) for i, a in enumerate(rows) for j, b in enumerate(rows) if one_edit(a, b) and min(len(a), len(b)) == 6}
    assert set.union(*whole) == pairs


def test_long_words(spark):
    chosen = random.Random(2)
    word = "".join(chosen.choice("abcdefgh") for _ in range(30_000))
    counts = {word: 9, word[:-1]: 5, word[1:]: 3, word[:15_000] + "z" + word[15_001:]: 4, "short": 7}
    assert found_variants(spark, counts) == expected_near(counts)


def test_chunks_end_with_units(monkeypatch):
    import pyarrow as pa

    chosen = random.Random(4)
    rows = sorted((chosen.randrange(5, 8), chosen.randrange(3), chosen.randrange(40)) for _ in range(3000))
    table = pa.table({c: [r[i] for r in rows] for i, c in enumerate(("length", "part", "unit"))})
    monkeypatch.setattr(spelling, "ROWS_AT_ONCE", 50)
    got, seen = [], set()
    for part in spelling._groups(iter(table.to_batches(max_chunksize=170))):
        own = [tuple(r.values()) for r in part.to_pylist()]
        assert len({r[:2] for r in own}) == 1
        assert not seen & set(own)
        seen |= set(own)
        got += own
    assert got == rows


def test_documents(spark, docs, rows):
    chosen = random.Random(8)
    words = ["morning", "mornings", "mornin", "MORNING", "Mourning", "river", "rivers", "Straße", "Strasse", "été", "étés", "ÀÀÀÀÀ", "ààààà", "aaaaa", "aaaaaa"]
    texts = [(i, t) for i, t, *_ in rows] + [(5000 + i, " ".join(chosen.choices(words, k=40)) + "\nx-ray's 3rd") for i in range(60)]
    table = spark.createDataFrame([(*t, 1, "x") for t in texts], "doc_id bigint, text string, n int, word string").repartition(3)
    found = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in spelling.variants(table).collect()}
    expected = plain_variants(plain_counts(texts))
    assert any(e[2] for e in expected.values()) and any(e[4] != (e[2] or w) for w, e in expected.items())
    assert found == expected


def test_long_chains(spark):
    """Roots by doubling over a chain of forms."""
    chain = ["a" * 5 + "b" * i for i in range(12)]
    forms = spark.createDataFrame([(a, b) for a, b in zip(chain, chain[1:], strict=False)] + [("x" * 5, chain[3])], "word string, form string")
    roots = {r["word"]: r["root"] for r in spelling._roots(forms).collect()}
    assert roots == {w: chain[-1] for w in [*chain[:-1], "x" * 5]}


def test_empty_and_repeated(spark, no_docs, repeated, rows):
    assert spelling.variants(no_docs).count() == 0
    found = {r["word"]: r["n"] for r in spelling.variants(repeated).collect()}
    assert found == {w: n for w, n in plain_counts([(i, t) for i, t, *_ in rows] * 2).items()}
