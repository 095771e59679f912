import math
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest

from colfit.llm import langcodes


def test_codewords_are_far_apart():
    for n in (1, 2, 3, 4, 5, 20, 100):
        codes = langcodes.codewords(n)
        assert codes.shape[0] == n
        for i in range(n):
            for j in range(i):
                assert (codes[i] != codes[j]).sum() >= min(2, codes.shape[1])
        if n > 2:
            assert all(abs(c.sum()) < n for c in codes.T)


def clear_model(n, seed=2):
    """A model of n made-up languages with words of their own, and a text of each."""
    rng = np.random.default_rng(seed)

    def text():
        words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 10))) for _ in range(60)]
        return [" ".join(rng.choice(words, 300)) for _ in range(2)]

    pairs = [text() for _ in range(n)]
    counts = np.array([langcodes._histogram(a) for a, _ in pairs], float)
    return langcodes.Model([str(i) for i in range(n)], counts), [b for _, b in pairs]


@pytest.mark.parametrize("n", [4, 16, 40])
def test_a_wrong_bit_is_corrected(n):
    """As many equally sure classifiers may be wrong as the code corrects, and the least sure one of a text."""
    model, texts = clear_model(n)
    rng = np.random.default_rng(n)
    for i, text in enumerate(texts):
        margins = model.margins(langcodes._histogram(text))
        assert (np.sign(margins) == model.codes[i]).all()
        margins[np.argmin(np.abs(margins))] *= -1
        assert model.decoded(margins)[0] == str(i)
        far = min((model.codes[i] != c).sum() for j, c in enumerate(model.codes) if j != i)
        for sure in (0.3, 4.0, 30.0):
            for wrong in (1, (far - 1) // 2):
                flipped = model.codes[i] * sure
                flipped[rng.choice(len(flipped), wrong, replace=False)] *= -1
                assert model.decoded(flipped)[0] == str(i)
    near = model.codes[0] * 1.0
    apart = model.codes[0] != model.codes[1]
    near[apart] *= np.where(np.arange(apart.sum()) % 2, 1, -1)  # halfway between two codewords
    assert model.decoded(near)[2] and not model.decoded(model.codes[0] * 1.0)[2]


def plain_histogram(text):
    """Buckets of the n-grams of the letters, one at a time."""
    letters = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in (text or "").lower())
    letters = " ".join(letters.split())
    if not letters:
        return None
    data, counts = f" {letters} ".encode(), Counter()
    for i in range(len(data) - 2):
        code = int.from_bytes(data[i : i + 3], "big")
        counts[(code * 2654435769 & 0xFFFFFFFF) >> 32 - langcodes.BUCKET_BITS] += 1
    return counts


def plain_predictions(rows):
    """``lang, score, ambiguous`` of each row by loops over languages, bits and buckets."""
    totals = {}
    for doc_id, text, lang, _ in rows:
        held = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 0
        counts = plain_histogram(text)
        if counts and lang is not None and not held:
            totals.setdefault(lang, Counter()).update(counts)
    names, size = sorted(totals), 1 << langcodes.BUCKET_BITS
    codes = langcodes.codewords(len(names))
    whole = {n: totals[n].total() + langcodes.SMOOTHING * size for n in names}

    def share(name, bucket):
        return (totals[name][bucket] + langcodes.SMOOTHING) / whole[name]

    out = []
    for _, text, *_ in rows:
        counts = plain_histogram(text)
        if counts is None:
            out.append(("und", 0.0, True))
            continue
        margins = []
        for bit in codes.T:
            total = 0.0
            for bucket, times in counts.items():
                ones = [share(n, bucket) for n, b in zip(names, bit, strict=True) if b > 0]
                zeros = [share(n, bucket) for n, b in zip(names, bit, strict=True) if b < 0]
                total += times * math.log(sum(ones) / len(ones) / (sum(zeros) / len(zeros)))
            margins.append(max(-30, min(30, total / counts.total() * langcodes.SHARPNESS)))
        spread = sum(map(abs, margins))
        losses = [sum(abs(m) / spread * math.exp(-b * m / 4) for m, b in zip(margins, code, strict=True)) for code in codes]
        order = sorted(range(len(names)), key=lambda i: (losses[i], i))
        shown = [(losses[order[0]] / x) ** 2 for x in losses]
        first, second = codes[order[0]], codes[order[1]]
        apart = [(b * m, abs(m)) for b, c, m in zip(first, second, margins, strict=True) if b != c]
        clear = sum(a for a, _ in apart) / sum(a for _, a in apart)
        out.append((names[order[0]], 1 / sum(shown), clear < langcodes.AMBIGUOUS))
    return out


def test_against_plain_loops(docs, rows):
    found = {r["doc"]["doc_id"]: r for r in langcodes.identify(docs).collect()}
    for (doc_id, *_), (lang, score, ambiguous) in zip(rows, plain_predictions(rows), strict=True):
        r = found[doc_id]
        assert (r["lang_pred"], r["ambiguous"]) == (lang, ambiguous)
        assert r["score"] == pytest.approx(score, abs=1e-5)


@pytest.mark.parametrize("text", [None, "", "12 34", "½ ² Ⅷ ٣", "_ - !?", "\U0001f600 \u20ac", "①②③"])
def test_no_letters(text):
    assert langcodes.letters_of(text) == ""
    assert clear_model(3)[0].predict(text) == ("und", 0.0, True)


def test_letters():
    assert langcodes.letters_of("aª½b 中ǅ²x_ß9é") == "aª b 中ǆ x ß é"


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(langcodes, "MOST_LANGUAGES", 3)
    made = [(i, f"some words of it {i}", f"l{i % 4}") for i in range(40)]
    with pytest.raises(ValueError, match="more than 3"):
        langcodes.identify(spark.createDataFrame(made, "doc_id bigint, text string, lang string"))


def test_documents(docs, rows):
    found = {r["doc"]["doc_id"]: r for r in langcodes.identify(docs).collect()}
    assert len(found) == len(rows)
    for doc_id, text, lang, _ in rows:
        r = found[doc_id]
        assert r["doc"]["text"] == text and r["doc"]["held_out"] == "x"  # the row's own column
        assert 0 <= r["score"] <= 1
        if text is None or not any(unicodedata.category(c)[0] == "L" for c in text):
            assert (r["lang_pred"], r["score"], r["ambiguous"]) == ("und", 0.0, True)
        elif doc_id is not None and doc_id != 305:
            assert r["lang_pred"] == {"fr": "fr"}.get(lang, lang) or doc_id >= 100


def test_held_out_accuracy(docs, rows):
    found = langcodes.identify(docs).where("held_out").collect()
    known = [r for r in found if r["doc"]["doc_id"] is not None and r["doc"]["doc_id"] < 60]
    assert len(known) >= 5
    assert all(r["lang_pred"] == r["doc"]["lang"] for r in known)


def test_nothing_to_learn_and_empty(spark, docs, no_docs):
    blank = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in langcodes.identify(blank).collect()} == {"und"}
    assert langcodes.identify(no_docs).count() == 0


@pytest.mark.parametrize("n", [4, 50])
def test_clean_texts_of_many_languages_are_not_ambiguous(n):
    rng = np.random.default_rng(2)

    def word():
        return "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(2, 10)))

    common, own = [word() for _ in range(300)], [[word() for _ in range(60)] for _ in range(n)]

    def text(words, share):
        return " ".join(rng.choice(words if rng.random() < share else common) for _ in range(100))

    counts = np.array([langcodes._histogram(" ".join(text(words, 0.5) for _ in range(40))) for words in own], float)
    model = langcodes.Model([str(i) for i in range(n)], counts)
    found = [model.predict(text(words, 0.5)) for words in own]
    assert [f[0] for f in found] == [str(i) for i in range(n)]
    assert not any(f[2] for f in found)
    if n == 50:  # of no language more than of another
        assert np.mean([model.predict(text([], 0))[2] for _ in range(40)]) > 0.8
