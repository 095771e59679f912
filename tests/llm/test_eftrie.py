import math
import os
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from colfit.llm import eftrie
from colfit.llm.monotone import MonotoneSequence


@pytest.mark.parametrize("n, top", [(0, 10), (1, 5), (63, 100), (64, 64), (65, 1 << 40), (1000, 1000), (30_000, 1 << 44)])
def test_sequences(n, top):
    rng = np.random.default_rng(n)
    values = np.unique(rng.integers(0, top, n)) if n else np.empty(0, np.int64)
    if n > 1000:  # a dense run among sparse values
        values = np.unique(np.concatenate((values, 12345 + 3 * np.arange(5000))))
    sequence = MonotoneSequence.build(values)
    assert (sequence.decode() == values).all()
    place = {int(v): i for i, v in enumerate(values)}
    asked = np.concatenate((values, values + 1, rng.integers(0, top, 100)))
    assert sequence.find(asked).tolist() == [place.get(int(v), -1) for v in asked]
    repeated = np.sort(np.concatenate((values, values[::3])))
    assert (MonotoneSequence.build(repeated).decode() == repeated).all()


def test_values_close_together_are_found_in_few_steps(monkeypatch):
    # Nearly all values of a block share their high bits, so only the low bits tell them apart.
    values = (np.arange(50)[:, None] * (1 << 30) + np.append(np.arange(0, 189, 3), 1 << 29)).ravel()
    sequence, steps = MonotoneSequence.build(values), []
    lows = MonotoneSequence._lows
    monkeypatch.setattr(MonotoneSequence, "_lows", lambda *a: steps.append(1) or lows(*a))
    asked = np.concatenate((values, values + 1))
    expected = np.append(np.arange(len(values)), np.full(len(values), -1))
    assert (sequence.find(asked) == expected).all()
    assert len(steps) <= 7  # before, one for each of 63 values


def test_a_range_of_a_sequence():
    values = np.cumsum(np.random.default_rng(3).integers(1, 1 << 20, 700_000))
    sequence = MonotoneSequence.build(values)
    for a, b in ((0, 0), (5, 6), (63, 65), (100, 600_000), (699_999, 700_000)):
        assert (sequence.decode(a, b) == values[a:b]).all()


def tokens(text):
    return [*(text or "").encode().lower().split(), b" "]


def held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


class Plain:
    """The same model from dictionaries, without quantising."""

    def __init__(self, texts):
        self.one, self.two, self.three = Counter(), Counter(), Counter()
        for t in texts:
            words = tokens(t)
            self.one.update(words)
            chain = [b"<", *words]
            self.two.update(zip(chain, chain[1:], strict=False))
            self.three.update(zip(chain, chain[1:], chain[2:], strict=False))
        self.n, self.v, self.texts = sum(self.one.values()), len(self.one), len(texts)
        self.left1, self.left2 = Counter(), Counter()
        for (a, _), c in self.two.items():
            self.left1[a] += c - eftrie.DISCOUNT
        for (a, b, _), c in self.three.items():
            self.left2[a, b] += c - eftrie.DISCOUNT

    def p1(self, c):
        return (self.one[c] + 0.1) / (self.n + 0.1 * (self.v + 1))

    def p2(self, b, c):
        total = self.texts if b == b"<" else self.one[b]
        if not total:
            return self.p1(c)
        lower = (1 - self.left1[b] / total) * self.p1(c)
        return max(self.two.get((b, c), 0) - eftrie.DISCOUNT, 0) / total + lower

    def p3(self, a, b, c):
        total = self.two.get((a, b))
        if not total:
            return self.p2(b, c)
        lower = (1 - self.left2[a, b] / total) * self.p2(b, c)
        return max(self.three.get((a, b, c), 0) - eftrie.DISCOUNT, 0) / total + lower

    def score(self, text):
        chain = [b"<", *tokens(text)]
        out = [self.p2(chain[0], chain[1])]
        out += [self.p3(*t) for t in zip(chain, chain[1:], chain[2:], strict=False)]
        return sum(map(math.log10, out))

    def base(self, text):
        return sum(math.log10(self.p1(t)) for t in tokens(text))


@pytest.mark.parametrize("shard_tokens, shard_words", [(1 << 40, 1 << 40), (20_000, 10)])
def test_scores(spark, docs, rows, monkeypatch, shard_tokens, shard_words):
    monkeypatch.setattr(eftrie, "SHARD_TOKENS", shard_tokens)
    monkeypatch.setattr(eftrie, "SHARD_WORDS", shard_words)
    before = set(os.listdir(spark.conf.get("spark.checkpoint.dir")))
    found = {r["doc_id"]: r for r in eftrie.learn_and_score(docs).collect()}
    left = {f for f in set(os.listdir(spark.conf.get("spark.checkpoint.dir"))) - before if f.startswith("ngrams")}
    assert not left
    assert len(found) == len(rows)
    plain = Plain([r[1] for r in rows if not held(r[0])])
    step = -eftrie.LOWEST_LOG / 255
    for doc_id, text, *_ in rows:
        r, words = found[doc_id], tokens(text)
        assert r["held_out"] == held(doc_id) and r["train_tokens"] == plain.n
        assert r["n_tokens"] == len(words) and r["n_known"] == sum(plain.one[w] > 0 for w in words)
        assert r["base_score"] == pytest.approx(plain.base(text))
        # Every stored logarithm is off by half a step at most, and a token adds up to three.
        assert abs(r["score"] - plain.score(text)) <= 1.6 * step * len(words)


def test_nothing_to_learn_and_empty(docs, no_docs):
    assert eftrie.learn_and_score(no_docs).count() == 0
    one = eftrie.learn_and_score(docs.where("doc_id IS NULL")).collect()  # held out
    assert one[0]["n_known"] == 0 and one[0]["train_tokens"] == 0


def test_repeated(repeated, rows):
    assert eftrie.learn_and_score(repeated).count() == 2 * len(rows)


def test_parts_of_any_size_give_the_same(spark, docs, rows, tmp_path, monkeypatch):
    sizes = eftrie.learn(docs.where(~eftrie.held_out(docs.doc_id)), str(tmp_path / "model"))
    model = eftrie.trie(sizes, True)
    batch = pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows])], ["text"])

    def logs():
        parts = list(eftrie.token_ids([batch], model.vocabulary))
        return len(parts), *(np.concatenate(x) for x in zip(*map(model.logs, parts), strict=True))

    whole = logs()
    assert whole[0] == 1
    for size, tokens_at_once in ((1, 1 << 20), (2000, 1 << 20), (1 << 30, 100)):
        monkeypatch.setattr(eftrie, "BYTES_AT_ONCE", size)
        monkeypatch.setattr(eftrie, "TOKENS_AT_ONCE", tokens_at_once)
        cut = logs()
        assert cut[0] > 10 and all((a == b).all() for a, b in zip(whole[1:], cut[1:], strict=True))
