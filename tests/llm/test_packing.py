import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from colfit.llm import packing
from colfit.llm.plans import PACKING_TOKENIZER


def check(found, rows, window, times=1):
    tokenizer = Tokenizer.from_file(PACKING_TOKENIZER)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    total = 0
    for doc_id, text, *_ in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        covered = np.zeros(len(ids), int)
        for p in pieces[doc_id]:
            part = ids[p["start"] : p["start"] + p["length"]]
            covered[p["start"] : p["start"] + p["length"]] += 1
            assert p["doc_tokens"] == len(ids)
            assert len(part) == p["length"] > 0 and p["ids_crc32"] == zlib.crc32(part.tobytes())
        assert (covered == times).all()
        total += times * len(ids)
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
    return total, len(sequences)


@pytest.mark.parametrize("window, shard", [(2048, 1000), (64, 10)])
def test_every_id_once(docs, rows, monkeypatch, window, shard):
    monkeypatch.setattr(packing, "SHARD_ROWS", shard)
    total, sequences = check(packing.pack(docs, PACKING_TOKENIZER, window).collect(), rows, window)
    assert sequences <= -(-total // window) + 1  # one window is padded


def test_repeated_and_empty(repeated, rows, no_docs):
    check(packing.pack(repeated, PACKING_TOKENIZER).collect(), rows, 2048, times=2)
    assert packing.pack(no_docs, PACKING_TOKENIZER).count() == 0


def known_of(pieces):
    """What a corpus of such remainders says, counted one by one."""
    n = len(pieces)
    df = np.array([sum(t in p for p in pieces) for t in range(16)], float)
    idf = np.maximum(np.log((n - df + 0.5) / (df + 0.5)), 0)
    return packing.Corpus(idf, np.zeros(16, np.int64), np.mean([len(p) for p in pieces]))


def test_counts_of_the_corpus(spark):
    rng = np.random.default_rng(3)
    pieces = [rng.integers(0, 16, rng.integers(1, 9)).astype(np.uint16) for _ in range(60)]
    rows = spark.createDataFrame([(p.tobytes(),) for p in pieces] + [(b"",)], "rest binary").repartition(4)
    found, expected = packing.corpus(rows, np.uint16, 16), known_of(pieces)
    assert np.allclose(found.idf, expected.idf) and found.mean == expected.mean
    df = [sum(t in p for p in pieces) for t in range(16)]
    order = sorted((t for t in range(16) if df[t] > 1 and found.idf[t] > 0), key=lambda t: (df[t], t))
    none = (1 << packing.RARITY_BITS) - 1
    assert found.rarity.tolist() == [order.index(t) if t in order else none for t in range(16)]
    for piece, key in zip(pieces, packing.sort_keys(pieces, found).tolist(), strict=True):
        ranks = sorted({int(found.rarity[t]) for t in piece} - {none})[: packing.RAREST]
        ranks += [none] * (packing.RAREST - len(ranks))
        assert key == sum(r << packing.RARITY_BITS * (packing.RAREST - 1 - i) for i, r in enumerate(ranks))
    nothing = packing.corpus(rows.limit(0), np.uint16, 16)
    assert not nothing.idf.any() or np.isfinite(nothing.idf).all()


def test_far_neighbours_share_a_window(spark):
    """With the shards as shipped: of 1,500 pairs that share rare words, those far apart in the table meet."""
    rng = np.random.default_rng(9)
    words = sorted(w[:-4] for w in Tokenizer.from_file(PACKING_TOKENIZER).get_vocab() if w.endswith("</w>") and w[:-4].isalpha() and len(w) > 8)
    words = rng.permutation(words)
    common, words = words[:40], words[40:]  # each is a single term
    made = []
    for pair in range(1500):
        for side in range(2):
            text = [*rng.choice(common, 30), *words[4 * pair : 4 * pair + 4]]
            rng.shuffle(text)
            made.append((int(rng.integers(0, 1 << 40)) * 4000 + 2 * pair + side, " ".join(text)))
    docs = spark.createDataFrame(made, "doc_id bigint, text string").repartition(4)
    where = {}
    for r in packing.pack(docs, PACKING_TOKENIZER, 256).collect():
        where.setdefault(r["doc_id"], set()).add(r["sequence_id"])
    pairs = {}
    for doc_id, _ in made:
        pairs.setdefault(doc_id % 4000 // 2, []).append(where[doc_id])
    assert sum(bool(a & b) for a, b in pairs.values()) >= 0.9 * len(pairs)


def test_best_neighbour_first():
    pieces = [np.array(p, np.uint16) for p in ([1, 2, 3, 9], [4, 5, 6], [2, 3, 7, 9], [8, 7, 3], [5, 6, 10], [11, 12])]
    known = known_of([*pieces, np.array([1, 2, 3, 4], np.uint16), np.array([7], np.uint16)])
    index = packing.Index(pieces, known)
    ranked = index.neighbours(0).tolist()
    assert ranked[:2] == [0, 2]

    def plain(seed):
        whole = [*pieces, np.array([1, 2, 3, 4]), np.array([7])]  # of the corpus
        n, mean = len(whole), np.mean([len(p) for p in whole])
        scores = []
        for p in pieces:
            s = 0.0
            for t in set(pieces[seed].tolist()):
                df = sum(t in q for q in whole)
                tf = int((p == t).sum())
                norm = packing.K1 * (1 - packing.B + packing.B * len(p) / mean)
                s += max(0.0, np.log((n - df + 0.5) / (df + 0.5))) * tf * (packing.K1 + 1) / (tf + norm)
            scores.append(s)
        return np.argsort(-np.array(scores), kind="stable").tolist()

    for seed in range(len(pieces)):
        assert index.neighbours(seed).tolist() == plain(seed)


def test_encoder_agrees_with_the_library(rows):
    tokenizer = Tokenizer.from_file(PACKING_TOKENIZER)
    texts = [r[1] or "" for r in rows] + ["w" * 500 + " " + "é" * 200, "a\x1cb\x85c d　e", "É Σσ İI", "it's  don't\tWE'LL"]
    for text, ids in zip(texts, packing.WordEncoder(PACKING_TOKENIZER).encode(pa.array(texts)), strict=True):
        assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
