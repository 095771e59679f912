import hashlib
import json
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from colfit.llm import alignment
from colfit.llm.plans import COUNTING_TOKENIZER, PIECE_TOKENIZER
from colfit.llm.prefixcounts import _byte_letters

SOME = [
    "the river ran  over\nstones",
    " ",
    "  two before, two after  ",
    "Straße ÉTÉ \U0001f600 中文 é <s> </s> <unk> <|endoftext|> <0x41>",
    "a\x00b\tc　d\xa0e",
    "has ▁ inside",
    "xyzzy" * 200,
    " " * 70 + "x" + " " * 33,
    "ﬁ ǅ ½ ́",
]


@pytest.fixture(scope="module")
def plain():
    """Both sides of a text as (id, first byte, end), encoded whole by the libraries."""
    a = Tokenizer.from_file(COUNTING_TOKENIZER)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECE_TOKENIZER)
    letters = _byte_letters()
    with open(COUNTING_TOKENIZER, encoding="utf-8") as file:
        entry = {i: bytes(letters[c] for c in t) for t, i in json.load(file)["model"]["vocab"].items() if all(c in letters for c in t)}

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def spans(ids, of):
        out, at = [], 0
        for i in ids:
            out.append((i, at, at + len(of(i))))
            at = out[-1][2]
        return out

    def both(text):
        if not text:
            return [], []
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text, num_threads=1)
        if b"".join(map(entry.get, ids_a)) != (" " + text).encode() or b"".join(map(piece, ids_b)) != (" " + text).encode():
            return [], []
        return spans(ids_a, entry.get), spans(ids_b, piece)

    return both


def brute_force(texts, plain):
    """Of each text: n_a, n_b, n_groups, n_links, n_best, count_sum, digest; every pair of tokens is looked at."""
    found, counts = [], Counter()
    for text in texts:
        a, b = plain(text)
        links = Counter()
        for i, s, e in a:
            for j, t, f in b:
                if t >= e:
                    break
                if f > s:
                    links[i, j] += 1
        common = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, start = [], 0
        for end in common:
            groups.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= end) for side in (a, b)))
            start = end
        counts.update(links.keys())
        found.append((len(a), len(b), len(groups), links, ";".join(groups)))
    best = {}
    for (i, _), n in counts.items():
        best[i] = max(best.get(i, 0), n)
    return [
        (
            n_a,
            n_b,
            n_groups,
            sum(links.values()),
            sum(t for (i, j), t in links.items() if counts[i, j] == best[i]),
            sum(t * counts[p] for p, t in links.items()),
            hashlib.sha256(groups.encode()).hexdigest() if n_a else "",
        )
        for n_a, n_b, n_groups, links, groups in found
    ]


def result(rows):
    return [tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for r in rows]


@pytest.mark.parametrize("step", [1, 2, 3, 7, 64, 10_000])
def test_pieces_of_the_path(step):
    chosen = np.random.default_rng(step)
    for _ in range(50):
        n = int(chosen.integers(1, 200))
        a = np.union1d(chosen.choice(n, chosen.integers(0, n)) + 1, [n])
        b = np.union1d(chosen.choice(n, chosen.integers(0, n)) + 1, [n])
        of_a, of_b = alignment.splits(a, b, step)
        assert (np.diff(of_a + of_b)[:-1] == step).all()  # equal work
        merged = sorted([(x, 0, i) for i, x in enumerate(a)] + [(x, 1, j) for j, x in enumerate(b)])
        for i, j in zip(of_a, of_b, strict=True):
            before = merged[: i + j]
            assert sum(1 for m in before if m[1] == 0) == i
        left, right, close_a, close_b = alignment.overlaps(a, b, step)
        starts_a, starts_b = np.concatenate(([0], a[:-1])), np.concatenate(([0], b[:-1]))
        expected = {(i, j) for i in range(len(a)) for j in range(len(b)) if starts_a[i] < b[j] and starts_b[j] < a[i]}
        assert len(left) == len(expected) and set(zip(left.tolist(), right.tolist(), strict=True)) == expected
        assert a[close_a].tolist() == b[close_b].tolist() == np.intersect1d(a, b).tolist()


def test_texts_equal_whole_encoding(plain):
    chosen = random.Random(4)
    parts = [*"ab'st LL  \n\t12!?é中\U0001f642 ' ½▁", "'re", "ing", "the ", "   ", "<s>"]
    texts = SOME + ["".join(chosen.choice(parts) for _ in range(chosen.randrange(0, 60))) for _ in range(1500)]
    own = alignment.Aligner(COUNTING_TOKENIZER, PIECE_TOKENIZER)
    found = own.align(texts)
    for i, text in enumerate(texts):
        a, b = plain(text)
        assert (found["n_a"][i], found["n_b"][i]) == (len(a), len(b)), text
        groups = found["groups"][i].decode()
        sides = [g.split("|") for g in groups.split(";")] if groups else []
        assert [int(t) for g, _ in sides for t in g.split(",")] == [t for t, *_ in a]
        assert [int(t) for _, g in sides for t in g.split(",")] == [t for t, *_ in b]
        alone = own.align([text])
        assert alone["groups"][0] == found["groups"][i]


@pytest.mark.parametrize("most", [alignment.BROADCAST_PAIRS, 60, 0])
def test_documents(spark, docs, rows, plain, most):
    short = [(i, t if t is None else t[:3000], *r) for i, t, *r in rows] + [(1000 + i, t, "en", "x") for i, t in enumerate(SOME)]
    table = spark.createDataFrame([(r[0], r[1], 1) for r in short], "doc_id bigint, text string, row int").repartition(3)
    found = alignment.align_and_count(table, COUNTING_TOKENIZER, PIECE_TOKENIZER, most).collect()
    order = {r["doc_id"]: r for r in found}
    assert len(order) == len(found) == len(short)
    assert result([order[r[0]] for r in short]) == brute_force([r[1] for r in short], plain)


def test_empty_and_repeated(no_docs, repeated, rows):
    assert alignment.align_and_count(no_docs, COUNTING_TOKENIZER, PIECE_TOKENIZER).count() == 0
    assert alignment.align_and_count(repeated, COUNTING_TOKENIZER, PIECE_TOKENIZER).count() == 2 * len(rows)
