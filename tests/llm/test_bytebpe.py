import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from colfit.llm import bytebpe, pretoken

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [
    "",
    " ",
    "\n",
    "   ",
    "it's we'll they've I'm you're 'd'd' 'S 'LL '' 's''s x's'",
    " 's  's\n's 'r 'v 'l 're've'll'm'd't's",
    "'",
    "'r",
    "a'r",
    "x  \n  y \t z\n\n",
    " \nx",
    "\n x",
    "a b 　 c  d e\x85",
    "12 345abc67½² Ⅷ ٣",
    "<|endoftext|> Straße ÉTÉ \U0001f600\U0001f600 中文 é",
    "!!?? ... 'quoted' (x) [y] a_b __init__ -- —",
    "\U00011f02\U00013460 \U00010d4a \U0001e5d0",
    "a" * 500 + " " * 400 + "!?" * 300,
]


@pytest.fixture(scope="module")
def library():
    ranks = bytebpe.read_ranks(PATH)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def pieces(texts):
    text, points, ends = bytebpe.joined(texts)
    return bytebpe.cut_at(text, pretoken.piece_starts(points, ends))


def matches(text):
    # The classes as the library has them; another Unicode version would differ.
    table = pretoken.classes()
    masked = "".join("xx1! "[table[ord(c)] + 1] if ord(c) > 127 else c for c in text)
    pattern = public_tokenizers.PATTERN
    # White space that is no blank must not become one.
    masked = "".join("\t" if m == " " and c != " " else m for m, c in zip(masked, text, strict=True))
    return [text[m.start() : m.end()] for m in regex.finditer(pattern, masked)]


def random_texts(n, seed):
    chosen = random.Random(seed)
    parts = [*"ab'sreltvmd LL  \n\t12!?é中\U0001f642 ' ½", "'re", "'ll", "  ", "the ", "ing", "\r\n"]
    return ["".join(chosen.choice(parts) for _ in range(chosen.randrange(0, 40))) for _ in range(n)]


def test_few_functions_and_associative():
    functions, _ = pretoken._machine()
    assert functions.n < 500
    chosen = np.random.default_rng(1)
    a, b, c = chosen.integers(0, functions.n, (3, 5000))
    then = functions.then.reshape(functions.n, functions.n)
    assert (then[then[a, b], c] == then[a, then[b, c]]).all()


@pytest.mark.parametrize("n", [1, 2, 127, 128, 129, 1000, 128 * 128 + 5, 60_000])
def test_products_equal_a_loop(n):
    functions, _ = pretoken._machine()
    symbols = np.random.default_rng(n).integers(0, 2 * pretoken.SYMBOLS, n)
    given = functions.of_symbol[symbols]
    held, expected = 0, []
    for f in given.tolist():
        held = int(functions.then[held * functions.n + f])
        expected.append(held)
    assert functions.products(given).tolist() == expected


def test_pieces_equal_the_pattern():
    texts = TEXTS + random_texts(3000, 5)
    assert pieces(texts) == [p for t in texts for p in matches(t)]
    for text in texts[:200]:  # alone as in company
        assert pieces([text]) == matches(text)


def test_ids_equal_the_library(library):
    texts = TEXTS + random_texts(2000, 6)
    ids, tokens, starts = bytebpe.codec(PATH).encode(texts)
    for i, text in enumerate(texts):
        own = ids[tokens[i] : tokens[i + 1]].tolist()
        assert own == library.encode_ordinary(text), text
        lengths = [len(library.decode_single_token_bytes(t)) for t in own]
        assert starts[tokens[i] : tokens[i + 1]].tolist() == [sum(lengths[:k]) for k in range(len(own))]


def test_heap_merges_like_the_plain_way(library):
    ranks = bytebpe.read_ranks(PATH)
    chosen = random.Random(3)
    for _ in range(300):
        data = bytes(chosen.choice(b"aabethino stion") for _ in range(chosen.randrange(2, 60)))
        if data not in ranks:
            assert bytebpe._merged_by_heap(data, ranks) == bytebpe.merged(data, ranks)
    long = "".join(chosen.choice("abcdetion") for _ in range(200_000))
    assert [ranks[t] for t in bytebpe.merged(long.encode(), ranks)] == library.encode_ordinary(long)


def test_forgetting_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(bytebpe, "MOST_PIECES", 20)
    own = bytebpe.Codec(PATH)
    for texts in (random_texts(50, s) for s in range(20)):
        ids, tokens, _ = own.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(tokens, tokens[1:], strict=False)] == [library.encode_ordinary(t) for t in texts]


def test_every_code_point(library):
    texts = [f"a{chr(c)}1{chr(c)} {chr(c)}." for c in range(0x110000) if not 0xD800 <= c < 0xE000 and c % 7 == 0]
    ids, _, _ = bytebpe.codec(PATH).encode(texts)
    expected = [i for t in library.encode_ordinary_batch(texts, num_threads=4) for i in t]
    assert ids.tolist() == expected


def test_documents(docs, rows, library):
    encoded = bytebpe.encode(docs, PATH)
    found = {r["doc_id"]: r for r in encoded.collect()}
    data = {r["doc_id"]: r["data"] for r in bytebpe.decode(encoded, PATH).collect()}
    digest = {r["doc_id"]: r for r in bytebpe.digests(encoded, PATH).collect()}
    assert len(found) == len(rows)
    for doc_id, text, *_ in rows:
        text = text or ""
        ids = library.encode_ordinary(text)
        assert found[doc_id]["ids"] == ids
        assert data[doc_id] == text.encode()
        own = digest[doc_id]
        assert own["n_tokens"] == len(ids)
        assert own["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert own["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        for i, start in enumerate(found[doc_id]["starts"][:50]):  # a token is a slice of the text
            assert text.encode()[start:].startswith(library.decode_single_token_bytes(ids[i]))


def test_digest_in_parts(monkeypatch):
    whole = bytebpe._ids_digest(np.arange(1000))
    monkeypatch.setattr(bytebpe, "IDS_AT_ONCE", 7)
    assert bytebpe._ids_digest(np.arange(1000)) == whole


def test_empty_and_repeated(no_docs, repeated, rows):
    assert bytebpe.digests(bytebpe.encode(no_docs, PATH), PATH).count() == 0
    assert bytebpe.digests(bytebpe.encode(repeated, PATH), PATH).count() == 2 * len(rows)
