import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from colfit.llm import prefixcounts
from colfit.llm.plans import COUNTING_TOKENIZER


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(COUNTING_TOKENIZER)


@pytest.fixture(scope="module")
def counter():
    return prefixcounts.PrefixCounter(COUNTING_TOKENIZER)


def every_prefix(tokenizer, counter, text):
    counts = np.cumsum(np.frombuffer(counter.changes(text), np.int8), dtype=np.int64).tolist()
    encoded = [len(tokenizer.encode(text[:i], add_special_tokens=False).ids) for i in range(1, len(text) + 1)]
    assert counts == encoded, text


def test_every_prefix(tokenizer, counter):
    for text in (
        "hello world's  we'll you've  \n\n  they're   x",
        "a<|endoftext|>b  <|endoftext|>  <|endo",
        "",
        "   ",
        "a   b\t\tc   é中文 123٣ ²½ ǅ",
        "!!'s 're 'r'll'l 'LL",
        "x  <|endoftext|> \n y",
        "a\x1cb \x85 c",
    ):
        every_prefix(tokenizer, counter, text)


def test_random_texts(tokenizer, counter):
    chosen = random.Random(1)
    parts = [*"ab'sreltv LL  \n\t12!?é中\U0001f642 '<|>", "<|endoftext|>", "'re", "'ll", "  ", "the ", "ing"]
    for _ in range(200):
        every_prefix(tokenizer, counter, "".join(chosen.choice(parts) for _ in range(chosen.randrange(1, 25))))


def test_order_of_merges_decides_what_may_follow(counter):
    chosen = random.Random(2)
    tokens = sorted(t for t in counter.tokens if len(t) < 5)
    for _ in range(3000):
        a, b = chosen.choice(tokens), chosen.choice(tokens)
        assert counter._may_follow(a, b) == (counter._merged(a + b) == [a, b])


def test_truncation_and_budget(tokenizer, counter):
    text = "The quick brown fox, jumping over 12 lazy dogs. " * 5
    changes = counter.changes(text)
    for budget in (0, 1, 7, 40, 1000):
        end = prefixcounts.longest_within(changes, budget)
        assert prefixcounts.count_at(changes, end) <= budget
        assert len(tokenizer.encode(text[:end], add_special_tokens=False).ids) <= budget
        longer = [i for i in range(end + 1, len(text) + 1)]
        assert all(prefixcounts.count_at(changes, i) > budget for i in longer)


def test_documents(docs, rows, tokenizer):
    found = {r["doc_id"]: r for r in prefixcounts.prefix_counts(docs, COUNTING_TOKENIZER).collect()}
    assert len(found) == len(rows)
    for doc_id, text, *_ in rows:
        text = text or ""
        assert found[doc_id]["n_tokens"] == len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert found[doc_id]["n_bytes"] == len(text.encode())
        assert len(found[doc_id]["changes"]) == len(text)


def test_empty_and_repeated(no_docs, repeated, rows):
    assert prefixcounts.prefix_counts(no_docs, COUNTING_TOKENIZER).count() == 0
    assert prefixcounts.prefix_counts(repeated, COUNTING_TOKENIZER).count() == 2 * len(rows)
