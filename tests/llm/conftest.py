"""Small awkward tables that every operator must get through."""

from __future__ import annotations

import random

import pytest

#: Names that operators use inside; as columns of the input they must do no harm.
CLASHING = ["size", "key", "rank", "digest", "body", "salt", "best", "shard", "fp", "block", "item", "held_out", "doc"]

WORDS = {
    "en": "the of and to in that it was for on river boat morning water time people little house".split(),
    "de": "der die und das nicht von sie ist des sich mit dem dass wasser morgen haus fluss zeit".split(),
    "fr": "le la les des est que une dans pour qui sur pas eau matin maison temps bateau peu".split(),
}


def prose(seed: int, lang: str, n: int) -> str:
    chosen = random.Random(f"{seed}{lang}")
    return " ".join(chosen.choice(WORDS[lang]) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """doc_id, text, lang, source."""
    out = []
    for i in range(60):
        lang = ("en", "de", "fr")[i % 3]
        out.append((i, prose(i, lang, 20 + 7 * i), lang, f"src{i % 4}" if i % 7 else None))
    out += [(100 + i, out[5][1], "fr", "src0") for i in range(25)]  # a group of copies
    near = out[9][1].split()
    for i in range(6):  # near copies
        changed = near.copy()
        changed[3 + 11 * i] = "changed"
        out.append((200 + i, " ".join(changed), "en", "src1"))
    out += [
        (300, None, "en", "src1"),
        (301, "", None, "src2"),
        (302, " \t\n ", "de", None),
        (303, "12 34 !!", "fr", "src3"),
        (304, prose(1, "en", 30_000), "en", "src9"),
        (305, "Straße ÉTÉ \U0001f600 中文 é  <|endoftext|> x", "de", "src1"),
        (306, prose(6, "fr", 3000), "fr", "src2"),
        (307, prose(6, "fr", 3000).replace(" ", " changed ", 1), "fr", "src2"),
        (None, "an id that is not there, in the morning", "en", "src1"),
    ]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    extra = ", ".join(f"`{c}` string" for c in CLASHING)
    full = [(*r, *("x" for _ in CLASHING)) for r in rows]
    return spark.createDataFrame(full, f"doc_id bigint, text string, lang string, source string, {extra}").repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def repeated(docs):
    """Every row twice, ids included."""
    return docs.union(docs)
