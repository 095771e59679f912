import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from colfit.llm import exactdup


def groups(rows):
    out = defaultdict(list)
    for r in rows:
        out[r[1] or ""].append(r[0])
    return out


def check(found, rows, digest=True):
    by_text = groups(rows)
    text = defaultdict(list)
    for r in rows:
        text[r[0]].append(r[1] or "")
    assert len(found) == len(rows)
    for r in found:
        body = text[r["doc_id"]][0]
        ids = [i for i in by_text[body] if i is not None]
        assert r["group_size"] == len(by_text[body])
        assert r["keep_id"] == max(ids, default=None)
        if digest:
            assert bytes(r["digest"]) == hashlib.sha256(body.encode()).digest()
    assert sum(r["kept"] for r in found) == len(by_text)


def test_marks(docs, rows):
    check(exactdup.mark_copies(docs).collect(), rows)


def test_texts_that_share_a_digest_stay_apart(docs, rows):
    check(exactdup.mark_copies(docs, lambda text: F.substring(F.sha2(text, 256), 1, 1)).collect(), rows, digest=False)


def test_whole_rows_stay(docs, rows):
    out = exactdup.deduplicate(docs)
    assert out.columns == docs.columns
    kept = {(r["doc_id"], r["text"]) for r in out.collect()}
    assert len(kept) == len(groups(rows)) == out.count()
    assert (124, rows[5][1]) in kept  # the largest id of the copies


def test_repeated_rows(repeated, rows):
    assert sum(r["kept"] for r in exactdup.mark_copies(repeated).collect()) == len(groups(rows))
    assert exactdup.deduplicate(repeated).count() == len(groups(rows))


def test_empty(no_docs):
    assert exactdup.mark_copies(no_docs).count() == 0
    assert exactdup.deduplicate(no_docs).count() == 0
