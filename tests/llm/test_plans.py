"""The registered queries over the smallest tables, and the pipeline."""

import os

import duckdb
import pytest

import corpus_pipeline
from colfit.llm import langcodes
from colfit.llm.plans import ORACLES, QUERIES
from test_simhash import plain_fingerprint, plain_groups

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df = QUERIES[name](spark, FOLDER)
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    mine = sorted((tuple(r[c] for c in sorted(names)) for r in df.collect()), key=repr)
    order = [names.index(c) for c in sorted(names)]
    assert mine == sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_returns_a_row_per_row(spark, name):
    table = {"op4": "embeddings", "op10": "pages"}.get(name.split("_")[0], "documents")
    key = {"embeddings": "vec_id", "pages": "page_id"}.get(table, "doc_id")
    found = {r[key] for r in QUERIES[name](spark, FOLDER).select(key).collect()}
    assert found == {r[key] for r in spark.read.parquet(f"{FOLDER}/{table}.parquet").select(key).collect()}


def test_one_query_for_each_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))


def test_pipeline(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "identify_language",
        "exact_dedup",
        "near_dedup",
        "mix_sources",
        "pack_sequences",
    ]
    kept, text = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        before = kept.collect()
        kept = stage(spark, kept, FOLDER)
        after = kept.collect()
        if name != "pack_sequences":
            assert kept.columns == docs.columns
        if name == "identify_language":
            letters = [r for r in before if any(c.isalpha() for c in r["text"] or "")]
            known = {r["doc"]["doc_id"] for r in langcodes.identify(docs).where("NOT ambiguous").collect()}
            assert {r["doc_id"] for r in after} == {r["doc_id"] for r in letters if r["doc_id"] in known}
        if name == "exact_dedup":
            assert len(after) == len({r["text"] for r in before})
        if name == "near_dedup":
            text = {r["doc_id"]: r["text"] for r in after}
            groups = plain_groups([(r["doc_id"], plain_fingerprint(r["text"])) for r in before if r["doc_id"] is not None])
            assert len(after) == len(text) < len(before)
            assert set(text) == set(groups.values()) | {r["doc_id"] for r in before if r["doc_id"] is None}
        if name == "mix_sources":
            assert {r["doc_id"] for r in after} <= set(text)
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}


def test_run(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
