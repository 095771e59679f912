"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colfit.llm import (
    alignment,
    bytebpe,
    eftrie,
    exactdup,
    htmltree,
    langcodes,
    mixing,
    packing,
    prefixcounts,
    sharding,
    simhash,
    spelling,
    subspace,
)
from colfit.llm.common import table

#: Tokenizer files; they stand in the same place on every worker.
PACKING_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
COUNTING_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def hex64(number: Column) -> Column:
    return F.lower(F.lpad(F.hex(number), 16, "0"))


@query("op1_pareto_mixing", mixing.mixing_sql())
def pareto_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@query(
    "op3_exact_dedup",
    """SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
       FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
)
def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exactdup.mark_copies(table(spark, folder, "documents")).select(
        "doc_id",
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


@query("op5_anchor_simhash")
def anchor_simhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, folder, "documents"))
    return groups.select("doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id")


@query("op8_differencing_shards")
def differencing_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(table(spark, folder, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op2_trie_scores")
def trie_scores(spark: SparkSession, folder: str) -> DataFrame:
    return eftrie.learn_and_score(table(spark, folder, "documents"))


@query(
    "op4_subspace_vectors",
    f"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL),
    s AS (SELECT *, sqrt(list_dot_product(e, e)) AS norm FROM v),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM s a JOIN s b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= {subspace.COSINE}),
    counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a),
    reach AS (SELECT vec_id AS node, vec_id AS root FROM embeddings
        UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node),
    named AS (SELECT node AS vec_id, min(root) AS component_id FROM reach GROUP BY node)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM named LEFT JOIN counted USING (vec_id)""",
)
def subspace_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return subspace.near_vectors(table(spark, folder, "embeddings"))


@query("op6_language_codes")
def language_codes(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return langcodes.identify(docs).select("doc.doc_id", "held_out", "lang_pred", "score", "ambiguous")


@query("op7_lexical_packing")
def lexical_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), PACKING_TOKENIZER)


@query("op9_prefix_counts")
def prefix_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = prefixcounts.prefix_counts(table(spark, folder, "documents"), COUNTING_TOKENIZER)
    return counts.select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > prefixcounts.LIMIT).alias("over_limit")
    )


@query("op10_tree_pages")
def tree_pages(spark: SparkSession, folder: str) -> DataFrame:
    texts = htmltree.main_texts(table(spark, folder, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("bigint"))


@query("op13_scanned_byte_bpe")
def scanned_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encoded = bytebpe.encode(table(spark, folder, "documents"), BYTE_RANKS)
    return bytebpe.digests(encoded, BYTE_RANKS)


@query("op12_merge_path_alignment")
def merge_path_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_and_count(table(spark, folder, "documents"), COUNTING_TOKENIZER, PIECE_TOKENIZER)


@query("op11_bit_sliced_variants", spelling.variants_sql())
def bit_sliced_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))
