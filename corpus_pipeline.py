"""From raw documents to packed training sequences, one operator a stage."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from colfit.llm import exactdup, langcodes, mixing, packing, simhash
from colfit.llm.plans import PACKING_TOKENIZER
from colfit.session import remove_folder, shared_folder


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents go whose language cannot be told: no letters, or an ambiguous code."""
    found = langcodes.identify(docs)
    return found.where((found.lang_pred != langcodes.UNKNOWN) & ~found.ambiguous).select("doc.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each text stays, that with the largest id."""
    return exactdup.deduplicate(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of documents that fingerprints of four-word shingles link at four bits or fewer, one stays."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents stand as often as the mix takes them."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of documents, by sequence and offset."""
    return packing.pack(docs, PACKING_TOKENIZER)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("identify_language", identify_language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Language codes, SimHash and packing cannot be expressed in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the documents of a folder.

    What a stage keeps is written once to the shared folder and read by the next, and
    deleted when that has written its own.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove_folder(spark, before)
        before = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
