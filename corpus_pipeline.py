"""From raw documents to packed training sequences; each stage is written and read again before the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from listing_lake.llm import exact_dedup, language, mixing, near_dup, packing
from listing_lake.llm.tables import load, written

TOKENIZER = "word_bpe_49k.json"


def keep_languages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language is identified."""
    return language.keep_identified(docs, language.train(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of linked near-duplicates."""
    return near_dup.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents drawn to the target weights of their sources, repeats included."""
    return mixing.mix(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of the documents with their ids, their sequence and their place in it."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language", keep_languages),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mix", mix_sources),
    ("pack", pack_windows),
]

#: No SQL: the stages use learned, random and iterative methods.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, folder), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, folder)
