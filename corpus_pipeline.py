"""The corpus pipeline: language ID, near-dedup, repeated passages, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its output is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quire.llm import language, mixing, packing, simhash, suffix
from quire.llm.common import forget, stored
from quire.sources.readers import spread, tables


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned, with lang as predicted; texts that are null or without a letter go."""
    return language.relabelled(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    return simhash.one_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that an earlier 100-byte string covers."""
    return suffix.deduped(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents up to each source's budget, in one epoch."""
    return mixing.choose(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixing", mixing_stage),
    ("packing", pack),
]

#: Trained machines, fingerprints, anchors and a tokenizer: SQL can't express the stages. Tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's output is stored and read again by the next."""
    docs = spread(tables(spark, sf_dir, "documents"))
    last = None
    for name, stage in STAGES[:-1]:
        after = stored(stage(spark, docs, sf_dir))
        if last is not None:
            forget(last)
        docs = last = after
    return STAGES[-1][1](spark, docs, sf_dir)
