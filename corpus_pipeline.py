"""Corpus pipeline: from raw documents to packed training sequences, in five stages.

Each stage works on all that the one before kept and its result is written and read again,
so a lost executor costs tasks of one stage. All stages but the last return documents with
the columns they came with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import language, mixing, neardup, packing, repeats
from orderloom.llm.common import staged, table


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents of some language; null texts and texts without letters go."""
    return language.drop_unknown(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles are alike by 0.8 or more."""
    return neardup.drop_near_copies(spark, docs, width=5, percent=80)


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without the strings of 200 bytes that start more than once in the corpus."""
    return repeats.drop_repeats(spark, docs)


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target weights."""
    return mixing.mix_sources(spark, docs)


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 tokens."""
    return packing.pack_documents(spark, docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_copies),
    ("repeats", drop_repeated_strings),
    ("mixing", mix),
    ("packing", pack),
]

#: SQL expresses neither the minwise trees nor the tokenizer; tests hold brute force against the stages.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = table(spark, folder, "documents")
    for _, stage in STAGES:
        docs = staged(spark, stage(spark, docs, folder))
    return docs
