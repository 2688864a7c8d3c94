"""From raw documents to packed training sequences: five operators of ``tidemark.llm`` in a row."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import language, near_duplicates, packing, quality, repeats
from tidemark.llm.common import saved, table

# Training a model, permutations and suffix order are not SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents in no known language go."""
    return language.keep_known(docs)


def check_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that fail a base rule or a rule of the cascade go."""
    return quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: of documents linked at a similarity of 0.8 or more, the one with the smallest id stays."""
    return near_duplicates.keep_one(docs, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: passages that an earlier document has are cut out of the texts."""
    return repeats.remove_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: power-of-two sequences of what is left."""
    # Executors that have run four stages have less memory left, so tasks remember less.
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), cached_chunks=400_000)


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", check_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", cut_repeats),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
