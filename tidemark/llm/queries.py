"""The operators' queries over whole tables, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    decontamination,
    embeddings,
    language,
    licenses,
    near_duplicates,
    packing,
    periodic,
    quality,
    repeats,
    resampling,
    scoring,
    sharding,
    twins,
)
from tidemark.llm.common import WORD, table

SHARDS = 16


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_and_decode(docs, ranks, public_tokenizers.PATTERN, with_ids=False)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"), [1.0] * SHARDS)
    return placed.withColumn("law", F.lit("key"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.TextModel.fit(docs)
    found = ("language", "confidence", "known")
    of_docs = language.of_documents(docs, model).select("doc_id", F.lit(None).cast("long").alias("page_id"), *found)
    of_pages = language.of_pages(table(spark, sf_dir, "pages"), model).select(
        F.lit(None).cast("long").alias("doc_id"), "page_id", *found
    )
    return of_docs.unionByName(of_pages).withColumnRenamed("known", "kept")


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.deduplicate(table(spark, sf_dir, "embeddings"), least=0.95)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.deduplicate(table(spark, sf_dir, "documents"), percent=85)


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.measure(table(spark, sf_dir, "documents"))


def op10_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """In each tenth document (by the hash of its id) the words from one on become repetitions of those behind it."""
    h, words = F.crc32(F.col("doc_id").cast("string").cast("binary")), F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    cut = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    cut = cut.withColumns({"n": F.size("words"), "g": F.expr("h div 10")}).withColumn("a", F.expr("IF(n > 0, g % n, 0)"))
    cut = cut.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    planted = "array_join(transform(words, (w, i) -> IF(i < a, w, words[int(a + (i - a) % p)])), ' ')"
    return cut.select("doc_id", F.expr(f"IF(n > 0, {planted}, text)").alias("text"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_planted_runs(table(spark, sf_dir, "documents"))
    return periodic.collapse(docs, with_text=False).drop("runs", "n_words")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_bpe": op2_bpe,
    "op3_sharding": op3_sharding,
    "op4_language": op4_language,
    "op5_embeddings": op5_embeddings,
    "op6_quality": op6_quality,
    "op7_licenses": op7_licenses,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_repeats": op9_repeats,
    "op10_scoring": op10_scoring,
    "op11_decontamination": op11_decontamination,
    "op12_resampling": op12_resampling,
    "op13_periodic": op13_periodic,
}

ORACLE: dict[str, str] = {
    "op6_quality": quality.ORACLE_SQL,
    "op11_decontamination": twins.DECONTAMINATION,
    "op12_resampling": twins.RESAMPLING,
    "op13_periodic": twins.PERIODIC,
}
