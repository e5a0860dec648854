"""One query per operator of this package, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetwatch.llm import (
    extraction,
    jaccard,
    leaks,
    lexical,
    neighbours,
    packing,
    passages,
    pii,
    planes,
    quality,
    resampling,
    shards,
    urls,
)
from fleetwatch.llm.support import table
from fleetwatch.llm.tokens import encoder
from fleetwatch.session import scratch_path

N_SHARDS = 24
SEQUENCE = 2048
URL_RULES = [
    urls.Rule(urls.ALLOW, "com"),
    urls.Rule(urls.BLOCK, "example.com", "/en/"),
    urls.Rule(urls.ALLOW, "www.example.com", "/en/"),
    urls.Rule(urls.BLOCK, "net", "/es/"),
    urls.Rule(urls.BLOCK, "net", "/fr/"),
]


def encode_with(name: str):
    path = public_tokenizers.path(name)
    return lambda: encoder(path).encode


def op1_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chunks = planes.write_tokens(docs, scratch_path(spark, "planes"), encode_with("word_bpe_49k.json"), end_id=1)
    return planes.token_digests(chunks).withColumnRenamed("key", "doc_id")


def op2_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extraction.extract(pages, extraction.fit(pages)).withColumnRenamed("key", "page_id")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.shard_documents(table(spark, sf_dir, "documents"), N_SHARDS)
    return placed.select(
        F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    cut = packing.cut_documents(docs, encode_with("byte_bpe_50k.json"), end_id=0, capacity=SEQUENCE)
    return packing.pack(cut, SEQUENCE).withColumnRenamed("key", "doc_id")


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.similar_documents(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), "n_shingles", "component_id")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model).withColumnRenamed("key", "doc_id")


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest_neighbours(vectors, F.col("vec_id") % 20 == 0, k=20)


def op9_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = leaks.leak_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return report.withColumnRenamed("key", "doc_id")


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_recurring(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("key", "doc_id")


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").cast("long").alias("item_id"), "rank", F.col("key").alias("doc_id"), "score")


def op13_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), URL_RULES).withColumnRenamed("key", "page_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_planes, op2_extraction, op3_pii, op4_shards, op5_packing, op6_jaccard, op7_quality, op8_neighbours, op9_leaks, op10_passages, op11_resampling, op12_lexical, op13_urls)}
