"""Queries that apply each operator to its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import dedup_sql, url_filter_sql
from .decontaminate import contaminated
from .embedding_dedup import near_vectors
from .html_extract import extract
from .maxent_lm import score_texts
from .near_dedup import near_duplicates
from .packing import pack
from .quality import judge
from .substring_dedup import repeated_passages
from .toxicity import toxicity
from .url_filter import filter_urls

URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> tuple[str, tuple[str, str]]:
    """The 50k byte-level vocabulary: its file, and its ranks with the splitting pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def recount(docs: DataFrame, before: DataFrame) -> DataFrame:
    """``docs`` with the number of code points in ``n_chars``, if the table has that column."""
    if "n_chars" not in before.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(before.schema["n_chars"].dataType)).select(*before.columns)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(spark, table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, ranks = tokenizer()
    return digest(pack(spark, table(spark, sf_dir, "documents"), path, ranks=ranks))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark, table(spark, sf_dir, "embeddings"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark, table(spark, sf_dir, "pages"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judge(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=["doc_id", "lang"])
    return out.select("doc_id", "lang", "perplexity", "threshold", "accepted")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(spark, table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES).drop("score")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("op") and callable(v)}


def oracle_sql() -> dict[str, str]:
    return {"op4_embedding_dedup": dedup_sql.NEAR_VECTORS, "op7_near_dedup": dedup_sql.NEAR_DOCUMENTS, "op9_url_filter": url_filter_sql.oracle(URL_RULES)}
