"""The corpus pipeline: quality, near-duplicates, repeated passages, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents. Rows with a null doc_id are never copies of others and lose no passages; null and empty texts pass to the
last stage, which packs them as one token; rows that repeat a doc_id are judged alike and stay together; columns
beside doc_id, lang and text are carried along (n_chars follows the text); empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioforge.llm import queries
from folioforge.llm.decontaminate import decontaminate
from folioforge.llm.near_dedup import one_of_each
from folioforge.llm.packing import pack
from folioforge.llm.quality import judge
from folioforge.llm.store import Scratch
from folioforge.llm.substring_dedup import without_passages


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language models of trusted text accept."""
    return judge(spark, docs, queries.table(spark, sf_dir, "labels")).where("accepted").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_of_each(spark, docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; ``n_chars`` follows the text."""
    return queries.recount(without_passages(spark, docs), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate(spark, docs, queries.table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 1024 tokens."""
    path, ranks = queries.tokenizer()
    return queries.digest(pack(spark, docs, path, ranks=ranks))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("decontamination", decontamination), ("packing", packing)]

#: SQL has no sketches, language models or tokenizers; each stage's operator is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written and read again."""
    docs, kept = queries.table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        before, docs = docs, kept.save(stage(spark, docs, sf_dir))
        kept.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
