"""Markdown documents to typed components and JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .extract import fields
from .rules import component_type
from .sections import front_matter, split_sections


def components(docs: DataFrame, *, source: str = "source", markdown: str = "markdown", fence_aware: bool = False) -> DataFrame:
    """A row for each section of ``docs``: the other columns, ``ruleset``, ``sec_no``, ``component_type``, ``section``, ``fields``, ``raw_text``.

    Narrow: no stage of it shuffles.
    """
    ruleset, body = front_matter(F.col(markdown))
    parts = split_sections(docs.withColumns({"ruleset": ruleset, markdown: body}), markdown, fence_aware=fence_aware)
    typed = parts.withColumn("component_type", component_type(F.col("heading"), F.col("body")))
    rest = [c for c in typed.columns if c not in ("heading", "level", "body", "component_type")]
    return typed.select(*rest, "component_type", F.col("heading").alias("section"), fields(F.col("component_type"), F.col("body")).alias("fields"), F.col("body").alias("raw_text"))


def json_documents(parts: DataFrame, *, source: str = "source", pretty: bool = True) -> DataFrame:
    """``source, json``: one document for each source, components in order, absent members left out."""
    one = F.struct(F.col("sec_no"), F.struct(F.col(source).alias("source"), "component_type", "section", "fields", "raw_text").alias("c"))
    docs = parts.groupBy(source).agg(F.first("ruleset").alias("ruleset"), F.transform(F.array_sort(F.collect_list(one)), lambda x: x["c"]).alias("components"))
    meta = F.struct(F.col(source).alias("source"), F.col("ruleset.id").alias("ruleset"), F.col("ruleset.name").alias("ruleset_name"), F.col("ruleset.publisher").alias("publisher"))
    return docs.select(source, F.to_json(F.struct(meta.alias("metadata"), "components"), {"pretty": str(pretty).lower()}).alias("json"))
