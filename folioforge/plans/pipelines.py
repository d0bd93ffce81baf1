"""The phases that turn files into Markdown and Markdown into components."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.operators import components as C
from folioforge.operators import glyphs as G
from folioforge.operators.clean import cleaner_column
from folioforge.operators.fencing import with_fences
from folioforge.operators.layout import sub_pages
from folioforge.operators.lines import strip_running
from folioforge.operators.markdown import promote_headings
from folioforge.operators.rules import ruleset
from folioforge.operators.sections import with_front_matter
from folioforge.sources import files, pdf

PAGE_BREAK = "\n\n---\n\n"


def unknown_ruleset() -> Column:
    return F.struct(F.lit("unknown").alias("id"), F.lit("Unknown").alias("name"), F.lit("Unknown").alias("publisher"))


def join_pages(pages: DataFrame, doc: str = "doc", page: str = "page_no", text: str = "text") -> DataFrame:
    """``doc, text, front``: pages in order with rules between them, and the text of the first four."""
    rows = F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.col(text).alias("t"))))
    whole = F.transform(F.col("_r"), lambda x: x["t"])
    return pages.groupBy(doc).agg(rows.alias("_r")).select(doc, F.array_join(whole, PAGE_BREAK).alias("text"), F.array_join(F.slice(whole, 1, 4), "\n").alias("front"))


def pages_to_markdown(pages: DataFrame, words: DataFrame | None = None, *, doc: str = "doc", page: str = "page_no", compat: bool = False) -> DataFrame:
    """``doc, markdown`` with front matter, from pages of text.

    Running lines go, stat blocks are fenced, text outside them is repaired by ``words`` (word, rank), headings
    are promoted. ``compat`` repairs before it fences, which wraps the lines that fences are found by.
    """
    spark = pages.sparkSession
    joined = join_pages(strip_running(pages, doc, page), doc, page)
    clean: Callable[[Column], Column] = cleaner_column(spark, words, around_fences=not compat) if words is not None else lambda c: c
    text = with_fences(clean(F.col("text"))) if compat else clean(with_fences(F.col("text")))
    repaired = joined.select(doc, "front", text.alias("text"))  # Python functions cannot stand inside array expressions
    return repaired.select(doc, with_front_matter(F.col(doc).cast("string"), ruleset(F.col("front")), promote_headings(F.col("text"))).alias("markdown"))


def pages_by_layout(letters: DataFrame, layouts: DataFrame, *, doc: str = "doc", page: str = "page_no", dpi: float = 150.0) -> DataFrame:
    """``doc, page_no, seq, text``: the text of each sub-page in reading order, from letters in points and layouts in pixels; pictures have none."""
    cells = sub_pages(layouts.select(doc, page, "layout")).where(F.col("zone_type") != "IMAGE")
    boxes = cells.select(doc, page, F.col("seq").alias("seq_box"), *((F.col(c) * (72.0 / dpi)).alias(c) for c in ("x0", "y0", "x1", "y1")))
    return G.crop_text(letters, boxes, [doc, page]).withColumnRenamed("seq_box", "seq")


def convert(spark: SparkSession, path: str, words: DataFrame | None = None, *, regex: str | None = None) -> DataFrame:
    """``source, markdown, error`` of the files at a path; Markdown passes, text and Word files get front matter, PDF pages are read and repaired."""
    found = files.files(spark, path, regex=regex)
    docs = files.documents(found)
    plain = docs.select(F.col("name").alias("source"), F.when(F.col("format") == "md", F.col("text")).otherwise(with_front_matter(F.col("name"), unknown_ruleset(), F.col("text"))).alias("markdown"), "error")
    letters = pdf.glyphs(found.where("format = 'pdf'").select(F.col("name").alias("doc"), "content"), "doc")
    pages = G.pages_text(letters.where("error is null"), ["doc", "page_no"])
    read = pages_to_markdown(pages, words).select(F.col("doc").alias("source"), "markdown", F.lit(None).cast("string").alias("error"))
    failed = letters.where("error is not null").select(F.col("doc").alias("source"), F.lit(None).cast("string").alias("markdown"), "error")
    return plain.unionByName(read).unionByName(failed)


def parse(markdown: DataFrame) -> DataFrame:
    """Components of ``source, markdown`` rows."""
    return C.components(markdown.where("markdown is not null").select("source", "markdown"))


def run_all(spark: SparkSession, path: str, words: DataFrame | None = None, *, regex: str | None = None) -> DataFrame:
    """``source, json``: files to JSON documents."""
    return C.json_documents(parse(convert(spark, path, words, regex=regex)))
