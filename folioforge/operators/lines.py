"""Line tables, islands and merged gaps; running lines of documents; words that no dictionary has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.functions.text import is_fragmented, lines, trim_controls


def to_lines(df: DataFrame, text: str = "text") -> DataFrame:
    """A row for each line: the other columns, ``line_no`` from 0 and ``line``."""
    rest = [c for c in df.columns if c not in (text, "line_no", "line")]
    return df.select(*rest, F.posexplode(lines(F.col(text))).alias("line_no", "line"))


def from_lines(df: DataFrame, keys: list[str], text: str = "text", sep: str = "\n") -> DataFrame:
    """The lines of each key joined in order; one document's lines are one group."""
    rows = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    return df.groupBy(*keys).agg(F.array_join(F.transform(rows, lambda x: x["line"]), sep).alias(text))


def running_lines(pages: DataFrame, doc: str, page: str, text: str = "text") -> DataFrame:
    """``doc, line, pages``: trimmed lines of more than three characters on a quarter of a document's pages, and on three.

    Documents of fewer than three pages have none.
    """
    # counted beside the lines, so that no count of lines stands for a count of pages
    many = pages.select(F.col(doc).alias("_doc"), F.col(page).alias("_page")).groupBy("_doc").agg(F.countDistinct("_page").alias("_all"))
    each = to_lines(pages.select(doc, page, text), text).select(doc, page, trim_controls(F.col("line")).alias("line")).where(F.length("line") > 3).distinct()
    seen = each.groupBy(doc, "line").agg(F.count(F.lit(1)).alias("pages"))
    return seen.join(many, F.col(doc) == F.col("_doc")).drop("_doc").where((F.col("_all") >= 3) & (F.col("pages") >= F.greatest(F.lit(3), F.floor(F.col("_all") / 4)))).drop("_all")


def strip_running(pages: DataFrame, doc: str, page: str, text: str = "text") -> DataFrame:
    """``doc, page, text`` without running lines; a page of a document that has any ends each line with a line feed."""
    running = running_lines(pages, doc, page, text).select(F.col(doc).alias("_doc"), "line").groupBy("_doc").agg(F.collect_set("line").alias("_running"))
    joined = pages.select(doc, page, text).join(running, F.col(doc) == F.col("_doc"), "left")
    kept = F.filter(lines(F.col(text)), lambda x: ~F.array_contains(F.col("_running"), trim_controls(x)))
    return joined.select(doc, page, F.when(F.col("_running").isNull(), F.col(text)).otherwise(F.array_join(F.transform(kept, lambda x: F.concat(x, F.lit("\n"))), "")).alias(text))


def dictionary(entries: DataFrame) -> DataFrame:
    """``word, rank`` from rows of ``word`` and ``rank``: lower case, the smallest rank of each word."""
    return entries.select(F.lower(trim_controls(F.col("word"))).alias("word"), F.col("rank").cast("int").alias("rank")).where("word <> ''").groupBy("word").agg(F.min("rank").alias("rank"))


def dictionary_lines(df: DataFrame, text: str = "text") -> DataFrame:
    """Entries of word lists: ``word<tab>rank``, or a word whose rank is its line's number; ``#`` starts a comment."""
    rows = to_lines(df, text).select("line_no", trim_controls(F.col("line")).alias("line")).where("line <> '' and not startswith(line, '#')")
    part = F.split("line", "\t")
    return dictionary(rows.select(part[0].alias("word"), F.when(F.size(part) > 1, F.try_to_number(trim_controls(F.get(part, F.lit(1))), F.lit("999999999")).cast("int")).otherwise(F.col("line_no") + 1).alias("rank")))


def unknown_words(docs: DataFrame, words: DataFrame, doc: str, text: str = "text") -> DataFrame:
    """``doc, word``: distinct words of four letters or more that are not in ``words``; fragmented lines are passed over."""
    each = to_lines(docs.select(doc, text), text).where(~is_fragmented(F.col("line")))
    tokens = each.select(doc, F.explode(F.split(F.replace(F.col("line"), F.lit("*"), F.lit(" ")), "[^a-zA-Z]+")).alias("word")).where(F.length("word") >= 4)
    return tokens.select(doc, F.lower("word").alias("word")).distinct().join(words.select(F.lower("word").alias("word")).distinct(), "word", "left_anti").select(doc, "word")


def islands(df: DataFrame, keys: list[str], pos: str, flag: Column) -> DataFrame:
    """``keys, start, end``: runs of consecutive positions where ``flag`` holds; ``end`` is exclusive."""
    w = Window.partitionBy(*keys).orderBy(pos)
    return df.where(flag).select(*keys, F.col(pos).alias("_p"), (F.col(pos) - F.row_number().over(w)).alias("_g")).groupBy(*keys, "_g").agg(F.min("_p").alias("start"), (F.max("_p") + 1).alias("end")).drop("_g")


def merge_gaps(df: DataFrame, keys: list[str], bridge: int) -> DataFrame:
    """Runs joined where the distance between them is at most ``bridge``; runs are apart and sorted by ``start``."""
    w = Window.partitionBy(*keys).orderBy("start")
    step = (F.col("start") - F.lag("end").over(w) > bridge).cast("int")
    return df.withColumn("_g", F.sum(F.coalesce(step, F.lit(0))).over(w)).groupBy(*keys, "_g").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_g")
