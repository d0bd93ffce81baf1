"""``python -m folioforge.plans.cli PHASE INPUT OUTPUT``: phases from the command line."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from folioforge.operators import layout, tables
from folioforge.operators.glyphs import sidebar_document, sidebars
from folioforge.operators.lines import dictionary_lines
from folioforge.sources import files, pdf, sinks

from . import pipelines

PHASES = ("convert", "parse", "all", "sidebars", "layout", "classify", "verify-columns", "table-detection", "margin-detection")


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="folioforge")
    p.add_argument("phase", choices=PHASES)
    p.add_argument("input", help="a path or glob; page images for the layout phases")
    p.add_argument("output")
    p.add_argument("--regex", help="whole file names in the input folder")
    p.add_argument("--words", nargs="*", default=[], help="word lists")
    a = p.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    words = dictionary_lines(files.word_lists(spark, *a.words)) if a.words else None
    if a.phase in ("convert", "all"):
        out = pipelines.convert(spark, a.input, words, regex=a.regex)
        if a.phase == "convert":
            sinks.write_text_files(out.where("error is null"), a.output, "source", "markdown", "md")
            return int(not out.where("error is not null").isEmpty())
        sinks.write_text_files(pipelines.C.json_documents(pipelines.parse(out)), a.output, "source", "json", "json")
    elif a.phase == "parse":
        md = files.documents(files.files(spark, a.input, regex=a.regex)).select(F.col("name").alias("source"), F.col("text").alias("markdown"))
        sinks.write_text_files(pipelines.C.json_documents(pipelines.parse(md)), a.output, "source", "json", "json")
    elif a.phase == "sidebars":
        g = pdf.glyphs(files.files(spark, a.input, regex=a.regex).select(F.col("name").alias("doc"), "content"), "doc").where("error is null")
        found = sidebar_document(sidebars(g, ["doc", "page_no"]), "doc", "page_no")
        every = g.select("doc").distinct().join(found, "doc", "left").select("doc", F.coalesce("markdown", F.lit("No sidebars found.")).alias("markdown"))
        sinks.write_text_files(every, a.output, "doc", "markdown", "md")
    else:
        pages = files.images(spark, a.input)
        if a.phase == "table-detection":
            out = tables.page_tables(pages).select("path", F.inline("tables"))
        else:
            out = layout.page_layouts(pages).select("path", "layout")
            if a.phase == "classify":
                out = out.select("path", "layout.type", layout.zone_summary(F.col("layout.zones")).alias("zones"))
            elif a.phase == "verify-columns":
                out = out.select("path", "layout.type").where("type <> 'TWO_COLUMN'")
            elif a.phase == "layout":
                out = layout.sub_pages(out)
            else:
                m, w, h = F.col("layout.margins"), F.col("layout.width"), F.col("layout.height")
                full = (m["right"] - m["left"]) * (m["bottom"] - m["top"]) / (w * h) >= 0.98
                sides = {"top": m["top"], "bottom": h - 1 - m["bottom"], "left": m["left"], "right": w - 1 - m["right"]}
                rows = out.select(F.regexp_extract("path", "([^/]+)/[^/]+$", 1).alias("file"), F.col("layout.type").alias("type"), full.alias("full_bleed"), *((c / 150.0).alias(k) for k, c in sides.items()))
                out = layout.margin_report(rows, "file", "type")
        out.write.mode("overwrite").json(a.output)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
