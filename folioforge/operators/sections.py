"""Markdown to sections and front matter, without a shuffle: a document is one row until it is exploded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioforge.functions.text import LINE_CHAR, trim_controls, yaml_escape

HEADING_LINE = rf"#{{1,3}}[^\S\n]+{LINE_CHAR}+(?:\n|$)"
FENCE = r"(?s)```stat\n(.*?)\n```"
FRONT = r"(?s)^---\s*\n(.*?)\n---\s*\n"
FRONT_KEYS = {"ruleset": "unknown", "ruleset_name": "Unknown", "publisher": "Unknown"}


def sections(markdown: Column, *, fence_aware: bool = False) -> Column:
    """``ARRAY<STRUCT<heading, level, body>>``: cut before each heading of level 1 to 3, flat.

    What stands before the first heading is the section ``Preamble`` of level 0, if it is not blank. With
    ``fence_aware``, ``# `` labels inside stat fences do not start sections.
    """
    text = F.coalesce(markdown, F.lit(""))
    if fence_aware:
        text = F.array_join(F.transform(F.split(text, "(?=```)"), lambda p: F.when(p.startswith("```stat"), F.regexp_replace(p, r"\n#", "\n\u0001#")).otherwise(p)), "")
    parts = F.split(F.concat(F.lit("\n"), text), rf"\n(?={HEADING_LINE})", -1)
    clean = (lambda c: F.replace(c, F.lit("\u0001"))) if fence_aware else (lambda c: c)
    first = trim_controls(parts[0])
    preamble = F.when(first == "", F.array()).otherwise(F.array(F.struct(F.lit("Preamble").alias("heading"), F.lit(0).alias("level"), clean(first).alias("body"))))
    rest = F.transform(
        F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))),
        lambda p: F.struct(
            trim_controls(F.regexp_extract(p, rf"^#{{1,3}}\s+({LINE_CHAR}+)", 1)).alias("heading"),
            F.length(F.regexp_extract(p, r"^(#{1,3})\s", 1)).alias("level"),
            clean(trim_controls(F.regexp_extract(p, r"(?s)^[^\n]*\n?(.*)$", 1))).alias("body"),
        ),
    )
    return F.concat(preamble.cast("array<struct<heading:string,level:int,body:string>>"), rest)


def split_sections(df: DataFrame, markdown: str = "markdown", **options) -> DataFrame:
    """A row for each section: the other columns, ``sec_no`` from 0, ``heading``, ``level``, ``body``."""
    rest = [c for c in df.columns if c not in (markdown, "sec_no", "heading", "level", "body")]
    return df.select(*rest, F.posexplode(sections(F.col(markdown), **options)).alias("sec_no", "_s")).select(*rest, "sec_no", "_s.heading", "_s.level", "_s.body")


def front_matter(markdown: Column) -> tuple[Column, Column]:
    """``STRUCT<id, name, publisher>`` of the leading block, with defaults, and the text after it."""
    block = F.regexp_extract(markdown, FRONT, 1)

    def value(key: str, default: str) -> Column:
        all_ = F.regexp_extract_all(block, F.lit(rf"(?m)^{key}:\s*(.+)$"), F.lit(1))
        last = F.regexp_replace(trim_controls(F.get(all_, F.size(all_) - 1)), '^"|"$', "")
        return F.coalesce(last, F.lit(default))

    ruleset = F.struct(*(value(k, d).alias(n) for (k, d), n in zip(FRONT_KEYS.items(), ("id", "name", "publisher"))))
    return ruleset, F.regexp_replace(markdown, FRONT.replace("^", r"\A", 1), "")


def with_front_matter(source: Column, ruleset: Column, markdown: Column) -> Column:
    """The document with a YAML block of its source, ruleset, ruleset's name and publisher."""
    rows = (("source", source), ("ruleset", ruleset["id"]), ("ruleset_name", ruleset["name"]), ("publisher", ruleset["publisher"]))
    head = F.concat_ws("\n", F.lit("---"), *(F.concat(F.lit(f"{k}: "), yaml_escape(c)) for k, c in rows), F.lit("---"))
    return F.concat(head, F.lit("\n\n"), markdown)


def stat_fences(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(FENCE), F.lit(1)), trim_controls)


def without_fences(text: Column) -> Column:
    outside = F.regexp_replace(F.regexp_replace(text, FENCE, ""), r"\n{3,}", "\n\n")
    return trim_controls(F.when(text.contains("```stat\n") | text.contains("\n\n\n"), outside).otherwise(text))

