"""Promotion of plain text to Markdown, line by line inside one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioforge.functions.text import all_caps_heading, ends_sentence, is_structural, join_lines, lines, trim_controls, unlines, wrap

ROOM = r"^\d+[a-zA-Z]?\.\s+[A-Z][A-Z']+(?:\s+[A-Z][A-Z']+)*$"
EMBEDDED = r"(\d+[a-zA-Z]?\.\s+(?:[A-Z][A-Z']+(?:\s+|$))*[A-Z][A-Z']+)(?=\s|$)"


def bare(line: Column) -> Column:
    """The trimmed line without asterisks."""
    return trim_controls(F.regexp_replace(trim_controls(line), r"\*+", ""))


def split_embedded_headings(text: Column) -> Column:
    """The first numbered room heading inside a line gets a line of its own."""

    def one(line: Column) -> Column:
        b = bare(line)
        parts = F.array(*(trim_controls(F.regexp_extract(b, rf"(?s)^(.*?)({EMBEDDED})(.*)$", n)) for n in (1, 2, 4)))
        found = b.rlike(EMBEDDED) & ((parts[0] != "") | (parts[2] != ""))
        return F.when(found, F.array_join(F.filter(parts, lambda p: p != ""), "\n")).otherwise(line)

    return unlines(F.transform(lines(text), one))


def fence_state(rows: Column) -> Column:
    """For each line whether it is a fence or stands inside one."""
    marks = F.transform(rows, lambda x: F.when(trim_controls(x).startswith("```"), 1).otherwise(0))
    before = F.transform(marks, lambda m, i: F.aggregate(F.slice(marks, F.lit(1), i), F.lit(0), lambda a, v: a + v))
    return F.zip_with(marks, before, lambda m, b: (m == 1) | (b % 2 == 1))


def promote_headings(text: Column) -> Column:
    """Room numbers become level 3, lines in capitals level 2; fences, rules, quotes and blank lines pass."""
    rows = lines(split_embedded_headings(text))

    def one(line: Column, fenced: Column) -> Column:
        t, b = trim_controls(line), bare(line)
        passes = fenced | (t == "") | (t == "---") | t.startswith(">")
        return F.when(passes, line).when(b.rlike(ROOM), F.concat(F.lit("### "), b)).when(all_caps_heading(b), F.concat(F.lit("## "), b)).otherwise(line)

    return F.concat(unlines(F.zip_with(rows, fence_state(rows), one)), F.lit("\n"))


def collapse_blank_lines(text: Column) -> Column:
    """A single blank line inside a sentence goes; those at the ends, in runs, by structure or after a sentence stay."""
    rows = lines(text)
    t = F.transform(rows, trim_controls)
    none = F.array(F.lit(None).cast("string"))
    # neighbours stand beside each line, so that no element looks the whole array up again
    z = F.arrays_zip(rows.alias("x"), t.alias("t"), F.concat(none, t).alias("p"), F.concat(F.slice(t, F.lit(2), F.size(t)), none).alias("n"))

    def keep(r: Column) -> Column:
        p, n = r["p"], r["n"]
        stays = p.isNull() | n.isNull() | (p == "") | (n == "") | is_structural(p) | is_structural(n) | ends_sentence(p)
        return F.when((r["t"] != "") | stays, F.concat(r["x"], F.lit("\n")))

    kept = F.transform(F.filter(z, lambda r: r["x"].isNotNull()), keep)
    return F.array_join(F.filter(kept, lambda x: x.isNotNull()), "")


def paragraphs(text: Column) -> Column:
    """``ARRAY<STRUCT<plain, rows>>``: runs of plain lines (trimmed), and each blank or structural line by itself."""
    rows = lines(text)
    kind = "array<struct<plain:boolean,rows:array<string>>>"

    def step(acc: Column, line: Column) -> Column:
        t = trim_controls(line)
        plain = ~((t == "") | is_structural(t))
        last = F.get(acc, F.size(acc) - 1)
        grown = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(F.lit(True).alias("plain"), F.concat(last["rows"], F.array(t)).alias("rows"))))
        new = F.concat(acc, F.array(F.struct(plain.alias("plain"), F.array(F.when(plain, t).otherwise(line)).alias("rows"))))
        return F.when(plain & F.coalesce(last["plain"], F.lit(False)), grown).otherwise(new)

    return F.aggregate(rows, F.array().cast(kind), step)


def rewrap(text: Column, width: int = 120) -> Column:
    """Paragraphs joined and wrapped; a line feed follows each line."""
    return F.array_join(F.transform(paragraphs(text), lambda p: F.concat(F.when(p["plain"], wrap(join_lines(p["rows"]), width)).otherwise(p["rows"][0]), F.lit("\n"))), "")
