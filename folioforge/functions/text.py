"""Text expressions: ``Column -> Column``, all of them JVM-side, and texts of Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_START_OR_END = r"(?:(?<![A-Za-z0-9_])(?=[A-Za-z0-9_])|(?<=[A-Za-z0-9_])(?![A-Za-z0-9_]))"
LINE_CHAR = "[^\\n\\r\\u0085\\u2028\\u2029]"
CONTROLS = "".join(map(chr, range(0x21)))

# What Windows-1252 has at the code points 0x80 to 0x9F; the five unassigned ones stay as they are.
WIN1252_CODES = [0x80, *range(0x82, 0x8D), 0x8E, *range(0x91, 0x9D), 0x9E, 0x9F]
WIN1252_CHARS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"


def ascii_words(pattern: str) -> str:
    """The pattern with ``\\b`` as a bound of ASCII words, also beside accented letters.

    Before a word or a choice of words it looks back only, after a choice of words ahead only.
    """
    word = r"[A-Za-z0-9_]+(?: [A-Za-z0-9_]+)*"
    choice = rf"\((?:\?:)?{word}(?:\|{word})*\)"
    pattern = re.sub(rf"\\b(?=[A-Za-z0-9_](?![?*{{])|{choice}(?![?*{{]))", "(?<![A-Za-z0-9_])", pattern)
    pattern = re.sub(rf"({choice})\\b", r"\1(?![A-Za-z0-9_])", pattern)
    return pattern.replace(r"\b", WORD_START_OR_END)


def matches(c: Column, pattern: str) -> Column:
    return c.rlike(ascii_words(pattern))


def by_few(f: Callable[[str], str], texts: pa.Array, rows: int = 256) -> pa.Array:
    """``f`` of each text that is not null; no more than ``rows`` are Python objects at once."""
    parts = (texts.slice(s, rows).to_pylist() for s in range(0, len(texts), rows))
    return pa.concat_arrays([pa.array([], pa.string()), *(pa.array([None if t is None else f(t) for t in part], pa.string()) for part in parts)])


def once(c: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` names it: in branches Spark computes it each time."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def unless_empty(c: Column) -> Column:
    """Null for the empty text."""
    return F.get(F.filter(F.array(c), lambda x: x != ""), F.lit(0))


def group(c: Column, pattern: str, n: int = 1) -> Column:
    """A group of the first match; null if there is none or it is empty."""
    return unless_empty(F.regexp_extract(c, ascii_words(pattern), n))


def trim_controls(c: Column) -> Column:
    """Without the characters up to U+0020 at both ends."""
    return F.btrim(c, F.lit(CONTROLS))


def lines(c: Column) -> Column:
    return F.split(c, "\n", -1)


def unlines(c: Column) -> Column:
    return F.array_join(c, "\n")


def is_structural(trimmed: Column) -> Column:
    return trimmed.startswith("#") | trimmed.startswith(">") | trimmed.startswith("```") | (trimmed == "---")


def ends_sentence(c: Column) -> Column:
    return c.rlike(r"[.!?]$")


def entirely_italic(c: Column) -> Column:
    return ((c.startswith("*") & c.endswith("*")) | (c.startswith("_") & c.endswith("_"))) & (F.length(c) > 2)


def all_caps_heading(c: Column) -> Column:
    """Equal to its own upper case, with three tokens or more; digits and marks count as upper case."""
    return (c == F.upper(c)) & (F.size(F.split(trim_controls(c), r"\s+")) >= 3)


def tighten_apostrophes(c: Column) -> Column:
    """Detached ``' s`` and ``' t``, spaced apostrophes and hyphens between letters are closed up, in this order."""
    for pattern, new in ((r" ' s\b", "'s"), (r" ' t\b", "'t"), (r"([A-Za-z0-9_]) ' ([A-Za-z0-9_])", "$1'$2"), (r"([a-zA-Z]) - ([a-zA-Z])", "$1-$2")):
        c = F.regexp_replace(c, ascii_words(pattern), new)
    return c


def join_scattered_digits(c: Column) -> Column:
    """``1 2 3`` becomes ``123`` where each digit stands alone."""
    return F.regexp_replace(c, r"(?<=(?<!\d)\d) (?=\d(?!\d))", "")


def fix_win1252(c: Column) -> Column:
    return F.translate(c, "".join(map(chr, WIN1252_CODES)), WIN1252_CHARS)


def post_process(c: Column) -> Column:
    """Repaired code page, rejoined hyphenation, no page-number lines, two line feeds at most."""
    c = fix_win1252(c)
    c = F.regexp_replace(c, r"([A-Za-z0-9_]+)-\n([A-Za-z0-9_]+)", "$1$2")
    c = F.regexp_replace(c, r"(?m)^\s*\d+\s*$", "")
    return collapse_repeats(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def collapse_repeats(c: Column) -> Column:
    """Only the first of consecutive equal lines (trimmed), blank lines apart.

    Each line meets the trimmed one before it in one pass over both arrays, which are made once a text.
    """

    def kept(rows: Column) -> Column:
        before = F.concat(F.array(F.lit("")), F.transform(F.slice(rows, F.lit(1), F.size(rows) - 1), trim_controls))
        return F.zip_with(rows, before, lambda x, b: once(trim_controls(x), lambda t: F.when((t == "") | (t != b), x)))

    return unlines(F.filter(once(lines(c), kept), lambda x: x.isNotNull()))


def tokens(c: Column) -> Column:
    return F.split(trim_controls(c), r"\s+")


def is_fragmented(c: Column) -> Column:
    """Five tokens with letters or more, at least 60 % of them of three letters at most, mean below 3.5."""
    t = trim_controls(c)
    sizes = F.filter(F.transform(tokens(c), lambda w: F.length(F.regexp_replace(w, "[^a-zA-Z]", ""))), lambda n: n > 0)
    many = F.size(sizes)
    short = F.size(F.filter(sizes, lambda n: n <= 3))
    total = F.aggregate(sizes, F.lit(0), lambda a, n: a + n)
    return (t != "") & ~is_structural(t) & (F.size(tokens(c)) >= 5) & (many >= 5) & (short / many >= 0.6) & (total / many < 3.5)


def wrap(c: Column, width: int) -> Column:
    """Greedy word wrap; a word longer than the width stands alone."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("line"))

    def step(acc: Column, w: Column) -> Column:
        fits = F.length(acc["line"]) + 1 + F.length(w) <= width
        return F.when(acc["line"].isNull() | (acc["line"] == ""), F.struct(acc["done"].alias("done"), w.alias("line"))).when(
            fits, F.struct(acc["done"].alias("done"), F.concat(acc["line"], F.lit(" "), w).alias("line"))
        ).otherwise(F.struct(F.concat(acc["done"], F.array(acc["line"])).alias("done"), w.alias("line")))

    return F.aggregate(F.split(c, " "), start, step, lambda acc: F.array_join(F.concat(acc["done"], F.array(F.coalesce(acc["line"], F.lit("")))), "\n"))


def join_lines(rows: Column) -> Column:
    """Lines joined by a space; a hyphen after a letter at a line's end goes with the line break."""
    return F.aggregate(
        rows,
        F.lit(None).cast("string"),
        lambda acc, x: F.when(acc.isNull(), x).when(acc.rlike(r"\p{L}-$"), F.concat(acc.substr(F.lit(1), F.length(acc) - 1), x)).otherwise(F.concat(acc, F.lit(" "), x)),
    )


def split_sentences(c: Column) -> Column:
    return F.split(c, r"(?<=[.!?])(?=\p{Lu})")


def strip_extension(c: Column) -> Column:
    return F.regexp_replace(c, r"(?<=.)\.[^.]*$", "")


def yaml_escape(c: Column) -> Column:
    quoted = F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    return F.when(c.isNull(), F.lit('""')).when(c.rlike("[:#\"'&]"), quoted).otherwise(c)
