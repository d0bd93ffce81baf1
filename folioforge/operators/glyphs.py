"""Text from placed characters: styles, columns, reading order and boxes."""

from __future__ import annotations

import re
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .geometry import within
from .layout import find_gaps, islands

#: Widest drift between letters of a line and the least space between words, as shares of a letter's size.
LINE, SPACE, PARAGRAPH = 0.5, 0.28, 1.5
#: A gutter is this wide at least, and both of its sides hold this share of a page's width.
GUTTER, SIDE = 8.0, 0.18


def is_bold(font: Column) -> Column:
    return F.lower(font).rlike("bold|black|heavy|demi")


def is_italic(font: Column, flag: Column, angle: Column, shear: Column) -> Column:
    """By name, by the descriptor's flag, by an italic angle below -5 or a shear above 0.1."""
    return F.coalesce(F.lower(font).rlike("italic|oblique"), F.lit(False)) | F.coalesce(flag, F.lit(False)) | F.coalesce(angle < -5, F.lit(False)) | F.coalesce(F.abs(shear) > 0.1, F.lit(False))


def marks(bold: bool, italic: bool) -> str:
    return "*" * (2 * bold + italic)


def line_text(letters: list[tuple], styled: bool) -> str:
    """Letters ``x, y, text, height, bold, italic`` of one line, from left to right, with style marks around their spans."""
    words: list[tuple[str, bool, bool]] = []
    end, size = None, 0.0
    for x, _, text, height, bold, italic in letters:
        gap = end is not None and x - end > SPACE * max(size, height) and text != " "
        if gap and words and not words[-1][0].endswith(" "):
            words.append((" ", words[-1][1] and bold, words[-1][2] and italic))
        words.append((text, bold, italic))
        end, size = x + 0.5 * height * len(text), height
    out = ""
    for (bold, italic), part in groupby(words, key=lambda w: (w[1], w[2])):
        text = "".join(w[0] for w in part)
        core = text.strip()
        m = marks(bold, italic) if styled and core else ""
        out += text[: len(text) - len(text.lstrip())] + m + core + m + text[len(text.rstrip()) :] if core else text
    return re.sub(" {2,}", " ", out).strip()


def text_lines(letters: list[tuple]) -> list[list[tuple]]:
    """Letters in lines from top to bottom."""
    rows: list[list[tuple]] = []
    for g in sorted(letters, key=lambda g: (g[1], g[0])):
        if rows and abs(g[1] - rows[-1][0][1]) <= LINE * max(g[3], rows[-1][0][3]):
            rows[-1].append(g)
        else:
            rows.append([g])
    return [sorted(r) for r in rows]


def column_text(letters: list[tuple], styled: bool = True) -> str:
    """Lines of a column; a wider step than usual starts a paragraph."""
    rows = text_lines(letters)
    steps = sorted(b[0][1] - a[0][1] for a, b in zip(rows, rows[1:]))
    usual = steps[len(steps) // 2] if steps else 0.0
    out: list[str] = []
    for k, r in enumerate(rows):
        if k and r[0][1] - rows[k - 1][0][1] > PARAGRAPH * usual:
            out.append("")
        out.append(line_text(r, styled))
    return "\n".join(out)


def gutters(letters: list[tuple], width: float, most: int = 0) -> list[tuple[int, int]]:
    """Clear vertical strips of a page with text well to both sides, from how many letters cover each whole point."""
    steps = np.zeros(max(1, int(width)) + 1, int)
    for x, _, _, height, *_ in letters:
        a = min(max(0, int(x)), len(steps) - 2)
        steps[a] += 1
        steps[min(len(steps) - 1, a + max(1, int(np.ceil(0.6 * height))))] -= 1
    bins = np.cumsum(steps)[:-1]
    n = bins.sum()
    out = []
    for a, b in find_gaps(bins, 0, len(bins), most, int(GUTTER), bridge=0, raw=int(GUTTER)):
        left, right = bins[:a].sum(), bins[b:].sum()
        if a > SIDE * width and b < (1 - SIDE) * width and min(left, right) >= 0.1 * n:
            out.append((a, b))
    return out


def zones(letters: list[tuple], width: float) -> list[tuple[float, float, list[tuple[int, int]]]]:
    """``top, bottom, gutters`` of a page's bands: a heading over the whole width parts from the columns below it."""
    rows = text_lines(letters)
    if not rows:
        return []
    found = gutters(letters, width) or (gutters(letters, width, max(1, len(rows) // 12)) if len(rows) >= 8 else [])
    if not found:
        return [(rows[0][0][1], rows[-1][0][1], [])]
    crosses = [any(any(a <= g[0] < b for g in r) for a, b in found) for r in rows]
    out = []
    for a, b in islands(np.array([not c for c in crosses])):
        out.append((a, b, found))
    for a, b in islands(np.array(crosses)):
        out.append((a, b, []))
    return [(rows[a][0][1], rows[b - 1][0][1], g) for a, b, g in sorted(out)]


def page_text(letters: list[tuple], width: float, styled: bool = True) -> str:
    """A page's text, band by band and column by column."""
    parts = []
    for top, bottom, found in zones(letters, width):
        band = [g for g in letters if top - 0.01 <= g[1] <= bottom + 0.01 or any(abs(g[1] - y) <= LINE * g[3] for y in (top, bottom))]
        stops = [0.0, *(float(x) for g in found for x in g), float("inf")]
        parts += [column_text([g for g in band if a <= g[0] < b], styled) for a, b in zip(stops[::2], stops[1::2])]
    return "\n\n".join(p for p in parts if p)


def sidebar_text(letters: list[tuple], width: float) -> str:
    """Text of a narrow column at a page's edge, empty if there is none."""
    parts = []
    for top, bottom, found in zones(letters, width):
        if len(found) == 1:
            (a, b), = found
            side = (lambda x: x < a) if a <= 0.35 * width else (lambda x: x >= b) if b >= 0.65 * width else None
            if side:
                parts.append(column_text([g for g in letters if top <= g[1] <= bottom and side(g[0])], False))
    return "\n\n".join(filter(None, parts))


FIELDS = ("x", "y", "text", "height", "bold", "italic")


def _by_page(glyphs: DataFrame, keys: list[str], f, name: str = "text") -> DataFrame:
    """``f`` of the letters of each page; a page is a bounded group."""
    kinds = {k: t for k, t in glyphs.dtypes}
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + f", {name} string"

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        t = t.sort_by("seq")
        letters = list(zip(*(t.column(c).to_pylist() for c in FIELDS)))
        width = max(t.column("page_width").to_pylist())
        types = {f.name: f.type for f in t.schema}
        return pa.table({**{k: pa.array([v.as_py()], types[k]) for k, v in zip(keys, key)}, name: pa.array([f(letters, width)])})

    return glyphs.select(*keys, "seq", *FIELDS, "page_width").groupBy(*keys).applyInArrow(run, schema)


def pages_text(glyphs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, text`` of pages of ``seq, x, y, text, height, bold, italic, page_width`` rows."""
    return _by_page(glyphs, keys, lambda g, w: page_text(g, w))


def sidebars(glyphs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, text``: each page's sidebar, pages without one left out."""
    return _by_page(glyphs, keys, sidebar_text).where("text <> ''")


def sidebar_document(side: DataFrame, doc: str, page: str) -> DataFrame:
    """``doc, markdown``: sidebars under a line that names their page."""
    one = F.struct(F.col(page).alias("p"), F.concat(F.lit("--- Page "), F.col(page).cast("string"), F.lit(" Sidebar ---\n\n"), "text").alias("t"))
    return side.groupBy(doc).agg(F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["t"]), "\n\n").alias("markdown"))


def crop_text(glyphs: DataFrame, boxes: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, seq_box, text``: text of each sub-page's box (``seq_box, x0, y0, x1, y1``), with style marks."""
    held = within(glyphs.withColumn("_key", F.struct(*keys)), boxes.withColumn("_key", F.struct(*keys)).drop(*keys), "_key").drop("_key", "x0", "x1", "y0", "y1")
    return _by_page(held, [*keys, "seq_box"], lambda g, _: column_text(g))


def boxed_as_quotes(text: Column) -> Column:
    """A box's text as a quotation."""
    return F.regexp_replace(text, r"(?m)^", "> ")


