"""Tables on a page image: ruled, boxed, implied by gutters, or numbered die rolls."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.config import DEFAULT, Config

from .glyphs import crop_text
from .layout import Gap, analyse, between, find_gaps, image_array, ink_mask, islands
from .rules import table_type

# Fixed values, in pixels at 150 dots an inch or as shares.
RULE_SPAN, RULE_HEIGHT = 0.50, 4
POST_LENGTH, POST_WIDTH, POST_REACH = 40, 4, 15
BORDER_SLOP, BOX_COLUMNS = 12, 3
ROWS, REGULAR, GAP_TO_ROW, END_GAP = 3, 0.60, 0.20, 20
TITLE_HEIGHT, TITLE_LEAD, TITLE_RANGE = 40, 8, 100
GUTTER, SUB_COLUMN, DIE_ENTRIES = 8, 0.10, 6

SCHEMA = "array<struct<x_left:int,x_right:int,y_top:int,y_bottom:int,rule_top:int,rule_bottom:int,title_top:int,title_bottom:int,style:string>>"


@dataclass
class Region:
    """A table's place; what it lacks is None."""

    x_left: int
    x_right: int
    y_top: int
    y_bottom: int
    style: str
    rule: Gap | None = None
    title: Gap | None = None

    def row(self) -> dict:
        r, t = self.rule or (None, None), self.title or (None, None)
        return {"x_left": self.x_left, "x_right": self.x_right, "y_top": self.y_top, "y_bottom": self.y_bottom, "rule_top": r[0], "rule_bottom": r[1], "title_top": t[0], "title_bottom": t[1], "style": self.style}


def longest_runs(mask: np.ndarray) -> np.ndarray:
    """Length of the longest run of true in each row."""
    pos = np.arange(1, mask.shape[1] + 1)
    last = np.maximum.accumulate(np.where(mask, 0, pos), axis=1)
    return (pos - last).max(axis=1, initial=0)


def rules(ink: np.ndarray, left: int, right: int, top: int, bottom: int) -> list[Gap]:
    """Thin rows inked without a break over half of the width."""
    full = longest_runs(ink[top:bottom, left:right]) >= RULE_SPAN * (right - left)
    return [(a + top, b + top) for a, b in islands(full) if b - a <= RULE_HEIGHT]


def posts(ink: np.ndarray, left: int, right: int, top: int, bottom: int) -> list[tuple[int, int, int]]:
    """``x, top, bottom`` of thin columns inked without a break."""
    a, b = max(0, left - POST_REACH), min(ink.shape[1], right + POST_REACH)
    full = longest_runs(ink[top:bottom, a:b].T) >= POST_LENGTH
    out = []
    for x, y in islands(full):
        if y - x <= POST_WIDTH:
            s, e = max(islands(ink[top:bottom, a + x]), key=lambda g: g[1] - g[0])
            out.append(((2 * a + x + y) // 2, s + top, e + top))
    return out


def sub_columns(ink: np.ndarray, left: int, right: int, top: int, bottom: int, page_gutters: list[Gap]) -> int:
    """How many columns clear gutters make, those of the page itself apart."""
    cols = ink[top:bottom, left:right].sum(axis=0)
    gaps = [(a + left, b + left) for a, b in find_gaps(cols, 0, right - left, 0, GUTTER)]
    gaps = [g for g in gaps if g[0] > left and g[1] < right and not any(g[0] < b and g[1] > a for a, b in page_gutters)]
    return sum(b - a >= SUB_COLUMN * (right - left) for a, b in between(gaps, left, right))


def text_rows(rows: np.ndarray, top: int, bottom: int, c: Config) -> list[Gap]:
    """Runs of inked rows up to the first wide gap."""
    out: list[Gap] = []
    for a, b in islands(rows[top:bottom] >= c.min_ink_for_content):
        if out and a + top - out[-1][1] >= END_GAP:
            break
        out.append((a + top, b + top))
    return out


def regular(clusters: list[Gap]) -> bool:
    pitch = np.diff([a for a, _ in clusters]).astype(float)
    return len(clusters) >= ROWS and len(pitch) > 0 and pitch.mean() > 0 and pitch.std() / pitch.mean() <= REGULAR


def spaced(clusters: list[Gap]) -> bool:
    gaps = [y[0] - x[1] for x, y in zip(clusters, clusters[1:])]
    return bool(gaps) and np.mean(gaps) / max(1.0, np.mean([b - a for a, b in clusters])) >= GAP_TO_ROW


def title_above(rows: np.ndarray, y: int, top: int, c: Config) -> Gap | None:
    """The nearest line above that is low enough and stands clear of what is over it."""
    found = [(a + max(top, y - TITLE_RANGE), b + max(top, y - TITLE_RANGE)) for a, b in islands(rows[max(top, y - TITLE_RANGE) : y] >= c.min_ink_for_content)]
    if not found or found[-1][1] - found[-1][0] > TITLE_HEIGHT:
        return None
    lead = found[-1][0] - (found[-2][1] if len(found) > 1 else max(top, y - TITLE_RANGE))
    return found[-1] if lead >= TITLE_LEAD else None


def detect(image: np.ndarray, numbers: dict[tuple[int, int], list[int]] | None = None, c: Config = DEFAULT) -> list[Region]:
    """The page's tables from top to bottom.

    ``numbers`` gives, for the left and right of a column, the integers printed in its number strip in order;
    without it die-roll tables are not found.
    """
    ink = ink_mask(image, c.ink_threshold)
    page = analyse(image, c)
    out: list[Region] = []
    free = lambda a, b: all(b <= r.y_top or a >= r.y_bottom for r in out)
    for zone in (z for z in page["zones"] if z["type"] != "IMAGE"):
        cols = [(k["x_left"], k["x_right"]) for k in zone["columns"]] or [(page["margins"]["left"], page["margins"]["right"])]
        gutters = [(a[1], b[0]) for a, b in zip(cols, cols[1:])]
        for left, right in cols:
            top, bottom = zone["y_top"], zone["y_bottom"]
            rows = ink[:, left:right].sum(axis=1)
            lines, sides = rules(ink, left, right, top, bottom), posts(ink, left, right, top, bottom)
            boxed: set[int] = set()
            for i, (a, _) in enumerate(lines):  # a box: two rules with posts at both ends
                for j in range(i + 1, len(lines)):
                    b = lines[j][0]
                    ends = [any(abs(x - e) <= BORDER_SLOP + POST_REACH and s <= a + BORDER_SLOP and t >= b - BORDER_SLOP for x, s, t in sides) for e in (left, right)]
                    if all(ends):
                        boxed |= {i, j}
                        inside = between(find_gaps(rows, lines[i][1], b, max(1, (right - left) // 200), 2), lines[i][1], b)
                        prose = not spaced(inside) or np.mean([y - x for x, y in inside]) == 0
                        if sub_columns(ink, left + BORDER_SLOP, right - BORDER_SLOP, lines[i][1], b, gutters) >= BOX_COLUMNS and not (prose and len(inside) < ROWS) and free(a, b):
                            out.append(Region(left, right, a, lines[j][1], "RULE_BASED", rule=lines[i], title=title_above(rows, a, top, c)))
                        break
            for i, (a, b) in enumerate(lines):  # a rule under a heading, rows below
                if i in boxed or not free(a, b):
                    continue
                body = text_rows(rows, b, bottom, c)
                head = title_above(rows, a, top, c)
                if regular(body) and spaced(body):
                    start = head[0] if head else a
                    out.append(Region(left, right, start, body[-1][1], "RULE_BASED", rule=(a, b), title=title_above(rows, start, top, c)))
            gaps = find_gaps(rows, top, bottom, c.min_ink_for_content - 1, END_GAP)
            for a, b in between(gaps, top, bottom):  # no rule: rows and gutters alone
                if not free(a, b):
                    continue
                body = text_rows(rows, a, b, c)
                head = title_above(rows, a, top, c)
                if head and regular(body) and spaced(body) and sub_columns(ink, left, right, a, b, gutters) >= 2:
                    out.append(Region(left, right, a, b, "COLUMN_IMPLICIT", title=head))
                elif head and numbers and consecutive(numbers.get((left, right), [])) >= DIE_ENTRIES:
                    out.append(Region(left, right, a, b, "DIE_ROLL", title=head))
    return sorted(out, key=lambda r: (r.y_top, r.x_left))


def consecutive(values: list[int]) -> int:
    want = 1
    for v in values:
        want = v + 1 if v >= want else want
    return want - 1


def page_tables(pages: DataFrame, image: str = "image", config: Config = DEFAULT) -> DataFrame:
    """``pages`` with ``tables`` for each page image."""

    @F.pandas_udf(SCHEMA)
    def run(images):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series([[r.row() for r in detect(image_array(h, w, n, d), c=config)] for h, w, n, d in zip(images["height"], images["width"], images["nChannels"], images["data"])])

    return pages.withColumn("tables", run(F.col(image)))


def with_titles(found: DataFrame, glyphs: DataFrame, keys: list[str], dpi: float = 150.0) -> DataFrame:
    """Tables (``keys``, the fields of ``tables``) with the ``title`` that stands in their title's place, and their ``type``.

    ``glyphs`` are placed in points from the upper left of the page, tables in pixels of its image.
    """
    pt = 72.0 / dpi
    numbered = found.withColumn("seq_box", F.xxhash64("x_left", "y_top", "y_bottom"))
    places = numbered.where("title_top is not null").select(*keys, "seq_box", *((F.col(a) * pt).alias(b) for a, b in (("x_left", "x0"), ("x_right", "x1"), ("title_top", "y0"), ("title_bottom", "y1"))))
    titles = crop_text(glyphs, places, keys).select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("seq_box").alias("_box"), F.regexp_replace("text", r"\*+", "").alias("title"))
    on = [F.col(k) == F.col(f"_{k}") for k in keys] + [F.col("seq_box") == F.col("_box")]
    out = numbered.join(titles, on, "left").drop("seq_box", "_box", *(f"_{k}" for k in keys))
    return out.withColumn("type", table_type(F.col("title")))
