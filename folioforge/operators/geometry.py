"""Joins of boxes, edges and intervals inside one page."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def nearest_below(edges: DataFrame, page: str, *, near: float = 8, least: float = 30) -> DataFrame:
    """``page, id, below``: for each edge (``id, x, y, w``) the nearest lower edge of like place and width.

    Both ends lie within ``near``, the distance is ``least`` or more; of equal distances the smaller id. The
    join is on the page, whose edges are tens.
    """
    a = edges.select(page, "id", F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("w").alias("aw"))
    b = edges.select(F.col(page).alias("_p"), F.col("id").alias("below"), "x", "y", "w")
    pairs = a.join(b, (F.col(page) == F.col("_p")) & (F.abs(F.col("x") - F.col("ax")) <= near) & (F.abs(F.col("w") - F.col("aw")) <= near) & (F.col("y") - F.col("ay") >= least))
    best = F.min_by("below", F.struct(F.col("y") - F.col("ay"), F.col("below")))
    return pairs.groupBy(page, "id").agg(best.alias("below"))


def boxes_from_edges(edges: DataFrame, page: str) -> DataFrame:
    """``page, x, y, w, h``: boxes between each edge and the nearest one below it."""
    pairs = nearest_below(edges, page)
    low = edges.select(page, F.col("id").alias("below"), F.col("y").alias("_y"))
    return edges.join(pairs, [page, "id"]).join(low, [page, "below"]).select(page, "x", "y", "w", (F.col("_y") - F.col("y")).alias("h"))


def overlapping(regions: DataFrame, others: DataFrame, page: str, *, keep: bool = True) -> DataFrame:
    """Regions (``top, bottom``) that overlap one of ``others`` on their page, or with ``keep=False`` those that do not."""
    o = others.select(F.col(page).alias("_p"), F.col("top").alias("_t"), F.col("bottom").alias("_b"))
    on = (F.col(page) == F.col("_p")) & (F.col("top") < F.col("_b")) & (F.col("bottom") > F.col("_t"))
    return regions.join(o, on, "left_semi" if keep else "left_anti")


def within(points: DataFrame, regions: DataFrame, page: str) -> DataFrame:
    """Points (``x, y``) with each region (``x0, y0, x1, y1``) of their page that holds them, bounds included."""
    on = (F.col("x") >= F.col("x0")) & (F.col("x") <= F.col("x1")) & (F.col("y") >= F.col("y0")) & (F.col("y") <= F.col("y1"))
    return points.join(regions, page).where(on)


def framed(horizontal: DataFrame, vertical: DataFrame, page: str, slop: float = 12) -> DataFrame:
    """Horizontal lines (``id, x0, x1, y``) with a vertical line (``x, y0, y1``) near both of their ends."""
    v = vertical.select(F.col(page).alias("_p"), F.col("x").alias("_x"), "y0", "y1")
    pairs = horizontal.join(v, (F.col(page) == F.col("_p")) & (F.col("y") >= F.col("y0") - slop) & (F.col("y") <= F.col("y1") + slop))
    near = lambda c: F.bool_or(F.abs(F.col("_x") - F.col(c)) <= slop)
    return pairs.groupBy(page, "id").agg(near("x0").alias("_l"), near("x1").alias("_r")).where("_l and _r").select(page, "id")


def closest_angle(targets: DataFrame, peaks: DataFrame, key: str, tolerance: int) -> DataFrame:
    """``key, target, theta``: the nearest peak (``theta, strength``) within the tolerance, angles wrapping at 180; of equals the stronger."""
    d = F.abs(F.col("target") - F.col("theta")).cast("int")
    pairs = targets.join(peaks, key).withColumn("_d", F.least(d, 180 - d)).where(F.col("_d") <= tolerance)
    return pairs.groupBy(key, "target").agg(F.min_by("theta", F.struct("_d", -F.col("strength"), "theta")).alias("theta"))


def two_column_documents(pages: DataFrame, doc: str, *, share: int = 3, reach: float = 0.78) -> DataFrame:
    """``doc, sampled, votes, two_column``: documents where enough sampled pages have a clear gap and text far to the right.

    ``pages`` has ``page, gap, right, width``; about twenty pages of a document are looked at, evenly spaced.
    """
    w = Window.partitionBy(doc)
    step = F.greatest(F.floor((F.max("page").over(w) - F.min("page").over(w) + 1) / 20), F.lit(1))
    sampled = pages.withColumn("_s", (F.col("page") - F.min("page").over(w)) % step == 0).where("_s")
    out = sampled.groupBy(doc).agg(F.count(F.lit(1)).alias("sampled"), F.count_if(F.col("gap").isNotNull() & (F.col("right") >= reach * F.col("width"))).alias("votes"))
    return out.withColumn("two_column", F.col("votes") >= F.greatest(F.lit(2), F.floor(F.col("sampled") / share)))
