"""Projections and intervals as array expressions: a page stays one row, nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GAP = "struct<start:int,end:int>"


def runs(flags: Column) -> Column:
    """``ARRAY<STRUCT<start, end>>`` of the runs of true in a boolean array; ``end`` is exclusive."""
    n = F.size(flags)
    at = lambda i: F.coalesce(F.get(flags, i), F.lit(False))
    all_ = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    starts = F.filter(all_, lambda i: at(i) & ((i == 0) | ~at(i - 1)))
    ends = F.filter(all_, lambda i: at(i) & ((i == n - 1) | ~at(i + 1)))
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b + 1).alias("end")))


def long_runs(flags: Column, least: int | Column) -> Column:
    return F.filter(runs(flags), lambda g: g["end"] - g["start"] >= least)


def merged(gaps: Column, bridge: int | Column) -> Column:
    """Sorted gaps joined where what lies between them is at most ``bridge`` long."""
    empty = F.array().cast(f"array<{GAP}>")

    def step(acc: Column, g: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], g["end"]).alias("end"))
        return F.when((F.size(acc) > 0) & (g["start"] - last["end"] <= bridge), F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(joined))).otherwise(F.concat(acc, F.array(g)))

    return F.aggregate(gaps, empty, step)


def find_gaps(values: Column, max_ink: float | Column, least: int, *, bridge: int | None = None, raw_least: int | None = None) -> Column:
    """Runs of values of at most ``max_ink``, joined over short bridges and then at least ``least`` long."""
    raw = long_runs(F.transform(values, lambda v: v <= max_ink), raw_least if raw_least is not None else max(1, least // 2))
    return F.filter(merged(raw, least if bridge is None else bridge), lambda g: g["end"] - g["start"] >= least)


def bands(gaps: Column, size: Column, least: int) -> Column:
    """What lies between gaps: gaps are joined where the band between is shorter than ``least``, then complemented."""
    joined = merged(gaps, least - 1)
    edges = F.concat(F.array(F.lit(0)), F.transform(joined, lambda g: g["end"]))
    stops = F.concat(F.transform(joined, lambda g: g["start"]), F.array(size))
    return F.filter(F.zip_with(edges, stops, lambda a, b: F.struct(a.alias("start"), b.alias("end"))), lambda g: g["end"] > g["start"])


def longest(gaps: Column) -> Column:
    """The longest interval, the earliest of equals; null without any."""
    return F.get(F.array_sort(gaps, lambda a, b: F.when(a["end"] - a["start"] > b["end"] - b["start"], -1).when(a["end"] - a["start"] < b["end"] - b["start"], 1).otherwise(a["start"] - b["start"])), F.lit(0))


def nearest(gaps: Column, centre: Column) -> Column:
    """The interval whose middle is nearest to ``centre``, the leftmost of equals."""
    far = lambda g: F.abs((g["start"] + g["end"]) / 2 - centre)
    return F.get(F.array_sort(gaps, lambda a, b: F.when(far(a) < far(b), -1).when(far(a) > far(b), 1).otherwise(a["start"] - b["start"])), F.lit(0))


def moving_average(values: Column, reach: int) -> Column:
    """Mean of the values within ``reach`` on both sides, clipped at the ends."""

    def mean(_: Column, i: Column) -> Column:
        lo = F.greatest(i - reach, F.lit(0))
        part = F.slice(values, lo + 1, F.least(i + reach, F.size(values) - 1) - lo + 1)
        return F.aggregate(part, F.lit(0.0), lambda a, v: a + v) / F.size(part)

    return F.transform(values, mean)


def density(values: Column, start: Column, end: Column) -> Column:
    part = F.slice(values, start + 1, F.greatest(end - start, F.lit(0)))
    return F.when(F.size(part) > 0, F.aggregate(part, F.lit(0.0), lambda a, v: a + v) / F.size(part))


def upper_median(values: Column) -> Column:
    """The sorted value at index n/2, not an interpolation."""
    return F.get(F.sort_array(values), F.floor(F.size(values) / 2).cast("int"))


def low_decile(values: Column) -> Column:
    return F.get(F.sort_array(values), F.floor(F.size(values) / 10).cast("int"))


def consecutive_from_one(values: Column) -> Column:
    """How many of 1, 2, 3, ... occur in order, skipping what does not fit but never backwards."""
    return F.aggregate(values, F.lit(1), lambda want, v: F.when(v >= want, v + 1).otherwise(want)) - 1


def variation(values: Column) -> Column:
    """Population deviation over mean."""
    n = F.size(values)
    mean = F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / n
    var = F.aggregate(values, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean)) / n
    return F.when((n > 0) & (mean != 0), F.sqrt(var) / mean)


def modal_gap(values: Column) -> Column:
    """The value that most values lie within 20 % of, the first of equals."""
    counted = F.transform(values, lambda v, i: F.struct(F.size(F.filter(values, lambda u: (u / v >= 0.8) & (u / v <= 1.2))).alias("n"), (-i).alias("i"), v.alias("v")))
    return F.when(F.size(values) > 0, F.array_max(counted)["v"])


def overlaps(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return (a_start < b_end) & (a_end > b_start)


def angle_distance(a: Column, b: Column) -> Column:
    d = F.abs(a - b).cast("int")
    return F.least(d, 180 - d)
