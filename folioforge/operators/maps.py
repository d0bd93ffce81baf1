"""Straight lines, grids and hexes of map images: Hough votes and peaks as relations, dense pixels in Arrow batches."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from folioforge.config import Config

THETAS = 180
ANGLES = [(t, round(math.cos(math.radians(t)), 9), round(math.sin(math.radians(t)), 9)) for t in range(THETAS)]
TOP_LINES = 500
#: Cells of votes, and points, that are counted at once.
CELLS, POINTS = 1_000_000, 10_000


def angles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ANGLES, "theta int, cos double, sin double")


def whole_images(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Keys, first rows (and the end), x and y of some whole images of points sorted by their first column, the key."""
    held: list[pa.RecordBatch] = []

    def joined() -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        t = pa.Table.from_batches(held).combine_chunks()
        keys = t.column(0).combine_chunks()
        first = np.append(starts(keys), len(keys))
        return keys.take(pa.array(first[:-1])), first, t.column(1).to_numpy().astype(np.float64), t.column(2).to_numpy().astype(np.float64)

    def starts(keys: pa.Array) -> np.ndarray:
        ids = keys.dictionary_encode(null_encoding="encode").indices.to_numpy()
        return np.flatnonzero(np.diff(ids, prepend=-1))

    for b in batches:
        if not b.num_rows:
            continue
        last = int(starts(b.column(0))[-1])
        if last:
            held.append(b.slice(0, last))
        if held and (last or held[-1].column(0)[-1].as_py() != b.column(0)[0].as_py()):
            yield joined()
            held = []
        held.append(b.slice(last))
    if held:
        yield joined()


def accumulated(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, int]]:
    """Keys of some images, their votes by image, angle and rho, and the rho of the first column: CELLS cells at once, or one image."""
    cos, sin = (np.array([a[k] for a in ANGLES]) for k in (1, 2))
    for keys, first, x, y in whole_images(batches):
        far = int(np.hypot(np.abs(x).max(), np.abs(y).max())) + 2
        width = 2 * far + 1
        some = max(1, CELLS // (THETAS * width))
        for a in range(0, len(keys), some):
            b = min(a + some, len(keys))
            votes = np.zeros((b - a) * THETAS * width, np.int64)
            image = np.repeat(np.arange(b - a), np.diff(first[a : b + 1]))
            for s in range(first[a], first[b], POINTS):
                e = min(s + POINTS, first[b])
                rho = np.floor(x[s:e, None] * cos + y[s:e, None] * sin + 0.5).astype(np.int64) + far
                at = (image[s - first[a] : e - first[a], None] * THETAS + np.arange(THETAS)) * width + rho
                if e - s == first[b] - first[a]:
                    votes = np.bincount(at.ravel(), minlength=len(votes))
                else:
                    np.add.at(votes, at.ravel(), 1)
            yield keys.slice(a, b - a), votes.reshape(b - a, THETAS, width), -far


def lines_of(points: DataFrame, key: str, chosen: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """``key, theta, rho, votes`` of the cells that ``chosen`` marks in votes by image, angle and rho.

    Points are dealt by image and counted there: no votes are dealt or sorted. Points without a place have no vote.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, votes, least in accumulated(batches):
            image, theta, rho = np.nonzero(chosen(votes))
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(image)), pa.array(theta.astype(np.int32)), pa.array((rho + least).astype(np.int32)), pa.array(votes[image, theta, rho])], names=[key, "theta", "rho", "votes"])

    return by_image(points, key).mapInArrow(run, StructType([points.schema[key], *StructType.fromDDL("theta int, rho int, votes bigint")]))


def by_image(points: DataFrame, key: str) -> DataFrame:
    return points.select(key, "x", "y").where("x is not null and y is not null").repartition(key).sortWithinPartitions(key)


def hough_votes(points: DataFrame, key: str = "img_id", least: int = 1) -> DataFrame:
    """``key, theta, rho, votes`` of edge points ``key, x, y``: each point votes once for each of 180 angles."""
    return lines_of(points, key, lambda votes: votes >= max(1, least))


def hough_peaks(points: DataFrame, least: int, key: str = "img_id", reach: int = 5) -> DataFrame:
    """What ``suppress`` leaves of the votes of edge points."""

    def peaks_of(votes: np.ndarray) -> np.ndarray:
        around = np.zeros_like(votes)
        for d in range(1, min(reach, votes.shape[2] - 1) + 1):
            np.maximum(around[..., d:], votes[..., :-d], out=around[..., d:])
            np.maximum(around[..., :-d], votes[..., d:], out=around[..., :-d])
        return (votes >= least) & (votes > around)

    return lines_of(points, key, peaks_of)


def hough_top(points: DataFrame, n: int = TOP_LINES, key: str = "img_id") -> DataFrame:
    """What ``top_lines`` leaves of the votes of edge points."""

    def first(votes: np.ndarray) -> np.ndarray:
        flat = votes.reshape(len(votes), -1)
        size = flat.shape[1]
        rank = flat * size + np.arange(size - 1, -1, -1)  # of equal votes the first angle, then the first rho
        out = np.zeros(flat.shape, bool)
        best = np.argpartition(rank, size - n, axis=1)[:, size - n :] if n < size else np.broadcast_to(np.arange(size), flat.shape)
        np.put_along_axis(out, best, True, axis=1)
        return (out & (flat > 0)).reshape(votes.shape)

    return lines_of(points, key, first)


def hough_angles(points: DataFrame, least: int, key: str = "img_id") -> DataFrame:
    """``angle_histogram`` of the lines with at least ``least`` votes of edge points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, votes, _ in accumulated(batches):
            n = (votes >= max(1, least)).sum(axis=2)
            image, theta = np.nonzero(n)
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(image)), pa.array(theta.astype(np.int32)), pa.array(n[image, theta] / n.max(axis=1)[image])], names=[key, "theta", "strength"])

    return by_image(points, key).mapInArrow(run, StructType([points.schema[key], *StructType.fromDDL("theta int, strength double")]))


def suppress(votes: DataFrame, least: int | Column, key: str = "img_id", reach: int = 5) -> DataFrame:
    """Lines with at least ``least`` votes and more than any other of their angle within ``reach`` of rho."""
    w = Window.partitionBy(key, "theta").orderBy("rho")
    around = F.greatest(F.coalesce(F.max("votes").over(w.rangeBetween(-reach, -1)), F.lit(0)), F.coalesce(F.max("votes").over(w.rangeBetween(1, reach)), F.lit(0)))
    return votes.withColumn("_m", around).where((F.col("votes") >= least) & (F.col("votes") > F.col("_m"))).drop("_m")


def top_lines(votes: DataFrame, n: int = TOP_LINES, key: str = "img_id") -> DataFrame:
    """The ``n`` lines of most votes of each image, then by angle and rho."""
    w = Window.partitionBy(key).orderBy(F.desc("votes"), "theta", "rho")
    return votes.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def angle_histogram(line_rows: DataFrame, key: str = "img_id") -> DataFrame:
    """``key, theta, strength``: lines of each angle over the most of any angle."""
    counted = line_rows.groupBy(key, "theta").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("strength", F.col("n") / F.max("n").over(Window.partitionBy(key))).drop("n")


def peaks(histogram: np.ndarray, least: float, window: int) -> list[tuple[int, float]]:
    """Angles that are circular local maxima within ``window`` and reach ``least``, strongest first."""
    n = len(histogram)
    near = np.stack([np.roll(histogram, s) for s in range(-window, window + 1) if s])
    at = np.flatnonzero((histogram >= least) & (histogram >= near.max(axis=0)) & (histogram > 0))
    kept: list[int] = []
    for t in sorted(at.tolist(), key=lambda t: (-histogram[t], t)):
        if all(min(abs(t - k), n - abs(t - k)) > window for k in kept):
            kept.append(t)
    return [(t, float(histogram[t])) for t in kept]


def gray(image: np.ndarray) -> np.ndarray:
    """Integer luma of an RGB image."""
    x = image.astype(np.int32)
    return (299 * x[..., 0] + 587 * x[..., 1] + 114 * x[..., 2]) // 1000


def canny(image: np.ndarray, low: float, high: float) -> np.ndarray:
    """Edge mask: 5x5 Gaussian with clamped borders, Sobel, thinning across the gradient, hysteresis over 8 neighbours."""
    g = gray(image).astype(np.float64) if image.ndim == 3 else image.astype(np.float64)
    k = np.array([2, 4, 5, 4, 2, 4, 9, 12, 9, 4, 5, 12, 15, 12, 5, 4, 9, 12, 9, 4, 2, 4, 5, 4, 2], float).reshape(5, 5) / 159

    def convolve(a: np.ndarray, kernel: np.ndarray) -> np.ndarray:
        r = kernel.shape[0] // 2
        p = np.pad(a, r, mode="edge")
        return sum(kernel[i, j] * p[i : i + a.shape[0], j : j + a.shape[1]] for i in range(kernel.shape[0]) for j in range(kernel.shape[1]))

    s = convolve(g, k)
    sx = np.array([[-1, 0, 1], [-2, 0, 2], [-1, 0, 1]], float)
    gx, gy = convolve(s, sx), convolve(s, sx.T)
    size = np.hypot(gx, gy)
    size[[0, -1]] = 0
    size[:, [0, -1]] = 0
    sector = np.round(np.rad2deg(np.arctan2(gy, gx)) % 180 / 45).astype(int) % 4
    p = np.pad(size, 1)
    h, w = size.shape
    shift = lambda dy, dx: p[1 + dy : 1 + dy + h, 1 + dx : 1 + dx + w]
    thin = np.zeros_like(size, bool)
    for k_, (dy, dx) in enumerate(((0, 1), (1, 1), (1, 0), (1, -1))):
        thin |= (sector == k_) & (size >= shift(dy, dx)) & (size >= shift(-dy, -dx))
    weak = thin & (size >= low)
    out = weak & (size >= high)
    while True:
        q = np.pad(out, 1)
        grown = weak & np.logical_or.reduce([q[1 + i : 1 + i + h, 1 + j : 1 + j + w] for i in (-1, 0, 1) for j in (-1, 0, 1)])
        if (grown == out).all():
            return out
        out = grown


def accumulate(edges: np.ndarray) -> tuple[np.ndarray, int]:
    """Votes by angle and rho, and the offset of rho 0."""
    ys, xs = np.nonzero(edges)
    diagonal = math.ceil(math.hypot(*edges.shape))
    out = np.zeros((THETAS, 2 * diagonal + 1), np.int64)
    for t in range(THETAS):
        a = math.radians(t)
        rho = np.floor(xs * math.cos(a) + ys * math.sin(a) + 0.5).astype(int)
        out[t] = np.bincount(rho + diagonal, minlength=2 * diagonal + 1)
    return out, diagonal


def spacing(rhos: list[int]) -> tuple[float, float, int]:
    """Modal distance of parallel lines, the deviation of those near it, and how many lines it joins."""
    r = np.unique(rhos)
    gaps = np.diff(r).astype(float)
    if not len(gaps):
        return 0.0, 1.0, len(r)
    near = (gaps[:, None] / gaps[None, :] >= 0.8) & (gaps[:, None] / gaps[None, :] <= 1.2)
    mode = gaps[int(near.sum(axis=0).argmax())]
    kept = gaps[(gaps / mode >= 0.8) & (gaps / mode <= 1.2)]
    return float(kept.mean()), float(kept.std() / kept.mean()), len(kept) + 1


def classify_map(image: np.ndarray, config: Config = Config()) -> dict:
    """Type (grid, hex or none), confidence, line angles, cell sizes and sections of a map image."""
    edges = canny(image, config.map_canny_low_threshold, config.map_canny_high_threshold)
    votes, offset = accumulate(edges)
    least = max(1, int(config.hough_vote_fraction * min(image.shape[:2])))
    best = np.stack([np.roll(votes, s, axis=1) for s in range(-5, 6) if s]).max(axis=0)
    for mask in ((votes >= least) & (votes > best), votes >= least):
        t, r = np.nonzero(mask)
        order = np.lexsort((r, t, -votes[t, r]))[:TOP_LINES]
        t, r = t[order], r[order] - offset
        counts = np.bincount(t, minlength=THETAS).astype(float)
        if not counts.any():
            continue
        found = peaks(counts / counts.max(), config.min_peak_strength, config.peak_merge_window)
        families = {a: r[t == a].tolist() for a, _ in found}
        fits = [f for f in (_hex(found, families, config), _grid(found, families, config)) if f]
        if fits:
            out = max(fits, key=lambda f: f["confidence"])
            return out | {"sections": map_sections(image, max(1, int(min(out["cell_w"], out["cell_h"]) * config.min_section_gap_factor)))}
    return {"type": "NON_MAP", "confidence": 0.0, "angles": [], "cell_w": 0.0, "cell_h": 0.0, "sections": map_sections(image, 20)}


def _fit(found: list[tuple[int, float]], targets: list[int], tolerance: int) -> list[tuple[int, float]] | None:
    out = []
    for target in targets:
        near = [(min(abs(a - target), 180 - abs(a - target)), k, a, s) for k, (a, s) in enumerate(found)]
        near = [x for x in near if x[0] <= tolerance]
        if not near:
            return None
        out.append(min(near)[2:])
    return out if len({a for a, _ in out}) == len(targets) else None


def _grid(found: list, families: dict, config: Config) -> dict | None:
    """The most confident pair of directions at right angles."""
    best = None
    for turn in range(90):
        fit = _fit(found, [turn, (turn + 90) % 180], config.grid_angle_tolerance)
        if fit and all(s >= config.min_grid_peak for _, s in fit):
            (w, cw, nw), (h, ch, nh) = (spacing(families[a]) for a, _ in fit)
            if min(nw, nh) >= config.min_regular_lines and min(w, h) > 0 and 0.7 <= w / h <= 1.43:
                strength = sum(s for _, s in fit) / 2
                fitted = {"type": "GRID_MAP", "confidence": min(1.0, 0.4 * strength + 0.4 * (1 - (cw + ch) / 2) + 0.2), "angles": [float(a) for a, _ in fit], "cell_w": w, "cell_h": h}
                best = max(best or fitted, fitted, key=lambda f: f["confidence"])
    return best


def _hex(found: list, families: dict, config: Config) -> dict | None:
    """The most confident triple of directions 60 degrees apart."""
    best = None
    for turn in range(60):
        fit = _fit(found, [turn, (turn + 60) % 180, (turn + 120) % 180], config.hex_angle_tolerance)
        if fit and sum(s >= config.min_hex_peak for _, s in fit) >= 2:
            parts = [spacing(families[a]) for a, _ in fit]
            regular = [p for p in parts if p[2] >= config.min_regular_lines]
            if len(regular) >= 2 and (size := float(np.mean([p[0] for p in regular]))) >= 10:
                strength = sum(s for _, s in fit) / 3
                fitted = {"type": "HEX_MAP", "confidence": min(1.0, 0.4 * strength + 0.4 * (1 - float(np.mean([p[1] for p in regular]))) + 0.2), "angles": [float(a) for a, _ in fit], "cell_w": size, "cell_h": size}
                best = max(best or fitted, fitted, key=lambda f: f["confidence"])
    return best


def gaps_of(density: np.ndarray, least: int, limit: float = 0.02) -> list[tuple[int, int]]:
    """Runs of densities below ``limit`` that end before the last position."""
    flags = np.r_[False, density < limit, False]
    edges = np.flatnonzero(flags[1:] != flags[:-1]).reshape(-1, 2)
    return [(int(a), int(b)) for a, b in edges if b - a >= least and b < len(density)]


def bands_of(gaps: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    stops = [0, *(x for g in gaps for x in g), n]
    return [(a, b) for a, b in zip(stops[::2], stops[1::2]) if b > a]


def map_sections(image: np.ndarray, least: int) -> list[tuple[int, int, int, int]]:
    """``x, y, w, h`` of the parts of a map that blank rows, and then blank columns, keep apart."""
    content = gray(image) < 230
    out = []
    for y0, y1 in bands_of(gaps_of(content.mean(axis=1), least), content.shape[0]):
        part = content[y0:y1]
        if part.any():
            for x0, x1 in bands_of(gaps_of(part.mean(axis=0), least), part.shape[1]):
                if part[:, x0:x1].any():
                    out.append((x0, y0, x1 - x0, y1 - y0))
    return out


# Codes of a map's cells; a door or thin wall is named by the side of the cell that it stands on.
FLOOR, WALL = 0, 1
DOORS = {"north": 2, "east": 3, "south": 4, "west": 5}
THIN_WALLS = {"north": 6, "east": 7, "south": 8, "west": 9}


def grid_cells(image: np.ndarray, cell_w: float, cell_h: float, config: Config = Config()) -> tuple[np.ndarray, np.ndarray]:
    """Cell codes and which floors are blank: a floor's upper median brightness reaches the threshold, a blank's low decile 200."""
    g = gray(image)
    rows, cols = max(1, round(g.shape[0] / cell_h)), max(1, round(g.shape[1] / cell_w))
    code, blank = np.full((rows, cols), WALL, np.int32), np.zeros((rows, cols), bool)
    for r in range(rows):
        for c in range(cols):
            v = np.sort(g[int(r * cell_h) : int((r + 1) * cell_h), int(c * cell_w) : int((c + 1) * cell_w)].ravel())
            if len(v) and v[len(v) // 2] >= config.floor_threshold:
                code[r, c] = FLOOR
                blank[r, c] = v[len(v) // 10] >= 200
    return code, blank


def fill_exterior(code: np.ndarray, blank: np.ndarray) -> np.ndarray:
    """Blank floor that is joined to the border by blank floor (4 neighbours) is outside the map."""
    free = (code == FLOOR) & blank
    edge = np.zeros_like(free)
    edge[[0, -1]] = edge[:, [0, -1]] = True
    out = free & edge
    while True:
        p = np.pad(out, 1)
        grown = free & (out | p[:-2, 1:-1] | p[2:, 1:-1] | p[1:-1, :-2] | p[1:-1, 2:])
        if (grown == out).all():
            return np.where(out, WALL, code)
        out = grown


def boundary(strip: np.ndarray, config: Config = Config()) -> dict[str, int] | None:
    """What parts two floor cells, from the brightness across their border: nothing, a door, or a thin wall."""
    dark = strip < config.floor_threshold
    share = dark.mean(axis=0)
    if not len(share) or share.max() < 0.5:
        return None
    bright = ~dark[:, int(share.argmax())]
    edges = np.flatnonzero(np.diff(np.r_[False, bright, False].astype(int))).reshape(-1, 2)
    longest = int((edges[:, 1] - edges[:, 0]).max()) if len(edges) else 0
    return DOORS if longest >= 0.25 * len(bright) else THIN_WALLS


def mark_boundaries(image: np.ndarray, code: np.ndarray, cell_w: float, cell_h: float, config: Config = Config()) -> np.ndarray:
    """Cell codes with the doors and thin walls between floors; a cell's first feature stays, upper and lower ones first."""
    g, out = gray(image), code.copy()
    reach = max(2, int(min(cell_w, cell_h) / 5))
    rows, cols = code.shape
    for dy, dx, here, there in ((1, 0, "south", "north"), (0, 1, "east", "west")):
        for r in range(rows - dy):
            for c in range(cols - dx):
                if code[r, c] != FLOOR or code[r + dy, c + dx] != FLOOR:
                    continue
                y0, y1, x0, x1 = int(r * cell_h), int((r + 1) * cell_h), int(c * cell_w), int((c + 1) * cell_w)
                strip = g[max(0, y1 - reach) : y1 + reach, x0:x1].T if dy else g[y0:y1, max(0, x1 - reach) : x1 + reach]
                kind = boundary(strip, config)
                if kind:
                    if out[r, c] == FLOOR:
                        out[r, c] = kind[here]
                    if out[r + dy, c + dx] == FLOOR:
                        out[r + dy, c + dx] = kind[there]
    return out


def dungeon(image: np.ndarray, cell_w: float, cell_h: float, config: Config = Config()) -> np.ndarray:
    """The grid of cell codes of a map section."""
    code, blank = grid_cells(image, cell_w, cell_h, config)
    return mark_boundaries(image, fill_exterior(code, blank), cell_w, cell_h, config)


def section_bounds(section: tuple[int, int, int, int], cell_w: float, cell_h: float, width: int, height: int) -> tuple[int, int, int, int]:
    """A section's place with half a cell around it, inside the page."""
    x, y, w, h = section
    x0, y0 = max(0, int(x - cell_w / 2)), max(0, int(y - cell_h / 2))
    return x0, y0, min(width, int(x + w + cell_w / 2)) - x0, min(height, int(y + h + cell_h / 2)) - y0


MAP = "struct<type:string,confidence:double,angles:array<double>,cell_w:double,cell_h:double,sections:array<struct<x:int,y:int,w:int,h:int,rows:int,cols:int,grid:array<int>>>>"


def page_map(image: np.ndarray, config: Config = Config()) -> dict:
    """A map's class with the cell codes of each of its sections, row by row."""
    out = classify_map(image, config)
    parts = []
    for s in out["sections"]:
        x, y, w, h = section_bounds(s, out["cell_w"], out["cell_h"], image.shape[1], image.shape[0])
        known = min(out["cell_w"], out["cell_h"]) >= 4
        code = dungeon(image[y : y + h, x : x + w], out["cell_w"], out["cell_h"], config) if known else np.zeros((0, 0), int)
        parts.append({"x": x, "y": y, "w": w, "h": h, "rows": code.shape[0], "cols": code.shape[1], "grid": code.ravel().tolist()})
    return out | {"sections": parts}


def page_maps(pages: DataFrame, image: str = "image", config: Config = Config()) -> DataFrame:
    """``pages`` with a ``map`` for each page image; cells are one row's array until they are exploded."""
    from .layout import image_array

    @F.pandas_udf(MAP)
    def run(images):  # noqa: ANN001, ANN202
        import pandas as pd

        names = ["type", "confidence", "angles", "cell_w", "cell_h", "sections"]
        return pd.DataFrame([page_map(image_array(h, w, n, d), config) for h, w, n, d in zip(images["height"], images["width"], images["nChannels"], images["data"])], columns=names)

    return pages.withColumn("map", run(F.col(image)))
