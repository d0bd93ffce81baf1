"""Near-duplicate vectors by int8 tile products with rigorous error bounds.

Tiles are pieces of the cells of several random partitions of the sphere (cross-polytopes: a rotated vector's cell is
its largest coordinate and that one's sign). Vectors are copied to no other tile, so the work follows the vectors and
their neighbours instead of all pairs of tiles.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import components
from .lsh import Registers, in_blocks, loose_clusters
from .store import Scratch
from .words import mix, small

#: Distinct vectors that a tile holds on average.
TILE = 6000
#: Coordinates of a rotation; its cells by sign and place.
WIDTH = 64
#: Two vectors at a cosine of 0.95 share a rotation's cell with at least this probability (0.60 measured for 8 to 768
#: dimensions, 0.55 for 3), and no partition's cell with at most the probability MISS.
SHARED, MISS = 0.55, 1e-6
#: Rows of a tile multiplied at once, and pairs recomputed at once.
STRIP, PAIRS = 512, 200_000
SLOP = 1e-9


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vector's bytes (doubles), digest and dimension; null where it can link with nothing."""
    for b in batches:
        digest, blob, dim = [], [], []
        for v in b.column("embedding"):
            x = None
            if v.is_valid and len(v.values) and not v.values.null_count:
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if not (np.isfinite(x).all() and np.isfinite(s := float(np.abs(x).max())) and s > 0):
                    x = None
            if x is not None:
                x = x + 0.0  # -0.0 is 0.0
                raw = x.tobytes()
                digest.append(hashlib.blake2b(raw, digest_size=16).digest())
                blob.append(raw)
                dim.append(len(x))
            else:
                digest.append(None)
                blob.append(None)
                dim.append(None)
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(digest, pa.binary()), pa.array(blob, pa.binary()), pa.array(dim, pa.int32())], names=["vec_id", "digest", "blob", "dim"])


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of unit vectors, their scales, the norms of what the codes stand for, and of the error."""
    scale = np.abs(x).max(axis=1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    return q, scale, np.sqrt((back * back).sum(1)) + SLOP, np.sqrt(((x - back) ** 2).sum(1)) + SLOP


def tile_links(xa: np.ndarray, xb: np.ndarray | None, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs with cosine of at least ``least``: rows of xa and xb, or each pair of xa once.

    x.y lies within n_x e_y + e_x n_y + e_x e_y of the product of the codes (n: norm of the decoded vector,
    e: norm of its error), so a pair below ``least`` by more than that is settled by integers alone; sums of
    products of int8 stay below 2^24 up to 1,040 dimensions and are exact in single precision, beyond that
    the rounding is added to the bound.
    """
    ua = unit(xa)
    qa, sa, na, ea = quantise(ua)
    ub, (qb, sb, nb, eb) = (ua, (qa, sa, na, ea)) if xb is None else (unit(xb), quantise(unit(xb)))
    fa, fb = qa.astype(np.float32), qb.astype(np.float32)
    dim = xa.shape[1]
    noise = 0.0 if dim <= 1040 else dim * 127.0 * 127.0 * dim * 6e-8
    smax, nmax, emax = sb.max(), nb.max(), eb.max()
    for s in range(0, len(fa), STRIP):
        rows = slice(s, s + STRIP)
        start = s if xb is None else 0
        g = fa[rows] @ fb[start:].T
        slack = na[rows] * emax + ea[rows] * nmax + ea[rows] * emax
        coarse = np.maximum((least - slack) / (sa[rows] * smax) - noise - 1, -2e9).astype(np.float32)
        i, j = np.nonzero(g >= coarse[:, None])
        i, j = i + s, j + start
        if xb is None:
            i, j = i[i < j], j[i < j]
        for t in range(0, len(i), PAIRS):
            a, b = i[t : t + PAIRS], j[t : t + PAIRS]
            code = g[a - s, b - start].astype(np.float64) + noise
            maybe = code * sa[a] * sb[b] + na[a] * eb[b] + ea[a] * nb[b] + ea[a] * eb[b] >= least
            a, b = a[maybe], b[maybe]
            true = np.einsum("ij,ij->i", ua[a], ub[b]) >= least
            yield a[true], b[true]


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after each link's ends have been given one label, the smallest."""
    while len(a):
        la, lb = label[a], label[b]
        open_ = la != lb
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            nxt = label[label]
            if (nxt == label).all():
                break
            label = nxt
    return label


def partitions(total: int) -> tuple[int, int]:
    """Rotations that one partition combines, so that cells are small for the number of vectors, and partitions."""
    rotations = max(2, math.ceil((math.log2(max(2, total)) + 4) / math.log2(2 * WIDTH)))
    return rotations, math.ceil(math.log(MISS) / math.log(1 - SHARED**rotations))


@functools.lru_cache(maxsize=8)
def rotations(dim: int, count: int) -> np.ndarray:
    """Random directions, WIDTH for each of ``count`` rotations, the same on every executor."""
    rng = np.random.default_rng([20240611, dim])
    out = rng.normal(size=(count, max(dim, WIDTH), WIDTH)).astype(np.float32)
    return np.linalg.qr(out)[0][:, :dim].transpose(1, 0, 2).reshape(dim, -1) if dim >= WIDTH else out[:, :dim].transpose(1, 0, 2).reshape(dim, -1)


def cells(x: np.ndarray, combine: int, count: int) -> np.ndarray:
    """A 64-bit key of each unit vector's cell in each partition; dimension and partition are part of it."""
    turned = (x.astype(np.float32) @ rotations(x.shape[1], combine * count)).reshape(len(x), count, combine, WIDTH)
    top = np.abs(turned).argmax(axis=3)
    cell = (2 * top + (np.take_along_axis(turned, top[..., None], 3)[..., 0] > 0)).astype(np.uint64)
    h = np.arange(count, dtype=np.uint64)[None] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(x.shape[1])
    for k in range(combine):
        h = mix(h * np.uint64(2 * WIDTH + 1) + cell[:, :, k])
    return h.view(np.int64)


class Codes(Registers):
    """Comparison of int8 codes: ``close`` is false only for pairs that the error bounds rule out."""

    def __init__(self, least: float):
        self.least = least

    def table(self, blobs: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(blobs), np.uint8).reshape(len(blobs), -1)

    @staticmethod
    def pack(x: np.ndarray) -> list[bytes]:
        """Scale, norm and error norm in front of the codes of each unit vector."""
        q, scale, norm, error = quantise(x)
        return [h.tobytes() + c.tobytes() for h, c in zip(np.stack([scale, norm, error], axis=1), q)]

    def close(self, x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
        (sx, mx, ex), (sy, my, ey) = (np.ascontiguousarray(v[:, :24]).view(np.float64).T for v in (x, y))
        a, b = x[:, 24:].view(np.int8).astype(np.float64), y[:, 24:].view(np.int8).astype(np.float64)
        product = b @ a[0] if len(a) == 1 else np.einsum("ij,ij->i", a, b)
        return product * sx * sy + mx * ey + ex * my + ex * ey >= self.least


def near_vectors(spark: SparkSession, vectors: DataFrame, *, least: float = 0.95, scratch: Scratch | None = None) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors`` (vec_id LONG, embedding ARRAY<FLOAT or DOUBLE>).

    Vectors with a cosine (double precision) of at least ``least`` (0.95 or more) are linked. Null, empty and zero
    vectors and those with null or non-finite components have no links; vectors of different dimension neither. Equal
    vectors are compared once and counted each; rows with one vec_id count as rows and share a component. A
    null vec_id gets a null component and is kept; other columns are ignored. An empty table gives an empty result.

    Distinct vectors get a cell in each of several random partitions; two vectors at the threshold share none with
    a probability below MISS, nearer ones hardly ever. Those of a cell are compared by int8 codes with its first vector, what
    is then in different clusters with each other, in blocks. A cluster's vectors meet once, in pairs of tiles of bounded size,
    each of which is one task that returns a count for each vector and a spanning forest, never the pairs.
    """
    scratch = scratch or Scratch(spark, "embedding-dedup")
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    seen = scratch.save(base.mapInArrow(_read, "vec_id long, digest binary, blob binary, dim int"))
    sets = seen.where("digest is not null and vec_id is not null").groupBy("digest").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"), F.first("blob").alias("blob"), F.first("dim").alias("dim"))
    # nodes number distinct vectors, because rows may repeat a vec_id with other vectors
    sets = scratch.save(sets.withColumn("node", F.monotonically_increasing_id()))
    combine, count = partitions(sets.count())

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            dims, blobs = b.column("dim").to_numpy(), b.column("blob").to_pylist()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = unit(np.frombuffer(b"".join(blobs[i] for i in at), np.float64).reshape(len(at), d))
                keys = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * count), pa.array(cells(x, combine, count).ravel()))
                yield pa.RecordBatch.from_arrays([b.column("node").take(pa.array(at)), pa.array(dims[at].astype(np.int64)), keys, pa.array(Codes.pack(x), pa.binary())], names=["node", "n", "keys", "regs"])

    placed = scratch.save(sets.select("node", "dim", "blob").mapInArrow(place, "node long, n long, keys array<long>, regs binary"))
    codes = Codes(least)
    clusters, few = loose_clusters(scratch, placed.select("node", F.explode("keys").alias("key")), placed.select("node", "n", "regs"), codes, codes)
    blocks = clusters.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("long").alias("blocks"))
    dealt = in_blocks(clusters.join(blocks, "component").join(sets.select("node", "copies", "blob"), "node"))

    def check(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        x = np.frombuffer(b"".join(table.column("blob").to_pylist()), np.float64).reshape(len(side), -1)
        copies, node = table.column("copies").to_numpy(), table.column("node").to_numpy()
        n, label = np.zeros(len(side), np.int64), np.arange(len(side))
        same = key[1].as_py() == key[2].as_py()
        ia, ib = (np.arange(len(side)), None) if same else (np.flatnonzero(side == side.min()), np.flatnonzero(side != side.min()))
        if same or len(ib):
            for a, b in tile_links(x[ia], None if same else x[ib], least):
                a, b = ia[a], (ia if same else ib)[b]
                np.add.at(n, a, copies[b])
                np.add.at(n, b, copies[a])
                label = merge(label, a, b)
        at = np.flatnonzero(n)
        return pa.table({"node": pa.array(node[at]), "n": pa.array(n[at]), "root": pa.array(node[label[at]])})

    links = scratch.save(dealt.select("component", "i", "j", "side", "node", "copies", "blob").groupBy("component", "i", "j").applyInArrow(check, "node long, n long, root long"))
    # distinct vectors of one vec_id are one vertex
    of_id = sets.select(F.col("node").alias("root"), F.col("vec_id").alias("other"))
    ends = links.join(sets.select("node", "vec_id"), "node").join(of_id, "root").select(F.col("vec_id").alias("a"), F.col("other").alias("b"))
    comp = components(ends, scratch).withColumnRenamed("node", "vec_id")
    counts = links.groupBy("node").agg(F.sum("n").alias("n"))
    of_set = sets.join(counts, "node", "left").join(comp, "vec_id", "left").select("digest", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "vec_id").alias("component"))
    of_set = scratch.save(of_set)
    scratch.drop(placed, clusters, few, links)
    joined = seen.select("vec_id", "digest").join(of_set, "digest", "left")
    cid = F.when(F.col("vec_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "vec_id"))
    out = joined.select("vec_id", F.when(F.col("vec_id").isNull(), F.lit(0)).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"), cid.cast("long").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
