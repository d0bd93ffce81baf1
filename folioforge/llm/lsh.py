"""Groups of similar sets: banding, joint estimates, blocks, exact verification, components.

No bucket is ever gathered into one task. A bucket's members are linked to its smallest member; the links that the
registers do not rule out give loose clusters. A bucket's members outside its largest cluster are then
compared with all others of the bucket by their registers, in blocks of bounded size, and what can be similar joins
its clusters: any two similar sets that share a bucket are in one cluster. A cluster of several blocks is first checked
against its smallest member on full sets; only what is not linked to it is compared with the rest, so that a
family of near-copies costs about one comparison a member.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import sketch
from .graph import components
from .store import Scratch

#: Estimates this far below the threshold can still belong to a pair above it (4 standard errors of 128 registers).
SLACK = 0.16
#: Loose clusters are made of links with at least this estimate.
LOOSE = 0.40
#: Shingles (each member counts 64 more) that a block holds on average.
BLOCK = 60_000
#: Members of a bucket that a block holds on average where their registers are compared.
BUCKET = 1000
LINKS = "a long, b long"


def as_links(links: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


class Registers:
    """Comparison of sets by their registers: ``close`` is false only for pairs estimated below ``least``."""

    def __init__(self, estimate: Callable, least: float):
        self.estimate, self.least = estimate, least

    def table(self, blobs: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(blobs), np.uint16).reshape(len(blobs), -1)

    def close(self, x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
        """For each row of ``y`` whether it can be similar to the row of ``x`` (or to its only row)."""
        ok = (self.least * nx <= ny) & (self.least * ny <= nx) & ((x == y).sum(axis=1) >= (self.least - 0.05) * y.shape[1])
        at = np.flatnonzero(ok)
        if len(at):
            pick = lambda v: v[at] if len(v) == len(y) else np.repeat(v, len(at), axis=0)
            ok[at] = self.estimate(pick(x), y[at], pick(nx), ny[at]) >= self.least
        return ok


def pair_filter(compare: Registers) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, y = b.column("ra").to_pylist(), b.column("rb").to_pylist()
            n1, n2 = b.column("na").to_numpy(), b.column("nb").to_numpy()
            size = np.fromiter(map(len, x), np.int64, len(x))
            keep = np.zeros(len(x), bool)
            for s in np.unique(size):
                at = np.flatnonzero(size == s)
                keep[at] = compare.close(compare.table([x[i] for i in at]), compare.table([y[i] for i in at]), n1[at], n2[at])
            at = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([b.column("a").take(at), b.column("b").take(at)], names=["a", "b"])

    return run


def across(table: pa.Table, compare: Registers) -> list[tuple[int, int]]:
    """Links of the clusters of a bucket's block and of some members outside its main cluster that hold a close pair."""
    names, cluster = np.unique(table.column("component").to_numpy(), return_inverse=True)
    minor, n = table.column("minor").to_numpy(zero_copy_only=False), table.column("n").to_numpy()
    regs = compare.table(table.column("regs").to_pylist())
    rest = np.flatnonzero(~minor)
    links = []
    for i in np.flatnonzero(minor).tolist():
        js = rest[cluster[rest] != cluster[i]]
        if len(js):
            js = js[compare.close(regs[i : i + 1], regs[js], n[i : i + 1], n[js])]
            for c in np.unique(cluster[js]).tolist():
                links.append((int(names[cluster[i]]), int(names[c])))
                cluster[cluster == c] = cluster[i]
    return links


def against(members: DataFrame, key: str, size: Column, least: int) -> DataFrame:
    """Rows dealt to ``key, i, j`` so that each block i of minor members meets each block j of all.

    ``members`` has key, node and minor (BOOLEAN); blocks hold ``least`` of the sums of ``size`` on average. In the result
    ``minor`` tells in which role a row came: minor members come in both.
    """
    per = members.groupBy(key).agg(F.ceil(F.sum(F.when(F.col("minor"), size)) / least).cast("long").alias("few"), F.ceil(F.sum(size) / least).cast("long").alias("all"))
    dealt = members.join(per.where("few > 0"), key)
    mine = lambda blocks: F.pmod(F.xxhash64("node"), F.col(blocks))
    every = lambda blocks: F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)
    role = lambda minor, i, j: F.struct(F.lit(minor).alias("minor"), i.alias("i"), j.alias("j"))
    first = F.when(F.col("minor"), F.transform(every("all"), lambda j: role(True, mine("few"), j))).otherwise(F.array().cast("array<struct<minor:boolean,i:bigint,j:bigint>>"))
    second = F.transform(every("few"), lambda i: role(False, i, mine("all")))
    rows = dealt.withColumn("_to", F.explode(F.concat(first, second))).drop("minor", "few", "all")
    return rows.select("*", "_to.minor", "_to.i", "_to.j").drop("_to")


def in_blocks(members: DataFrame) -> DataFrame:
    """Each member once for every pair ``i, j`` of its group's ``blocks`` that its own block, ``side``, is in."""
    mine = F.pmod(F.xxhash64("node"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = members.withColumn("side", mine.cast("long")).withColumn("other", other)
    return dealt.withColumn("i", F.least("side", "other")).withColumn("j", F.greatest("side", "other"))


def loose_clusters(scratch: Scratch, rows: DataFrame, sketches: Callable[[DataFrame], DataFrame] | DataFrame, hubs_by: Registers, others_by: Registers, *, size: Column | None = None, bucket: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``node, component`` of what may be similar, and ``node, n, regs`` of all that share a bucket.

    ``rows``: node LONG and key LONG, one for each band of each set, and at will home LONG, a document that has the
    node; rows with a home may repeat node and key. ``sketches``: node, n LONG, regs BINARY, repeats allowed, or a function that gives them for a table of nodes
    (with the smallest home of each). A block of a bucket holds
    ``bucket`` members on average, or so much of the sums of ``size``.
    """
    whole = Window.partitionBy("key")  # all rows are dealt once
    met = rows.withColumn("hub", F.min("node").over(whole)).withColumn("hi", F.max("node").over(whole)).where("hub < hi").drop("hi")
    shared = scratch.save(met.groupBy("key", "hub", "node").agg(F.min("home").alias("home")) if "home" in rows.columns else met)
    scratch.drop()  # shuffle files of all bands
    pairs = scratch.save(shared.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct())
    wanted = shared.groupBy("node").agg(F.min("home").alias("home")) if "home" in rows.columns else shared.select("node").distinct()
    wanted = wanted if isinstance(sketches, DataFrame) else scratch.save(wanted)
    given = sketches.join(wanted, "node") if isinstance(sketches, DataFrame) else sketches(wanted)
    few = scratch.save(given.groupBy("node").agg(F.max("n").alias("n"), F.first("regs").alias("regs")))
    scratch.drop(wanted)
    side = lambda x: few.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("regs").alias(f"r{x}"))
    loose = scratch.save(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(pair_filter(hubs_by), LINKS))
    scratch.drop(pairs)
    clusters = scratch.save(components(loose, scratch))

    # the hub is compared with every member, so only the others can have met no one; most are in the main cluster
    others = shared.where("node <> hub").select("key", "node").join(clusters, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    others = scratch.save(others)
    sizes = others.groupBy("key", "component").agg(F.count(F.lit(1)).alias("m"))
    mixed = sizes.groupBy("key").agg(F.max_by("component", F.struct("m", "component")).alias("main"), F.count(F.lit(1)).alias("clusters")).where("clusters > 1").drop("clusters")
    others_of = others.join(mixed, "key").withColumn("minor", F.col("component") != F.col("main"))
    met = against(others_of.join(few, "node"), "key", F.lit(1) if size is None else size, bucket or BUCKET).select("key", "i", "j", "minor", "component", "n", "regs")
    more = scratch.save(met.groupBy("key", "i", "j").applyInArrow(lambda t: as_links(across(t, others_by)), LINKS))
    if not more.isEmpty():
        scratch.drop(clusters)
        clusters = scratch.save(components(loose.unionByName(more), scratch))
    scratch.drop(shared, others, loose, more)
    return clusters, few


class Forest:
    """Links of the similar sets among members of a cluster; pairs inside one tree are not looked at."""

    def __init__(self, threshold: tuple[int, int], estimate: Callable, slack: float):
        self.part, self.whole = threshold
        self.compare = Registers(estimate, self.part / self.whole - slack)

    def links(self, table: pa.Table, pairs: str) -> list[tuple[int, int]]:
        """``pairs``: "all", "minor" (a minor role and another) or "hub" (the hub and another)."""
        nodes, n = table.column("node").to_numpy(), table.column("n").to_numpy()
        regs = self.compare.table(table.column("regs").to_pylist())
        packed = table.column("sh").to_pylist()
        first = np.ones(len(nodes), bool) if pairs == "all" else table.column("minor").to_numpy(zero_copy_only=False)
        tree = table.column("tree").to_numpy() if "tree" in table.column_names else nodes
        sets: dict[int, frozenset] = {}
        names, up = np.unique(tree, return_inverse=True)
        root = list(range(len(names)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        def full(i: int) -> frozenset:
            if i not in sets:
                sets[i] = frozenset(np.frombuffer(packed[i], np.uint64).tolist())
            return sets[i]

        out = []
        rest = np.arange(len(nodes)) if pairs == "all" else np.flatnonzero(~first)
        order = np.argsort(-n, kind="stable")
        rank = np.empty(len(nodes), np.int64)
        rank[order] = np.arange(len(nodes))
        for i in order[first[order]].tolist():
            js = rest[rank[rest] > rank[i]] if pairs == "all" else rest
            js = js[(self.whole * n[js] >= self.part * n[i]) & (self.whole * n[i] >= self.part * n[js])]
            mine = find(up[i])
            js = np.fromiter((j for j in js.tolist() if find(up[j]) != mine), np.int64)
            if not len(js):
                continue
            for j in js[self.compare.close(regs[i : i + 1], regs[js], n[i : i + 1], n[js])].tolist():
                if (rj := find(up[j])) == (ri := find(up[i])):
                    continue
                inter = len(full(i) & full(j))
                if self.whole * inter >= self.part * (int(n[i]) + int(n[j]) - inter):
                    root[max(ri, rj)] = min(ri, rj)
                    out.append((int(nodes[i]), int(nodes[j])))
        return out


def similar(scratch: Scratch, rows: DataFrame, sketches: DataFrame, packed: Callable[[DataFrame], DataFrame], *, estimate: Callable = sketch.joint_estimate, slack: float = SLACK, threshold: tuple[int, int] = (75, 100)) -> DataFrame:
    """``node, component`` for every set that is linked with another.

    ``rows`` and ``sketches`` as for ``loose_clusters``. ``packed`` takes a table of distinct nodes and returns
    ``node, sh`` with the sets' sorted shingles as little-endian 64-bit words, a row each.
    """
    forest = Forest(threshold, estimate, slack)
    clusters, few = loose_clusters(scratch, rows, sketches, Registers(estimate, LOOSE), forest.compare)
    members = clusters.join(few, "node")
    size = F.col("n") + 64
    blocks = clusters.join(few.select("node", "n"), "node").groupBy("component").agg(F.ceil(F.sum(size) / BLOCK).cast("long").alias("blocks"))
    members = members.join(blocks, "component").join(packed(clusters.select("node")), "node")
    members = scratch.save(members.select("component", "blocks", "node", "n", "regs", "sh"))

    one = members.where("blocks = 1").groupBy("component").applyInArrow(lambda t: as_links(forest.links(t, "all")), LINKS)
    large = members.where("blocks > 1")
    # the smallest member, once for each block, and the others
    hub = large.where("node = component").withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumn("minor", F.lit(True))
    rest = large.where("node <> component").withColumn("i", F.pmod(F.xxhash64("node"), F.col("blocks"))).withColumn("minor", F.lit(False))
    first = scratch.save(hub.unionByName(rest).groupBy("component", "i").applyInArrow(lambda t: as_links(forest.links(t, "hub")), LINKS))
    linked = first.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("linked", F.lit(True))
    left = large.join(linked, "node", "left").withColumn("minor", F.col("linked").isNull() & (F.col("node") != F.col("component"))).drop("linked")
    left = left.withColumn("tree", F.when(F.col("minor"), F.col("node")).otherwise(F.col("component")))
    dealt = against(left, "component", size, BLOCK).select("component", "i", "j", "minor", "node", "tree", "n", "regs", "sh")
    more = dealt.groupBy("component", "i", "j").applyInArrow(lambda t: as_links(forest.links(t, "minor")), LINKS)

    links = scratch.save(one.unionByName(first).unionByName(more))
    out = components(links, scratch)
    scratch.drop(clusters, few, members, first, links)
    return out
