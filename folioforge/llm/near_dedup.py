"""Near-duplicate documents by SetSketch registers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sketch
from .lsh import similar
from .store import Scratch
from .words import WordHashes, shingles, small, split_words, word_hashes

#: Four registers a band, 32 bands: a pair at 0.75 is missed once in 200,000.
ROWS, BANDS = 4, 32
#: Node ids are broadcast for the second read of the texts only up to this many.
BROADCAST_IDS = 500_000


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for b in small(batches):
        ids, n, sid, regs, bands = b.column("doc_id"), [], [], [], []
        for text in b.column("text").to_pylist():
            sh = shingles(word_hashes(split_words(text), known))
            n.append(len(sh))
            if len(sh):
                r = sketch.set_sketch(sh)
                sid.append(hashlib.blake2b(sh.tobytes(), digest_size=16).digest())
                regs.append(r.tobytes())
                bands.append(sketch.bands(r, ROWS, BANDS))
            else:
                sid.append(None)
                regs.append(None)
                bands.append(None)
        yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(sid, pa.binary()), pa.array(regs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "n", "sid", "regs", "bands"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for b in small(batches):
        sh = [shingles(word_hashes(split_words(t), known)).tobytes() for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(sh, pa.binary())], names=["node", "sh"])


def near_duplicates(spark: SparkSession, docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs`` (doc_id LONG, text STRING, any other columns).

    Documents whose sets of distinct five-word shingles have a Jaccard similarity of at least 0.75 are
    linked; the component's id is the smallest doc_id reachable. Null and blank texts have an empty set and
    stand alone; fewer than five words are one shingle; equal sets are one set however often they occur;
    rows that share a doc_id are one node with several sets; a null doc_id stands alone with a null
    component and is kept. An empty table gives an empty result.
    """
    scratch = scratch or Scratch(spark, "near-dedup")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    seen = scratch.save(base.mapInArrow(_sketch, "doc_id long, n long, sid binary, regs binary, bands array<long>"))
    sets = scratch.save(seen.where("sid is not null and doc_id is not null").groupBy("sid").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("regs").alias("regs"), F.first("bands").alias("bands")))

    def packed(nodes: DataFrame) -> DataFrame:
        ids = nodes.select(F.col("node").alias("doc_id"))
        if ids.count() <= BROADCAST_IDS:
            ids = F.broadcast(ids)
        return base.join(ids, "doc_id", "left_semi").select(F.col("doc_id").alias("node"), "text").mapInArrow(_pack, "node long, sh binary")

    linked = similar(scratch, sets.select("node", F.explode("bands").alias("key")), sets.select("node", "n", "regs"), packed)
    of_set = scratch.save(sets.select("sid", "node").join(linked, "node", "left").select("sid", F.coalesce("component", "node").alias("component")))
    joined = seen.select("doc_id", F.col("n").alias("n_shingles"), "sid").join(of_set, "sid", "left")
    comp = F.when(F.col("doc_id").isNull() | F.col("sid").isNull() | F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return joined.select("doc_id", "n_shingles", comp.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(spark: SparkSession, docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """The rows of ``docs``, with their columns, that are the first document of their component.

    Rows that share the kept doc_id, and rows with a null doc_id, all stay.
    """
    found = near_duplicates(spark, docs, scratch)
    gone = found.where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("_gone"), "left_anti")
