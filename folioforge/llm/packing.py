"""Packing of documents into windows by lexical retrieval."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .store import Scratch
from .words import mix, small

#: Tokens of document ends that one shard of the index holds, and that one task reads on average; most tasks.
SHARD, TASK, TASKS = 1_200_000, 4_800_000, 20_000
#: BM25's saturation and length weights.
K1, B = 1.2, 0.75
#: Keys by which documents are sent to shards.
KEYS = 4
#: Neighbours that are ranked at once.
AT_ONCE = 16
#: Ids of sequences that hold parts of several documents start here.
MIXED = 1 << 62
STOP_ID = 0


def idf_of(df: np.ndarray, n: int) -> np.ndarray:
    return np.log1p((n - df + 0.5) / (df + 0.5))


class Index:
    """BM25 over the ids of a shard's texts, with the idf of the whole corpus."""

    def __init__(self, texts: list[np.ndarray], idf: np.ndarray, mean_length: float):
        self.n = len(texts)
        length = np.array([len(t) for t in texts])
        doc = np.repeat(np.arange(self.n, dtype=np.int64), length)
        flat = np.concatenate(texts).astype(np.int64) if self.n else np.empty(0, np.int64)
        keys, tf = np.unique((flat << 24) | doc, return_counts=True)
        self.post = (keys & 0xFFFFFF).astype(np.int64)
        self.ids, self.first, self.df = np.unique(keys >> 24, return_index=True, return_counts=True)
        norm = K1 * (1 - B + B * length / max(1.0, mean_length))
        weight = np.repeat(idf[self.ids], self.df) * tf * (K1 + 1) / (tf + norm[self.post])
        self.weight = weight.astype(np.float32)
        # ids that many texts have are rows of a dense table, which add up faster than postings
        common = np.flatnonzero(self.df > max(8, self.n // 8))
        self.row = np.full(len(self.ids), -1)
        self.row[common] = np.arange(len(common))
        self.dense = np.zeros((len(common), self.n), np.float32)
        for r, i in enumerate(common):
            at = slice(self.first[i], self.first[i] + self.df[i])
            self.dense[r, self.post[at]] = self.weight[at]

    def scores(self, text: np.ndarray) -> np.ndarray:
        """The score of each text against all ids of ``text`` that another one has."""
        at = np.searchsorted(self.ids, np.unique(text))
        at = at[self.df[at] > 1]
        rows = self.row[at]
        out = self.dense[rows[rows >= 0]].sum(axis=0, dtype=np.float64) if (rows >= 0).any() else np.zeros(self.n)
        rare = at[rows < 0]
        if len(rare):
            many = self.df[rare]
            where = np.repeat(self.first[rare] - np.cumsum(many) + many, many) + np.arange(many.sum())
            out += np.bincount(self.post[where], self.weight[where], self.n)
        return out


def order_and_cut(index: Index, texts: list[np.ndarray], window: int) -> Iterator[tuple[int, int, int, int, int]]:
    """``text, start, length, sequence, offset`` of each piece; all windows but the last are full.

    A seed is followed by the unused texts that the index scores highest (of equals the first), as many as it takes; the
    one that does not fit is cut and its rest becomes the next window's seed. Without a match the next text in order follows.
    """
    free, nxt, seq, at = np.ones(len(texts), bool), 0, 0, 0
    ranked: list[int] = []
    score: np.ndarray | None = None
    for _ in range(len(texts)):
        if score is not None and not ranked:
            s = np.where(free, score, 0.0)
            least = np.partition(s, -AT_ONCE)[-AT_ONCE] if len(s) > AT_ONCE else 0.0
            best = np.flatnonzero((s >= least) & (s > 0))
            ranked = best[np.argsort(-s[best], kind="stable")][::-1].tolist()
        if ranked:
            i = ranked.pop()
        else:
            while not free[nxt]:
                nxt += 1
            i = nxt
        free[i] = False
        start = 0
        while start < len(texts[i]):
            take = min(window - at, len(texts[i]) - start)
            yield i, start, take, seq, at
            start, at = start + take, at + take
            if at == window:
                seq, at, ranked, score = seq + 1, 0, [], None
        if score is None and at:
            score = index.scores(texts[i])


def routes(df: np.ndarray, n: int) -> np.ndarray:
    """For each of KEYS keys and each id a value of which a text's smallest is the key: two texts share one with the
    probability of their ids' Jaccard similarity, weighted by idf. Ids of a single text come last."""
    h = mix(np.arange(len(df), dtype=np.uint64)[None] + np.arange(1, KEYS + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15))
    u = ((h >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53
    return np.where(df > 1, -np.log(u) / np.maximum(idf_of(df, n), 1e-9), np.inf)


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, *, ranks: tuple[str, str] | None = None, window: int = 1024, scratch: Scratch | None = None) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``docs`` has doc_id and text, and any other columns. A document is its text's ids and then id 0, so null
    and empty texts are one token; rows with one doc_id are packed apart; an empty table gives no pieces.
    ``ids`` holds little-endian unsigned 32-bit ids. Whole windows of a long document are sequences of their own; its
    rest is sent to a shard by keys drawn from its ids, weighted by their rarity in the whole corpus, so that texts that
    share rare ids meet; hot keys are split, shards being cut by size from the sorted order. A shard's BM25 index, with the idf
    of the whole corpus, returns the unused rests most like a seed, which fill its window; of equal scores the
    first in order is taken. Only a shard's last sequence can be short.
    """
    scratch = scratch or Scratch(spark, "packing")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            ids = [np.append(tokens.encode(t, tokenizer, ranks), np.uint32(STOP_ID)) for t in b.column("text").to_pylist()]
            wide = [4 if x.max() > 65535 else 2 for x in ids]
            raw = [x.astype(f"<u{w}").tobytes() for x, w in zip(ids, wide)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()), pa.array(wide, pa.int32()), pa.array(raw, pa.binary())], names=["doc_id", "n", "wide", "raw"])

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    coded = scratch.save(base.mapInArrow(encode, "doc_id long, n long, wide int, raw binary"), "zstd")
    pieces = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small(batches):
            row, start, ids = [], [], []
            for r, (n, w, raw) in enumerate(zip(b.column("n").to_pylist(), b.column("wide").to_pylist(), b.column("raw").to_pylist())):
                x = np.frombuffer(raw, f"<u{w}").astype("<u4")
                for s in range(0, n - window + 1, window):
                    row.append(r)
                    start.append(s)
                    ids.append(x[s : s + window].tobytes())
            took = b.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([took.column("doc_id"), pa.array(start, pa.int64()), pa.array([window] * len(row), pa.int64()), pa.array(ids, pa.binary()), took.column("n"), pa.array([0] * len(row), pa.int64()), pa.array([0] * len(row), pa.int64())], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    heads = coded.where(F.col("n") >= window).mapInArrow(whole, pieces).withColumn("sequence_id", F.monotonically_increasing_id())
    done = F.col("n") - F.col("n") % window
    rest = F.expr("substring(raw, cast((n - n % {0}) * wide + 1 as int), cast((n % {0}) * wide as int))".format(window))
    tails = coded.where(F.col("n") % window > 0).select("doc_id", "n", done.alias("done"), "wide", rest.alias("raw"))

    def texts_in(b: pa.RecordBatch | pa.Table) -> list[np.ndarray]:
        return [np.frombuffer(x, f"<u{w}").astype("<u4") for x, w in zip(b.column("raw").to_pylist(), b.column("wide").to_pylist())]

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(0, np.int64)
        for b in batches:
            for t in texts_in(b):
                n = np.bincount(np.unique(t))
                if len(n) > len(df):
                    df = np.pad(df, (0, len(n) - len(df)))
                df[: len(n)] += n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["id", "df"])

    size = tails.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("n") - F.col("done")), F.lit(0)).alias("tokens")).head()
    found = tails.select("wide", "raw").mapInArrow(frequencies, "id long, df long").groupBy("id").agg(F.sum("df").alias("df")).toArrow()  # the tokenizer's ids at most
    df = np.zeros(1 + max(found.column("id").to_pylist(), default=0), np.int64)
    df[found.column("id").to_numpy()] = found.column("df").to_numpy()
    stats = spark.sparkContext.broadcast((idf_of(df, size.n), routes(df, size.n).astype(np.float32), size.tokens / max(1, size.n)))  # a row for each id

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = stats.value[1]
        for b in batches:
            keys = np.zeros((b.num_rows, KEYS), np.int32)
            for r, t in enumerate(texts_in(b)):
                ids = np.unique(t)
                keys[r] = ids[value[:, ids].argmin(axis=1)]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(keys[:, k]) for k in range(KEYS))], names=[*b.schema.names, *(f"k{k}" for k in range(KEYS))])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, _, mean = stats.value
        first = MIXED + (TaskContext.get().partitionId() << 40)
        held, tokens_held = [], 0

        def shard() -> Iterator[pa.RecordBatch]:
            nonlocal first
            t = pa.Table.from_batches(held)
            texts = texts_in(t)
            got = np.array(list(order_and_cut(Index(texts, idf, mean), texts, window)), np.int64).reshape(-1, 5)
            doc, start, length, seq, at = got.T
            took = t.select(["doc_id", "n", "done"]).take(pa.array(doc))
            ids = [texts[i][s : s + k].tobytes() for i, s, k in zip(doc.tolist(), start.tolist(), length.tolist())]
            out = pa.table({"doc_id": took.column("doc_id"), "start": pa.array(took.column("done").to_numpy() + start), "length": pa.array(length), "ids": pa.array(ids, pa.binary()), "doc_tokens": took.column("n"), "sequence_id": pa.array(first + seq), "offset": pa.array(at)})
            first += int(seq.max()) + 1
            yield from out.combine_chunks().to_batches()

        for b in batches:
            size = b.column("n").to_numpy() - b.column("done").to_numpy()
            place, last = (tokens_held + np.cumsum(size) - 1) // SHARD, 0
            for cut in np.flatnonzero(np.diff(place, prepend=0)).tolist():  # rows that begin a shard
                held.append(b.slice(last, cut - last))
                if any(x.num_rows for x in held):
                    yield from shard()
                held, last = [], cut
            held.append(b.slice(last))
            tokens_held = int(tokens_held + size.sum()) % SHARD if len(size) else tokens_held
        if any(x.num_rows for x in held):
            yield from shard()

    keys = [f"k{k}" for k in range(KEYS)]
    tasks = int(np.clip(-(-size.tokens // TASK), 1, TASKS))
    routed = tails.mapInArrow(route, tails.schema.simpleString()[7:-1].replace(":", " ") + "".join(f", {k} int" for k in keys))
    routed = routed.repartitionByRange(tasks, *keys, F.xxhash64("doc_id", "raw")).sortWithinPartitions(*keys, F.xxhash64("doc_id", "raw"), "n")
    mixed = routed.select("doc_id", "n", "done", "wide", "raw").mapInArrow(fill, pieces)
    return heads.unionByName(mixed)
