"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import Scratch, bounded_sample

#: 2^BITS coordinates; the last one is the bias.
BITS = 20
#: Learning rate and its offset, L1 and L2 strengths, passes.
ALPHA, BETA, L1, L2, PASSES = 1.0, 1.0, 6.0, 0.1, 3
#: The bound on labelled rows that the model is fitted to (those with the smallest hash of their id).
MAX_LABELLED = 20_000
EDGES = bytes(range(33, 48)) + b":;<=>?@[\\]^_`{|}~"


class Stems(dict):
    """Hashes of a lower-cased word without marks at its ends: the word's, and of its first 4 and 5 letters.

    Inflected forms share the beginnings. Emptied when large, which changes no result.
    """

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= 300_000:
            self.clear()
        bare = word.strip(EDGES)
        text = bare.decode("utf-8", "surrogatepass")
        four, five = (xxhash.xxh32_intdigest(text[:k].encode("utf-8", "surrogatepass"), k) for k in (4, 5))
        self[word] = h = (xxhash.xxh32_intdigest(bare), four << 32 | five)
        return h


def features(text: str | None, known: Stems) -> np.ndarray:
    """Coordinates of the words and their beginnings, of pairs of neighbours and of pairs one word apart, with repeats."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    both = np.array([known[w] for w in words], np.uint64).reshape(-1, 2)
    h, begin = both[:, 0], both[:, 1]

    def place(x: np.ndarray, kind: int) -> np.ndarray:
        x = (x ^ np.uint64(kind * 0x9E37)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        return ((x * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)).astype(np.int32)

    pair = lambda gap: h[:-gap] * np.uint64(0x100000001B3) + h[gap:] * np.uint64(0xC2B2AE3D27D4EB4F)
    out = np.concatenate([place(h, 1), place(begin >> np.uint64(32), 4), place(begin & np.uint64(0xFFFFFFFF), 5), place(pair(1), 2), place(pair(2), 3)])
    return np.minimum(out, (1 << BITS) - 2)


def fit(rows: Iterator[tuple[np.ndarray, int]], passes: int = PASSES, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Nonzero coordinates and weights, learnt from (coordinates, label) pairs.

    FTRL-proximal: each coordinate has its own rate alpha / (beta + sqrt(sum of squared gradients)), and is
    exactly zero while its accumulated gradient stays within the L1 strength.
    """
    bias = (1 << BITS) - 1
    data = [(np.append(np.unique(x), bias), y) for x, y in rows]
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)

    def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))

    rng = np.random.default_rng(seed)
    for _ in range(passes):
        for k in rng.permutation(len(data)):
            x, y = data[k]
            zi, ni = z[x], n[x]
            w = weights(zi, ni)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            more = ni + g * g
            z[x] = zi + g - (np.sqrt(more) - np.sqrt(ni)) / ALPHA * w
            n[x] = more
    w = weights(z, n)
    at = np.flatnonzero(w)
    return at.astype(np.int32), w[at].astype(np.float32)


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, *, folds: int = 5, bound: int = MAX_LABELLED, scratch: Scratch | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights from labelled rows outside the held-out fold (crc32 of the id as text, modulo ``folds``, is 0)."""
    scratch = scratch or Scratch(spark, "toxicity")
    known = labels.where("doc_id is not null and toxic in (0, 1)").select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.crc32(F.col("id").cast("string")) % folds != 0).groupBy("id").agg(F.max("toxic").alias("toxic"))
    known = scratch.save(bounded_sample(known, F.xxhash64("id"), bound))  # the documented bound
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).join(F.broadcast(known), "id")
    rows = scratch.save(rows)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stems = Stems()

        found = []
        for b in batches:
            for i, text, y in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                found.append((i, np.unique(features(text, stems)), y))
        found.sort(key=lambda r: r[0])  # so that weights do not depend on how the rows were dealt out
        at, w = fit((x, y) for _, x, y in found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w)], names=["at", "w"])

    got = rows.select("id", "text", "toxic").coalesce(1).mapInArrow(learn, "at int, w float").toArrow()
    return got.column("at").to_numpy(), got.column("w").to_numpy()


def score(spark: SparkSession, docs: DataFrame, weights: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``docs`` with ``score``, the probability of label 1, from the whole text alone; other columns are kept."""
    sent = spark.sparkContext.broadcast(weights)  # at most 2^BITS pairs

    @F.pandas_udf(T.DoubleType())
    def probability(texts):  # noqa: ANN001, ANN202
        import pandas as pd

        at, w = sent.value
        dense = np.zeros(1 << BITS, np.float32)
        dense[at] = w
        bias, stems, out = float(dense[-1]), Stems(), np.empty(len(texts))
        for i, t in enumerate(texts):
            x = features(t, stems)
            hit = x[dense[x] != 0]
            out[i] = bias + float(dense[np.unique(hit)].sum(dtype=np.float64))
        return pd.Series(1 / (1 + np.exp(-np.clip(out, -700, 700))))

    return docs.drop("score").withColumn("score", probability(F.col("text").cast("string")))


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``.

    Labels are learnt only from rows whose crc32 of the id as text is not 0 modulo 5; conflicting labels of an
    id count as toxic. A score depends on the text alone: null and empty texts get the bias' score. A null
    doc_id is not held out. Without labels all scores are 0.5. An empty table gives an empty result.
    """
    w = train(spark, docs, labels)
    out = score(spark, docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), w)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
