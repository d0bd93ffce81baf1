"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import Scratch
from .words import WordHashes, ngrams, split_words, word_hashes

#: Words of a seed; items with fewer words than LEAST cannot be told from chance and match nothing.
SEED, LEAST = 3, 5
#: Seeds of one item that must lie in one window.
HITS = 2
#: Gains and costs of the alignment, and the least share of an item's full score.
MATCH, MISMATCH, GAP, SHARE = 2, -1, -1, 0.5
#: Items of one pass over the documents, so that what is broadcast is bounded however large the benchmark is.
ITEMS = 20_000
FOUND = "array<struct<item_id:bigint,score:double,start:int,length:int>>"


def smith_waterman(windows: np.ndarray, items: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment scores of pairs of rows, and the first and last column (exclusive) they span.

    ``windows`` (pairs x w) and ``items`` (pairs x m) hold word hashes, items being padded past ``lengths``.
    Rows of the matrix are filled at once for all pairs: with a cost in proportion to a gap's length the best gap
    within a row is a running maximum.
    """
    n, w = windows.shape
    slope = np.arange(w + 1, dtype=np.int32) * -GAP
    h = np.zeros((n, w + 1), np.int32)
    begin = np.broadcast_to(np.arange(w + 1, dtype=np.int32), (n, w + 1)).copy()
    best, first, last = np.zeros(n, np.int32), np.zeros(n, np.int32), np.zeros(n, np.int32)
    row, zero = np.arange(n), np.arange(w + 1, dtype=np.int32)
    for i in range(items.shape[1]):
        live = i < lengths
        gain = np.where(windows == items[:, i : i + 1], MATCH, MISMATCH).astype(np.int32)
        diag = np.concatenate([np.zeros((n, 1), np.int32), h[:, :-1] + gain], axis=1)
        up = h + GAP
        new = np.maximum(diag, up)
        came = np.where(diag >= up, np.concatenate([begin[:, :1], begin[:, :-1]], axis=1), begin)
        came = np.where(new <= 0, zero, came)
        new = np.maximum(new, 0)
        lifted = new + slope
        run = np.maximum.accumulate(lifted, axis=1)
        at = np.maximum.accumulate(np.where(lifted == run, zero, 0), axis=1)
        came = np.take_along_axis(came, at, 1)
        h = np.where(live[:, None], run - slope, 0)
        begin = came
        j = h.argmax(1)
        top = h[row, j]
        better = top > best
        best, first, last = np.where(better, top, best), np.where(better, begin[row, j], first), np.where(better, j, last)
    return best, first, last


class Items:
    """A block of benchmark items and the n-grams that point to them."""

    def __init__(self, ids: list[int], texts: list[str | None]):
        known = WordHashes()
        self.ids, self.words, gram, item, place = [], [], [], [], []
        for i, t in sorted({(i, t) for i, t in zip(ids, texts) if i is not None and t}):
            h = word_hashes(split_words(t), known)
            if len(h) >= LEAST:
                g = ngrams(h, SEED)
                gram.append(g)
                item.append(np.full(len(g), len(self.ids)))
                place.append(np.arange(len(g)))
                self.ids.append(i)
                self.words.append(h)
        cat = lambda x, kind: np.concatenate(x).astype(kind) if x else np.empty(0, kind)
        self.size = np.array([len(w) for w in self.words], np.int64)
        gram, item, place = cat(gram, np.uint64), cat(item, np.int32), cat(place, np.int32)
        order = np.argsort(gram, kind="stable")
        self.gram, self.item, self.place = gram[order], item[order], place[order]
        self.keys = np.unique(self.gram)
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.keys >> np.uint64(42)).astype(np.int64)] = True
        self.lo = np.searchsorted(self.gram, self.keys)
        self.hi = np.searchsorted(self.gram, self.keys, side="right")

    def among(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``g`` of the items' n-grams, and which they are."""
        at = np.flatnonzero(self.bits[(g >> np.uint64(42)).astype(np.int64)])
        if not len(self.keys) or not len(at):
            return at[:0], at[:0]
        k = np.minimum(np.searchsorted(self.keys, g[at]), len(self.keys) - 1)
        ok = self.keys[k] == g[at]
        return at[ok], k[ok]

    def windows(self, h: np.ndarray) -> list[tuple[int, int, int]]:
        """``item, from, to`` of the parts of a text that have enough seeds of an item."""
        at, k = self.among(ngrams(h, SEED))
        if len(at) < HITS:
            return []
        many = self.hi[k] - self.lo[k]
        pos = np.repeat(at, many)
        entry = np.repeat(self.lo[k], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        item = self.item[entry]
        start = pos - self.place[entry]  # where the item would begin
        order = np.lexsort((start, item))
        item, start = item[order], start[order]
        size = self.size[item]
        near = (item[HITS - 1 :] == item[: 1 - HITS]) & (start[HITS - 1 :] - start[: 1 - HITS] <= size[: 1 - HITS])
        out, done = [], 0
        for i in np.flatnonzero(near).tolist():
            if i < done:
                continue
            m, last = int(size[i]), int(np.searchsorted(item, item[i], side="right"))
            done = i + int(np.searchsorted(start[i:last], start[i] + m, side="right"))
            # the seeds of a place that begins in this group can go on for another m words
            reach = i + int(np.searchsorted(start[i:last], start[done - 1] + m, side="right"))
            a, b = max(0, int(start[i]) - m // 4), min(len(h), int(start[reach - 1]) + m + m // 4)
            if self.can_match(int(item[i]), h[a:b]):
                out.append((int(item[i]), a, b))
        return out

    def can_match(self, i: int, part: np.ndarray) -> bool:
        """False only if too few of the item's words are in a part of a text for any alignment to be good enough."""
        m = len(self.words[i])
        return len(part) >= SHARE * m and np.isin(self.words[i], part).sum() >= SHARE * m


def best_alignments(items: Items, jobs: list[tuple[int, int, int, np.ndarray]]) -> Iterator[tuple[int, float, int, int]]:
    """``job, share, start, length`` of the windows (text, item, offset, words) that align well enough."""
    ranked = sorted(range(len(jobs)), key=lambda j: (len(items.words[jobs[j][1]]), len(jobs[j][3])))
    at = 0
    while at < len(ranked):
        end, first_size = at, len(jobs[ranked[at]][3])
        while end < len(ranked) and (end == at or (end - at + 1) * (size := len(jobs[ranked[end]][3])) <= 400_000 and size <= 2 * first_size + 16):
            end += 1
        part = [jobs[j] for j in ranked[at:end]]
        w, m = max(len(j[3]) for j in part), max(len(items.words[j[1]]) for j in part)
        a, b = np.zeros((len(part), w), np.uint64), np.ones((len(part), m), np.uint64)
        for r, (_, i, _, x) in enumerate(part):
            a[r, : len(x)] = x
            b[r, : len(items.words[i])] = items.words[i]
        n = np.array([len(items.words[j[1]]) for j in part])
        best, first, last = smith_waterman(a, b, n)
        for r in np.flatnonzero(best >= SHARE * MATCH * n):
            yield ranked[at + r], float(best[r] / (MATCH * n[r])), int(first[r]), int(last[r] - first[r])
        at = end


def align(items: Items, jobs: list[tuple[int, int, int, np.ndarray]]) -> Iterator[tuple[int, int, float, int, int]]:
    """``text, item, share, start, length`` of the places in windows (text, item, offset, words) that align well enough.

    What is left of a window before and after a place is searched again; of places that overlap the best stays.
    """
    places: dict[tuple[int, int], list[tuple[float, int, int]]] = {}
    while jobs:
        rest = []
        for j, share, start, length in best_alignments(items, jobs):
            text, i, offset, x = jobs[j]
            places.setdefault((text, i), []).append((-share, offset + start, length))
            for at, left in ((offset, x[:start]), (offset + start + length, x[start + length :])):
                if items.can_match(i, left):
                    rest.append((text, i, at, left))
        jobs = rest
    for (text, i), got in places.items():
        kept: list[tuple[int, int]] = []
        for share, start, length in sorted(got):
            if all(start >= b or start + length <= a for a, b in kept):
                kept.append((start, start + length))
                yield text, i, -share, start, length


def finders(spark: SparkSession, bench: DataFrame, scratch: Scratch | None = None) -> list:
    """A function Column -> Column for each block of items: the items found in a text."""
    scratch = scratch or Scratch(spark, "decontaminate")
    bench = bench.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    blocks = max(1, -(-bench.count() // ITEMS))
    out = []
    for block in range(blocks):
        part = bench.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block) if blocks > 1 else bench
        rows = part.collect()  # ITEMS rows on average
        items = Items([r.item_id for r in rows], [r.text for r in rows])
        chosen = spark.sparkContext.broadcast(items)

        @F.pandas_udf(FOUND)
        def find(texts, chosen=chosen):  # noqa: ANN001, ANN202
            import pandas as pd

            items, known, jobs = chosen.value, WordHashes(), []
            for r, t in enumerate(texts):
                h = word_hashes(split_words(t), known)
                jobs += [(r, i, a, h[a:b]) for i, a, b in items.windows(h)]
            got: list[list[dict]] = [[] for _ in range(len(texts))]
            for r, i, share, start, length in align(items, jobs):
                got[r].append({"item_id": items.ids[i], "score": share, "start": start, "length": length})
            return pd.Series([sorted(g, key=lambda x: (x["item_id"], x["start"])) for g in got])

        out.append(lambda c, find=find: find(c.cast("string")))
    return out


def found(finders: list) -> Column:
    cols = [f(F.col("text")) for f in finders]
    return cols[0] if len(cols) == 1 else F.concat(*cols)


def contaminated(spark: SparkSession, docs: DataFrame, bench: DataFrame) -> DataFrame:
    """``doc_id, item_id, score, start, length`` for each benchmark item found in a document.

    ``docs`` has doc_id and text, ``bench`` item_id and text; other columns are ignored. A passage counts if
    its best local alignment of words (lower-cased A-Z) has at least half of the score of the whole item; ``score``
    is that share, ``start`` and ``length`` the passage's words. Where one document holds an item several times,
    each place is a row; repeated rows of documents give repeated rows. Null and empty texts, null item ids and
    items of fewer than five words match nothing; equal items count once; empty tables give an empty result.
    """
    hits = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select("doc_id", found(finders(spark, bench)).alias("hits"))
    return hits.select("doc_id", F.inline("hits"))


def decontaminate(spark: SparkSession, docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, with their columns."""
    return docs.where(F.size(found(finders(spark, bench))) == 0)
