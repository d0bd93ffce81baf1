"""Removal of passages that repeat across documents, by MinHash bands of paragraphs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sketch
from .lsh import Registers, loose_clusters
from .store import Scratch
from .words import WordHashes, Words, mix, ngrams, portions, raw, sliding

#: Paragraphs are lines of at least LINE words, and windows of WINDOW words that begin at anchors, wherever lines break.
#: An anchor is the smallest three-word hash among ANCHOR successive ones, so a passage of WINDOW + ANCHOR + 1 = 50 words
#: holds a whole window that begins at the same word in every document.
LINE, WINDOW, ANCHOR = 30, 27, 22
#: Rows and bands of a line (two at 0.75 share one with probability 0.9986) and of a window (equal ones always do; one
#: that holds an edit is bridged by its neighbours, and more bands would only join windows of one text that overlap).
LINE_ROWS, LINE_BANDS = 3, 12
WINDOW_ROWS, WINDOW_BANDS = 6, 1
#: Paragraphs with a similarity of PART / WHOLE on SHINGLE words are linked.
PART, WHOLE, SHINGLE = 75, 100, 5
#: Passages with at most this many words between them become one.
BRIDGE = 5
#: Words before and after a paragraph in which a passage's true end is looked for.
REACH = 30
#: Shingles (each member counts 64 more) of a block of a bucket.
BLOCK = 60_000
#: A task gives the bands of a paragraph once, as long as it remembers it: twice this many at most.
REMEMBERED = 200_000
#: Node ids are broadcast for the second read of the texts only up to this many.
BROADCAST_IDS = 125_000


def anchors(g: np.ndarray) -> np.ndarray:
    """Where the windows of a text begin whose three-word hashes are ``g``; fewer than ANCHOR have one at the smallest."""
    least = np.lib.stride_tricks.sliding_window_view(g, min(ANCHOR, len(g))).argmin(axis=1)  # of equals the first
    at = np.unique(least + np.arange(len(least)))
    if (g[at[1:]] == g[at[:-1]]).any():  # in words that repeat, whose windows are equal, some anchors do
        kept = at[:1].tolist()
        for i in at[1:].tolist():
            if g[i] != g[kept[-1]] or i - kept[-1] >= ANCHOR:
                kept.append(i)
        at = np.array(kept)
    return at


class Texts:
    """The words and paragraphs of many texts, by word numbers that run on from text to text."""

    def __init__(self, texts: list[bytes], known: WordHashes):
        words = Words(texts, known)
        self.h, self.first = words.h, words.first
        line = words.lines()
        long = np.flatnonzero(np.diff(line) >= LINE)
        at = self.windows()
        start, stop = np.concatenate([line[long], at]), np.concatenate([line[long + 1], at + WINDOW])
        doc = np.searchsorted(self.first, start, side="right") - 1
        order = np.argsort(doc, kind="stable")  # of each text the lines, then the windows
        self.start, self.stop, self.doc, self.is_line = start[order], stop[order], doc[order], order < len(long)
        self.g = ngrams(self.h, SHINGLE)

    def windows(self) -> np.ndarray:
        """Where the windows begin: at the anchors of each text."""
        room = np.maximum(np.diff(self.first) - WINDOW + 1, 0)
        begin = self.first[:-1]
        total = len(self.h) - WINDOW + 1
        if total < 1 or not room.any():
            return np.empty(0, np.int64)
        g = mix(ngrams(self.h, 3)[:total])
        wide = room >= ANCHOR
        at = np.empty(0, np.int64)
        if wide.any():
            # the smallest of each run of ANCHOR that lies in one text, 0 for others; an anchor is as large as one of its runs'
            least = np.where(self.among(begin[wide], room[wide] - ANCHOR + 1, total - ANCHOR + 1), sliding(g, ANCHOR, np.minimum), np.uint64(0))
            none = np.zeros(ANCHOR - 1, np.uint64)
            most = sliding(np.concatenate([none, least, none]), ANCHOR, np.maximum)
            at = np.flatnonzero((g == most) & self.among(begin[wide], room[wide], total))
        # equals are rare: their texts, and those that are shorter than a run, are looked at alone
        doc = np.searchsorted(self.first, at, side="right") - 1
        tied = np.unique(doc[1:][(g[at[1:]] == g[at[:-1]]) & (doc[1:] == doc[:-1])])
        alone = np.concatenate([tied, np.flatnonzero((room > 0) & ~wide)])
        more = [begin[d] + anchors(g[begin[d] : begin[d] + room[d]]) for d in alone.tolist()]
        return np.concatenate([at[~np.isin(doc, tied)], *more])

    @staticmethod
    def among(start: np.ndarray, size: np.ndarray, total: int) -> np.ndarray:
        """Which of ``total`` places lie in one of the runs of ``size`` places, apart from each other, that begin at ``start``."""
        step = np.zeros(total + 1, np.int8)
        step[start] += 1
        step[start + size] -= 1
        return np.cumsum(step[:-1], dtype=np.int8).view(bool)

    def sets(self) -> list[np.ndarray]:
        """Shingles of each paragraph."""
        return [np.unique(self.g[a : b - SHINGLE + 1]) for a, b in zip(self.start, self.stop)]

    def packed(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``at`` in another order, how many shingles each of these paragraphs has, and their sorted shingles one after another."""
        size = self.stop[at] - self.start[at] - SHINGLE + 1
        order, counts, flat = [at[:0]], [at[:0]], [self.g[:0]]
        for n in np.unique(size).tolist():
            some = at[size == n]
            rows = np.sort(self.g[self.start[some][:, None] + np.arange(n)], axis=1)
            new = np.ones(rows.shape, bool)
            new[:, 1:] = rows[:, 1:] != rows[:, :-1]
            order.append(some)
            counts.append(new.sum(axis=1))
            flat.append(rows[new])
        return np.concatenate(order), np.concatenate(counts), np.concatenate(flat)

    def nodes(self) -> np.ndarray:
        """A 64-bit number for each paragraph's shingles: equal for equal paragraphs."""
        size = self.stop - self.start - SHINGLE + 1
        mixed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(self.g + np.uint64(1)))])  # sums wrap around
        return mix(mixed[self.start + size] - mixed[self.start] + size.astype(np.uint64)).view(np.int64)

    def keys(self, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The keys of all bands of the (wanted) paragraphs in their order, and how many each paragraph has."""
        wanted = np.ones(len(self.start), bool) if wanted is None else wanted
        count = np.where(wanted, np.where(self.is_line, LINE_BANDS, WINDOW_BANDS), 0)
        place = np.cumsum(count) - count
        keys = np.empty(count.sum(), np.int64)
        if len(lines := np.flatnonzero(wanted & self.is_line)):
            size = self.stop[lines] - self.start[lines] - SHINGLE + 1
            begin = np.cumsum(size) - size
            flat = self.g[np.repeat(self.start[lines] - begin, size) + np.arange(size.sum())]
            regs = sketch.min_hash_segments(flat, begin, LINE_ROWS * LINE_BANDS)
            keys[place[lines][:, None] + np.arange(LINE_BANDS)] = sketch.bands_of_rows(regs, LINE_ROWS, LINE_BANDS)
        if len(at := np.flatnonzero(wanted & ~self.is_line)):
            regs = sketch.min_hash_windows(self.g, self.start[at], WINDOW - SHINGLE + 1, WINDOW_ROWS * WINDOW_BANDS)
            keys[place[at][:, None] + np.arange(WINDOW_BANDS)] = sketch.bands_of_rows(regs, WINDOW_ROWS, WINDOW_BANDS)
        return keys, count


class Text(Texts):
    """A text's words and paragraphs, by word numbers."""

    def __init__(self, text: str | None, known: WordHashes):
        super().__init__([(text or "").encode("utf-8", "surrogatepass")], known)


class Remembered:
    """Tells which numbers come for the first time; of old ones only those that come again are kept for sure."""

    def __init__(self, limit: int):
        self.limit, self.old, self.new = limit, set(), set()

    def fresh(self, numbers: list[int]) -> np.ndarray:
        out = np.zeros(len(numbers), bool)
        for i, x in enumerate(numbers):
            if x not in self.new:
                out[i] = x not in self.old
                if len(self.new) >= self.limit:
                    self.old, self.new = self.new, set()
                self.new.add(x)
        return out


SEEN = "doc_id long, start array<int>, stop array<int>, node array<long>, keys array<array<long>>"


def listed(values: np.ndarray | pa.Array, sizes: np.ndarray) -> pa.Array:
    """Lists of ``sizes`` successive values."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(values))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document with paragraphs: their bounds, nodes and band keys, those of equal ones once."""
    known, met = WordHashes(), Remembered(REMEMBERED)
    for b in portions(batches):
        x = Texts(raw(b.column("text")), known)
        size = np.bincount(x.doc, minlength=b.num_rows)
        some = np.flatnonzero(size)
        begin, nodes = x.first[x.doc], x.nodes()
        keys, count = x.keys(met.fresh(nodes.tolist()))
        parts = [(x.start - begin).astype(np.int32), (x.stop - begin).astype(np.int32), nodes, listed(keys, count)]
        yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(some)), *(listed(p, size[some]) for p in parts)], names=["doc_id", "start", "stop", "node", "keys"])


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for b in portions(batches):
        x = Texts(raw(b.column("text")), known)
        nodes = x.nodes()
        at = np.flatnonzero(np.isin(nodes, b.column("wanted").flatten().to_numpy()))
        at = at[np.unique(nodes[at], return_index=True)[1]]
        at, n, flat = x.packed(at)
        ends = np.concatenate([[0], np.cumsum(8 * n)]).astype(np.int32)
        sets = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(flat)])
        yield pa.RecordBatch.from_arrays([pa.array(nodes[at]), pa.array(n), sets], names=["node", "n", "regs"])


class Sets:
    """Sorted sets of 64-bit numbers, one after another in ``flat``."""

    def __init__(self, flat: np.ndarray, start: np.ndarray, size: np.ndarray):
        self.flat, self.start, self.size = flat, start, size

    def __len__(self) -> int:
        return len(self.size)

    def __getitem__(self, rows) -> Sets:
        return Sets(self.flat, self.start[rows], self.size[rows])

    def values(self) -> np.ndarray:
        return self.flat[np.repeat(self.start - (np.cumsum(self.size) - self.size), self.size) + np.arange(self.size.sum())]


def in_one(one: np.ndarray, many: Sets) -> np.ndarray:
    """How many elements each of ``many`` shares with ``one``."""
    v = many.values()
    hit = one[np.minimum(np.searchsorted(one, v), len(one) - 1)] == v
    return np.add.reduceat(hit, np.cumsum(many.size) - many.size, dtype=np.int64)


def in_pairs(x: Sets, y: Sets, some: int = 2048) -> np.ndarray:
    """How many elements each of ``x`` shares with the one of ``y`` in its place: equals in the sorted elements of both."""
    total = x.size + y.size
    out = np.empty(len(total), np.int64)
    order = np.argsort(total, kind="stable")
    for s in range(0, len(order), some):
        at = order[s : s + some]
        a, b, width = x[at], y[at], np.arange(total[at[-1]])
        rows = np.full((len(at), len(width)), np.uint64(2**64 - 1))
        rows[width < a.size[:, None]] = a.values()
        rows[(width >= a.size[:, None]) & (width < total[at][:, None])] = b.values()
        rows.sort(axis=1)
        same = (rows[:, 1:] == rows[:, :-1]) & (width[1:] < total[at][:, None])
        out[at] = same.sum(axis=1)
    return out


class FullSets(Registers):
    """Exact comparison of paragraphs by their full sets."""

    def __init__(self):
        pass

    def table(self, blobs: list[bytes]) -> Sets:
        size = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 8
        return Sets(np.frombuffer(b"".join(blobs), np.uint64), np.cumsum(size) - size, size)

    def close(self, x: Sets, y: Sets, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
        ok = (WHOLE * ny >= PART * nx) & (WHOLE * nx >= PART * ny)
        at = np.flatnonzero(ok)
        if len(at):
            both = in_one(x.values(), y[at]) if len(x) == 1 else in_pairs(x[at], y[at])
            ok[at] = WHOLE * both >= PART * (x.size[at if len(x) > 1 else 0] + y.size[at] - both)
        return ok


# ---- from repeated paragraphs to passages -----------------------------------------------------------------

RUN = "doc_id long, run int, first int, last int, kept long, left_kept long, left int, right_kept long, right int"


def runs_of(hits: list[dict]) -> list[tuple[int, ...]]:
    """``first, last, kept, left_kept, left, right_kept, right`` of each run of repeated paragraphs that touch each other:
    its bounds, the smallest kept document, and where its first and its last paragraph begin and end in theirs."""
    out: list[list[int]] = []
    for h in sorted(hits, key=lambda h: (h["start"], -h["stop"], h["kept"])):
        if out and h["start"] <= out[-1][1]:
            out[-1][2] = min(out[-1][2], h["kept"])
            if h["stop"] > out[-1][1]:
                out[-1][1], out[-1][5], out[-1][6] = h["stop"], h["kept"], h["kept_stop"]
        else:
            out.append([h["start"], h["stop"], h["kept"], h["kept"], h["kept_start"], h["kept"], h["kept_stop"]])
    return [tuple(r) for r in out]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in RUN.split(", ")]
    kinds = [{"long": pa.int64(), "int": pa.int32()}[x.split()[1]] for x in RUN.split(", ")]
    for b in batches:
        rows = [(i, k, *r) for i, hits in zip(b.column("doc_id").to_pylist(), b.column("hits").to_pylist()) for k, r in enumerate(runs_of(hits))]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows) if rows else [[]] * len(names), kinds)], names=names)


def _context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words around the wanted places of kept documents, as they follow in the text."""
    known = WordHashes()
    for b in portions(batches):
        x = Words(raw(b.column("text")), known)
        docs, places, words = [], [], []
        for i, want, first, end in zip(b.column("doc_id").to_pylist(), b.column("wanted").to_pylist(), x.first[:-1].tolist(), x.first[1:].tolist()):
            h = x.h[first:end]
            for p in want:
                docs.append(i)
                places.append(p)
                words.append(h[max(0, p - REACH) : p + REACH].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(places, pa.int32()), pa.array(words, pa.binary())], names=["doc_id", "place", "words"])


def shared_words(mine: np.ndarray, theirs: np.ndarray) -> list[bool]:
    """Which of ``mine`` stand in a run of SHINGLE words that ``theirs`` have too; one more, false, at the end."""
    n, m = len(mine) - SHINGLE + 1, len(theirs) - SHINGLE + 1
    shared = np.zeros(len(mine) + 1, bool)
    if n > 0 and m > 0:
        same = mine[:, None] == theirs[None, :]
        runs = same[:n, :m].copy()
        for k in range(1, SHINGLE):
            runs &= same[k : n + k, k : m + k]
        at = runs.any(axis=1)
        for k in range(SHINGLE):
            shared[k : n + k] |= at
    return shared.tolist()


def true_end(h: np.ndarray, place: int, words: bytes | None, step: int) -> int:
    """The word bound at which what a text shares with its kept document around ``place`` begins (step -1) or ends (1).

    A word is shared if it stands in a run of SHINGLE words that the kept document has around its own place. At most half
    a window of the paragraph itself is given up.
    """
    if words is None:
        return place
    lo = max(0, place - REACH)
    part = h[lo : place + REACH]
    shared = shared_words(part, np.frombuffer(words, np.uint64))
    inside, end = (place - lo, -1) if step < 0 else (place - lo - 1, len(part))
    for _ in range(WINDOW // 2):  # back into the paragraph
        if 0 <= inside < len(part) and not shared[inside]:
            inside -= step
    if not (0 <= inside < len(part) and shared[inside]):
        return place
    while inside + step != end and shared[inside + step]:
        inside += step
    return lo + (inside if step < 0 else inside + 1)


def removals(h: np.ndarray, runs: list[dict]) -> list[tuple[int, int, int]]:
    """``first word, end, kept document`` of the passages to remove, in order and apart from each other."""
    out: list[tuple[int, int, int]] = []
    for r in sorted(runs, key=lambda r: r["run"]):
        if r["last"] > len(h):  # a repeated doc_id brings marks of another text
            continue
        a, b = true_end(h, r["first"], r["left_words"], -1), true_end(h, r["last"], r["right_words"], 1)
        if out and a <= out[-1][1] + BRIDGE:
            out[-1] = (out[-1][0], max(b, out[-1][1]), out[-1][2])
        else:
            out.append((a, b, r["kept"]))
    return out


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("n_words", pa.int64()), ("kept_doc_id", pa.int64())]))
SPANS_SQL = "array<struct<start:bigint,length:bigint,n_words:bigint,kept_doc_id:bigint>>"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans in code points of what is removed from each text with runs."""
    known = WordHashes()
    for b in portions(batches):
        x = Words(raw(b.column("text")), known)
        point, out = x.code_points(), []
        for d, runs in enumerate(b.column("runs").to_pylist()):
            first, end, begin = x.first[d], x.first[d + 1], point[x.begin[d]]
            spans = []
            for a, e, k in removals(x.h[first:end], runs):
                left, right = int(point[x.start[first + a]]), int(point[x.stop[first + e - 1]])
                spans.append({"start": left - int(begin), "length": right - left, "n_words": e - a, "kept_doc_id": k})
            out.append(spans)
        yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(out, SPANS)], names=["row", "spans"])


def cut_texts(texts: list[bytes], runs: list[list[dict]], known: WordHashes) -> list[bytes]:
    """The texts without the passages that their runs make up."""
    x, out = Words(texts, known), []
    for d, t in enumerate(texts):
        first, end, begin = x.first[d], x.first[d + 1], x.begin[d]
        kept, last = [], 0
        for a, e, _ in removals(x.h[first:end], runs[d]):
            kept.append(t[last : x.start[first + a] - begin])
            last = x.start[first + e] - begin if first + e < end else len(t)
        out.append(b"".join([*kept, t[last:]]))
    return out


def marked(spark: SparkSession, docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id, runs`` of each document with paragraphs that an earlier one has."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null")
    seen = scratch.save(base.mapInArrow(_scan, SEEN))
    # equal paragraphs are one node, however many documents have them; each task gives it about once
    bands = seen.select("doc_id", F.explode(F.arrays_zip("node", "keys")).alias("x")).select("x.node", F.explode("x.keys").alias("key"), F.col("doc_id").alias("home"))

    def texts_of(ids: DataFrame) -> DataFrame:
        """``ids`` (doc_id and more) with the documents' texts."""
        ids = scratch.save(ids)
        made.append(ids)
        return base.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id")

    def sets(wanted: DataFrame) -> DataFrame:
        bounds.append(scratch.save(seen.drop("keys")))  # the band keys, most of the table, are done
        scratch.drop(seen)
        home = wanted.groupBy(F.col("home").alias("doc_id")).agg(F.collect_list("node").alias("wanted"))
        return texts_of(home).select("wanted", "text").mapInArrow(_full_sets, "node long, n long, regs binary")

    exact, made, bounds = FullSets(), [], []
    clusters, few = loose_clusters(scratch, bands, sets, exact, exact, size=F.col("n") + 64, bucket=BLOCK)
    scratch.drop(few, *made)
    paragraphs = bounds[0].select("doc_id", F.explode(F.arrays_zip("start", "stop", "node")).alias("x")).select("doc_id", "x.start", "x.stop", "x.node")
    in_class = paragraphs.join(clusters, "node", "left").select("doc_id", "start", "stop", F.coalesce("component", "node").alias("component"))
    in_class = scratch.save(in_class)
    scratch.drop(*bounds, clusters)
    first = in_class.groupBy("component").agg(F.min(F.struct("doc_id", "start", "stop")).alias("k"), F.max("doc_id").alias("last")).where("k.doc_id < last")
    first = scratch.save(first)
    scratch.drop()  # shuffle files of all components
    hits = in_class.join(first, "component").where("doc_id <> k.doc_id").groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop", F.col("k.doc_id").alias("kept"), F.col("k.start").alias("kept_start"), F.col("k.stop").alias("kept_stop"))).alias("hits"))
    runs = scratch.save(hits.mapInArrow(_runs, RUN))
    scratch.drop(in_class, first)

    places = runs.select(F.explode(F.array(F.struct(F.col("left_kept").alias("doc_id"), F.col("left").alias("place")), F.struct(F.col("right_kept").alias("doc_id"), F.col("right").alias("place")))).alias("x")).select("x.doc_id", "x.place")
    wanted = places.distinct().groupBy("doc_id").agg(F.collect_list("place").alias("wanted"))
    # rows that share a kept doc_id give a place several times; one text's words do
    context = texts_of(wanted).select("doc_id", "wanted", "text").mapInArrow(_context, "doc_id long, place int, words binary").groupBy("doc_id", "place").agg(F.max("words").alias("words"))
    context = scratch.save(context)
    end = lambda doc, place, name: context.select(F.col("doc_id").alias(doc), F.col("place").alias(place), F.col("words").alias(name))
    whole = runs.join(end("left_kept", "left", "left_words"), ["left_kept", "left"], "left").join(end("right_kept", "right", "right_words"), ["right_kept", "right"], "left")
    out = scratch.save(whole.groupBy("doc_id").agg(F.collect_list(F.struct("run", "first", "last", "kept", "left_words", "right_words")).alias("runs")))
    scratch.drop(runs, context, *made)
    return out


def repeated_passages(spark: SparkSession, docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``doc_id, start, length, n_words, kept_doc_id`` of each passage that repeats an earlier document's.

    ``docs`` has doc_id and text; other columns are ignored. Paragraphs are lines of at least 30 words and anchored
    windows of 27 words, so that any passage of 50 words or more holds one at the same place in all documents, wherever
    it begins. Those that share a MinHash band are compared on full sets of five-word shingles, linked from a Jaccard
    similarity of 0.75, and joined to components. A paragraph goes if its component has a document with a smaller
    id; paragraphs that touch are one passage, whose ends are moved to where what is shared with the kept
    document ends. What only repeats inside one document stays, as does each passage's first document; shorter
    repeats than 27 words stay. ``start`` and ``length`` count code points. Null and empty texts and null ids lose nothing;
    rows with one doc_id count as one document; very long texts have as many paragraphs as they need; an empty table
    gives an empty result.
    """
    scratch = scratch or Scratch(spark, "substring-dedup")
    marks = marked(spark, docs, scratch)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(marks, "doc_id")
    cut = rows.select(F.col("doc_id").alias("row"), "text", "runs").mapInArrow(_cut, f"row long, spans {SPANS_SQL}")
    return cut.select(F.col("row").alias("doc_id"), F.inline("spans"))


def without_passages(spark: SparkSession, docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text``; rows that lose all their words are left out."""
    scratch = scratch or Scratch(spark, "substring-dedup")
    marks = marked(spark, docs, scratch)
    names = docs.columns
    m = marks.select(F.col("doc_id").alias("_id"), F.col("runs").alias("_runs"))
    rows = docs.withColumn("text", F.col("text").cast("string")).join(m, F.col("doc_id").cast("long") == F.col("_id"), "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for b in portions(batches):
            texts, keep = b.column("text"), np.ones(b.num_rows, bool)
            some = pc.and_(b.column("_runs").is_valid(), texts.is_valid())
            at = pa.array(np.flatnonzero(some.to_numpy(zero_copy_only=False)))
            if len(at):
                left = cut_texts(raw(texts.take(at)), b.column("_runs").take(at).to_pylist(), known)
                keep[at.to_numpy()] = [bool(t.strip()) for t in left]
                texts = pc.replace_with_mask(texts, some, pa.array(left, pa.binary()).cast(texts.type))
            out = [texts if n == "text" else b.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(out, names=names).filter(pa.array(keep))

    return rows.select(*names, "_runs").mapInArrow(cut, docs.schema)
