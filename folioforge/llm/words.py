"""Words, shingles and their 64-bit hashes, in numpy.

Lower-casing touches A-Z only and words are runs of bytes other than space and U+0009..U+000D:
``bytes.lower`` and ``bytes.split`` do exactly this.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
#: Masks of the first 0 to 8 bytes of a little-endian 64-bit number.
FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
#: Bytes of text that ``portions`` gives at once: what is computed of them stays near the processor.
PORTION = 1 << 19


class WordHashes(dict):
    """Hash of each word, remembered; emptied when it is large, which changes no result."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def split_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(words: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words, in order, with repeats."""
    if len(h) < n:
        return h[:0]
    out = h[: len(h) - n + 1] * MULTIPLIERS[0]
    for i in range(1, n):
        out += h[i : len(h) - n + 1 + i] * MULTIPLIERS[i % 5]
        out += np.uint64(i)
    return mix(out)


def shingles(h: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer words than ``size`` form one shingle, none an empty set."""
    if not len(h):
        return h[:0]
    if len(h) < size:
        return mix(ngrams(h, len(h)) + np.uint64(len(h)))
    return np.unique(ngrams(h, size))


def small(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that few texts are Python objects at once."""
    for b in batches:
        for s in range(0, b.num_rows, rows):
            yield b.slice(s, rows)


def raw(texts: pa.Array) -> list[bytes]:
    """The bytes of each text; null is empty."""
    kind = pa.binary() if pa.types.is_string(texts.type) else pa.large_binary()
    return [x or b"" for x in texts.cast(kind).to_pylist()]


def portions(batches: Iterator[pa.RecordBatch], size: int = PORTION) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``size`` bytes of text, or of one row."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        s = 0
        while s < b.num_rows:
            e = max(s + 1, int(np.searchsorted(ends, (ends[s - 1] if s else 0) + size, side="right")))
            yield b.slice(s, e - s)
            s = e


def sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` (minimum or maximum) of each run of ``width`` elements, in passes that double."""
    if len(x) < width:
        return x[:0]
    k = 1
    while 2 * k <= width:
        x, k = best(x[:-k], x[k:]), 2 * k
    return best(x[: len(x) - (width - k)], x[width - k :]) if k < width else x


class Words:
    """The words of many texts, one after another: their 64-bit hashes ``h`` and bounds in bytes of ``data``.

    ``first`` has each text's first word and the end, ``begin`` the place of each text in ``data``. Words of up to LONG
    bytes are hashed eight bytes at a time, all words at once; longer ones, a few, by ``known``.
    """

    LONG = 64

    def __init__(self, texts: list[bytes], known: WordHashes):
        self.data = b"\n".join([b"", *texts, bytes(8)]).lower()
        text = np.frombuffer(self.data, np.uint8)[:-8]
        space = (text == 32) | (text - np.uint8(9) < 5)
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        self.start, self.stop = edges[0::2], edges[1::2]
        self.begin = 1 + np.concatenate([[0], np.cumsum([len(x) + 1 for x in texts], dtype=np.int64)])
        self.first = np.searchsorted(self.start, self.begin)
        self.h = self.hashes(known)

    def hashes(self, known: WordHashes) -> np.ndarray:
        size = self.stop - self.start
        eight = np.ndarray(len(self.data) - 7, "<u8", self.data, strides=(1,))
        part = lambda at, n: eight[at].astype(np.uint64, copy=False) & FIRST[np.minimum(n, 8)]
        h = mix(part(self.start, size) ^ (size.astype(np.uint64) * MULTIPLIERS[0]))
        at, done = np.flatnonzero((size > 8) & (size <= self.LONG)), 8
        while len(at):
            h[at] = mix(h[at] ^ part(self.start[at] + done, size[at] - done))
            done += 8
            at = at[size[at] > done]
        for i in np.flatnonzero(size > self.LONG).tolist():
            h[i] = known[self.data[self.start[i] : self.stop[i]]]
        return h

    def lines(self) -> np.ndarray:
        """The first word of each line of the texts, and the end."""
        return np.searchsorted(self.start, np.flatnonzero(np.frombuffer(self.data, np.uint8)[:-8] == 10))

    def code_points(self) -> np.ndarray:
        """How many code points of ``data`` begin before each of its bytes."""
        begins = (np.frombuffer(self.data, np.uint8) & 0xC0) != 0x80
        return np.cumsum(begins, dtype=np.int64) - begins
