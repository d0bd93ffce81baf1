"""SetSketch and MinHash registers of shingle sets, their bands and their joint estimates."""

from __future__ import annotations

import numpy as np

from .words import sliding

#: Registers per set; base and rate of the exponential scale; largest register value.
M, BASE, RATE, TOP = 128, 1.001, 20.0, 65534

_rng = np.random.default_rng(20240607)
_XOR = _rng.integers(0, 2**32, M, dtype=np.uint64).astype(np.uint32)
_MUL = (_rng.integers(0, 2**32, M, dtype=np.uint64) | 1).astype(np.uint32)
_BAND_MUL = _rng.integers(0, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def minima(sh: np.ndarray) -> np.ndarray:
    """For each register the smallest 32-bit value of its hash function over the set."""
    low = (sh >> np.uint64(32)).astype(np.uint32)
    best = np.full(M, 0xFFFFFFFF, np.uint32)
    for s in range(0, len(low), 1024):
        x = low[s : s + 1024, None] ^ _XOR[None, :]
        x *= _MUL[None, :]
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        np.minimum(best, x.min(axis=0), out=best)
    return best


def set_sketch(sh: np.ndarray) -> np.ndarray:
    """SetSketch registers: the truncated, exponentially spaced minimum of exponential variables.

    Registers of a union are the element-wise maximum, so sketches can be merged.
    """
    x = -np.log1p(-(minima(sh).astype(np.float64) + 0.5) / 2**32) / RATE
    return np.clip(np.floor(1.0 - np.log(x) / np.log(BASE)) + 20_000, 0, TOP).astype(np.uint16)


def min_hash(sh: np.ndarray) -> np.ndarray:
    """MinHash registers cut to 16 bits."""
    return (minima(sh) & np.uint32(0xFFFF)).astype(np.uint16)


def register(low: np.ndarray, k: int) -> np.ndarray:
    """The hash function of register ``k`` for 32-bit numbers; its smallest value over a set is the register."""
    x = low ^ _XOR[k]
    x *= _MUL[k]
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x2C1B3C6D)
    return x


def min_hash_segments(sh: np.ndarray, starts: np.ndarray, m: int, some: int = 32_768) -> np.ndarray:
    """16-bit MinHash registers of the consecutive, non-empty segments of ``sh`` that begin at ``starts``.

    Segments are taken together up to ``some`` elements, register by register, so that they stay near the processor.
    """
    low = (sh >> np.uint64(32)).astype(np.uint32)
    out = np.empty((m, len(starts)), np.uint16)
    ends = np.append(starts[1:], len(low))
    at = 0
    while at < len(starts):
        a = starts[at]
        end = max(at + 1, int(np.searchsorted(ends, a + some, side="right")))
        part = low[a : ends[end - 1]]
        for k in range(m):
            out[k, at:end] = np.minimum.reduceat(register(part, k), starts[at:end] - a) & np.uint32(0xFFFF)
        at = end
    return out.T


def min_hash_windows(sh: np.ndarray, starts: np.ndarray, width: int, m: int) -> np.ndarray:
    """16-bit MinHash registers of the runs of ``width`` elements of ``sh`` that begin at ``starts``."""
    low = (sh >> np.uint64(32)).astype(np.uint32)
    out = np.empty((m, len(starts)), np.uint16)
    for k in range(m if len(starts) else 0):
        out[k] = sliding(register(low, k), width, np.minimum)[starts] & np.uint32(0xFFFF)
    return out.T


def bands(regs: np.ndarray, rows: int, count: int) -> np.ndarray:
    """A 64-bit key for each of ``count`` bands of ``rows`` registers; the band's number is part of it."""
    r = regs[: rows * count].reshape(count, rows).astype(np.uint64) + np.uint64(1)
    h = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for i in range(rows):
        h = (h ^ (r[:, i] * _BAND_MUL[i])) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def bands_of_rows(regs: np.ndarray, rows: int, count: int) -> np.ndarray:
    """``bands`` of each row of a table of registers."""
    r = regs[:, : rows * count].reshape(len(regs), count, rows).astype(np.uint64) + np.uint64(1)
    h = np.tile(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), (len(regs), 1))
    for i in range(rows):
        h = (h ^ (r[:, :, i] * _BAND_MUL[i])) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
    return h.view(np.int64)


def joint_estimate(r1: np.ndarray, r2: np.ndarray, n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """Likeliest Jaccard similarity of pairs of SetSketches (a row each) with known set sizes.

    With u, v the sizes' shares and p(x) = -log_b(1 - x (b-1)/b), a register of the first set is larger
    with probability p(u - vJ) and smaller with p(v - uJ); J maximises the likelihood of what is seen.
    """
    up = (r1 > r2).sum(1)[:, None]
    down = (r1 < r2).sum(1)[:, None]
    same = r1.shape[1] - up - down
    n1, n2 = n1.astype(float)[:, None], n2.astype(float)[:, None]
    u, v = n1 / (n1 + n2), n2 / (n1 + n2)
    j = np.linspace(0, 1, 101)[None, :] * np.minimum(u / v, v / u)

    def p(x):
        return -np.log1p(-np.clip(x, 1e-9, 1) * (BASE - 1) / BASE) / np.log(BASE)

    a, b = p(u - v * j), p(v - u * j)
    like = up * np.log(a) + down * np.log(b) + same * np.log(np.clip(1 - a - b, 1e-12, 1))
    return np.take_along_axis(j, like.argmax(1)[:, None], 1)[:, 0]


def plain_estimate(r1: np.ndarray, r2: np.ndarray, n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """Share of equal registers."""
    return (r1 == r2).mean(1)
