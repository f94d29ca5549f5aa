"""Vectorised text helpers that run inside Spark tasks, on Arrow columns and numpy arrays.

Hashes are 64-bit polynomials over a random value per byte, so a window's hash comes from two prefix sums.
They are the same in every process: the tables come from a fixed seed.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_BLOCK = 1 << 16
_LOW = U((1 << 24) - 1)


@lru_cache(maxsize=1)
def byte_values() -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)


_known_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each; the longest ones asked for are kept."""
    if not _known_powers or len(_known_powers[0]) < n:
        size = -(-max(n, 1) // (1 << 18)) << 18
        with np.errstate(over="ignore"):
            up = np.full(size, _BASE, np.uint64)
            down = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
            up[:1] = down[:1] = 1
            _known_powers[:] = [np.cumprod(up), np.cumprod(down)]
    return _known_powers[0], _known_powers[1]


def give_back() -> None:
    """Return to the system what a task has freed. A Python worker waits for its next task beside the JVM, with all it still holds."""
    _known_powers.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library's own; other systems return memory by themselves
    if trim:
        trim(0)


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` of a task that gives its memory back when it ends, after its last batch and its variables are gone."""

    @wraps(run)
    def task(batches: Iterator) -> Iterator:
        yield from run(batches)
        give_back()

    return task


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of the input over the whole word (in place)."""
    h ^= h >> U(31)
    h *= U(0x7FB5D329728EA185)
    h ^= h >> U(27)
    h *= U(0x81DADEF4BC2DD44D)
    h ^= h >> U(33)
    return h


def window_hash(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` values; the same run has the same hash wherever it stands."""
    n = len(values)
    if n < width:
        return np.empty(0, np.uint64)
    up, down = powers(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values * up[:n], out=sums[1:])
    out = sums[width:] - sums[:-width]
    out *= down[: len(out)]
    return mix(out)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    have, m = 1, x
    while have < width:
        step = min(have, width - have)
        m = np.minimum(m[:-step], m[step:])
        have += step
    return m


def winnow(values, n: int, seed: int, window: int):
    """The seed that stands for each window: its smallest seed hash, the leftmost among equals.

    ``values(lo, hi)`` gives the unit values of a slice. Yields per block of windows the position of the first
    window, the chosen seed's position for each window, and its hash. Equal windows choose the same seed, so a window
    that occurs twice has a seed that occurs twice.
    """
    reach = window - seed + 1
    for lo in range(0, n - window + 1, _BLOCK):
        hi = min(lo + _BLOCK, n - window + 1)
        h = window_hash(values(lo, hi + window - 1), seed)
        at = sliding_min((h & ~_LOW) | np.arange(len(h), dtype=np.uint64), reach) & _LOW
        at = at.astype(np.int64)
        yield lo, at + lo, h[at]


def joined(texts: pa.ChunkedArray | pa.Array, separator: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in one buffer (null: empty) and the bounds of each text.

    With ``separator`` one line feed follows each text, inside its bounds.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], texts.type)
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    raw = texts.buffers()[2] if len(texts) else None
    buf = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    if not separator:
        return buf, bounds
    out = np.insert(buf, bounds[1:], 10)
    return out, bounds + np.arange(len(bounds))


@lru_cache(maxsize=1)
def _space() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[32, 9, 10, 11, 12, 13]] = True
    return table


@lru_cache(maxsize=1)
def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def word_bounds(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word (runs without blank, tab, line or page breaks) and the word range of each text.

    The buffer must hold a blank after each text, as ``joined(separator=True)`` makes it.
    """
    gap = _space()[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).view(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    return starts, ends, np.searchsorted(starts, bounds)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    up, down = powers(len(buf) + 1)
    values = byte_values()[_lower()[buf] if lower else buf]
    values *= up[: len(buf)]
    sums = np.empty(len(buf) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values, out=sums[1:])
    h = sums[ends] - sums[starts]
    h *= down[starts]
    h += (ends - starts).astype(np.uint64) * U(0xD6E8FEB86659FD93)
    return mix(h)
