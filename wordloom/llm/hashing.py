"""Vectorised hashes of words and byte windows, for code that runs inside Spark tasks.

All hashes are differences of one running sum: byte i adds ``TABLE[b] * BASE**i`` (mod 2**64), so
the bytes from s to e hash to ``(sum[e] - sum[s]) * BASE**-s``, wherever they stand.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Bytes handled at once; the power tables stay in the processor's cache at this size.
PIECE = 1 << 18
ALL_ONES = np.uint64((1 << 64) - 1)

_seeded = np.random.Generator(np.random.PCG64(20240229))
TABLE = _seeded.integers(0, 1 << 64, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

# The six bytes that separate words, and A-Z to a-z.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


@lru_cache(maxsize=2)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    tables = []
    for base in (BASE, INVERSE):
        table = np.full(length, base, dtype=np.uint64)
        table[0] = 1
        tables.append(np.cumprod(table, dtype=np.uint64))
    return tables[0], tables[1]


def powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``length`` of each."""
    return _powers(max(PIECE + 1, 1 << (length - 1).bit_length() if length > PIECE else 0))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def running_sum(data: np.ndarray) -> np.ndarray:
    """The running sum at every border of ``data``, one longer than it."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(TABLE[data] * up[: len(data)], out=out[1:])
    return out


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of each ``width`` bytes long window of ``data``."""
    total = running_sum(data)
    _, down = powers(len(data) + 1)
    return mix((total[width:] - total[:-width]) * down[: len(data) - width + 1])


def _pieces(breaks: np.ndarray) -> list[int]:
    """Borders that cut the bytes into pieces of about ``PIECE``, each at a break."""
    borders, at, total = [0], 0, len(breaks)
    while total - at > PIECE:
        near = np.flatnonzero(breaks[at + 1 : at + PIECE + 1])
        if len(near):
            at += 1 + int(near[-1])
        else:
            later = np.flatnonzero(breaks[at + PIECE + 1 :])
            at = at + PIECE + 1 + int(later[0]) if len(later) else total
        borders.append(at)
    if borders[-1] != total:
        borders.append(total)
    return borders


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of every text, A-Z read as a-z.

    ``data`` holds the texts one after the other, text i from ``offsets[i]`` to ``offsets[i + 1]``.
    Returns the hashes in order and, like ``offsets``, where each text's words begin.
    """
    base = int(offsets[0])
    data = LOWER[data[base : int(offsets[-1])]]
    offsets = np.asarray(offsets, dtype=np.int64) - base
    space = IS_SPACE[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    breaks = space | first[:-1]
    hashes, starts = [], []
    borders = _pieces(breaks) if len(data) else [0]
    for low, high in zip(borders, borders[1:]):
        solid = ~space[low:high]
        begin = solid.copy()
        begin[1:] &= space[low : high - 1] | first[low + 1 : high]
        close = solid.copy()
        close[:-1] &= space[low + 1 : high] | first[low + 1 : high]
        start, end = np.flatnonzero(begin), np.flatnonzero(close) + 1
        total = running_sum(data[low:high])
        _, down = powers(high - low + 1)
        hashes.append(mix((total[end] - total[start]) * down[start]))
        starts.append(start + low)
    none = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    where = np.concatenate(starts or none[1])
    return np.concatenate(hashes or none[0]), np.searchsorted(where, offsets)


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string column, without a copy; null texts are empty."""
    import pyarrow as pa

    column = column.cast(pa.large_string()).fill_null("")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8), offsets
