"""Words, runs of anything but space and \\t..\\r, hashed in numpy straight from Arrow's text buffers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

_M1, _M2, _R = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _R)
_INVERSE = np.uint64(pow(int(_R), -1, 1 << 64))


@dataclass
class Words:
    """Words of documents ``low`` to ``high`` (not itself): ``hashes`` of all, ``first[i]`` to ``first[i + 1]`` those of document low + i; ``start`` and ``end`` in ``data``."""

    low: int
    high: int
    hashes: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray


def words(texts: pa.Array, lower: bool = False, chunk: int = 1 << 18) -> Iterator[Words]:
    """``texts`` in runs of whole documents of about ``chunk`` bytes (a longer document is a run of its own). A null text has no words."""
    texts = texts.fill_null("").cast(pa.large_binary())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(chunk, _R)])
    inverses = np.multiply.accumulate(np.r_[np.uint64(1), np.full(chunk, _INVERSE)])
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + chunk, side="right")) - 1)
        at = offsets[low : high + 1] - offsets[low]
        part = data[offsets[low] : offsets[high]]
        n = len(part)
        if n >= len(powers):
            powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, _R)])
            inverses = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n, _INVERSE)])
        if lower:
            part = _LOWER[part]
        solid = ~_SPACE[part]
        begins, ends = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1]
        ends[:-1] &= ~solid[1:]
        edge = at[(at > 0) & (at < n)]
        begins[edge] |= solid[edge]
        ends[edge - 1] |= solid[edge - 1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE[part] * powers[:n], out=sums[1:])
        hashes = mix((sums[end] - sums[start]) * inverses[start] + (end - start).astype(np.uint64))
        yield Words(low, high, hashes, np.searchsorted(start, at), start, end, part)
        low = high


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that none has much more than ``size`` bytes in ``column`` (a single row may)."""
    for b in batches:
        lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(b[column]), 0)).astype(np.int64)
        group = np.cumsum(lengths) // size
        cuts = np.flatnonzero(np.diff(group, prepend=-1) > 0) if len(b) else []
        for a, c in zip(cuts, [*cuts[1:], len(b)], strict=True):
            yield b.slice(a, c - a)


def windows(hashes: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of ``length`` words, across documents too: the caller picks those within one."""
    n = max(0, len(hashes) - length + 1)
    out = np.full(n, np.uint64(length + (seed << 32)))
    for i in range(length):
        out *= _R
        out += hashes[i : i + n]
    return mix(out)
