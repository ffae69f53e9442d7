"""Whole-batch text kernels over Arrow string buffers.

Words are maximal runs of bytes outside ``\\x20\\x09-\\x0D``, hashed and windowed
with a handful of numpy passes over the concatenated bytes of many documents.
No Python loop runs per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.Generator(np.random.PCG64(20240917))
_BYTE = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = {"byte": 0x9E3779B97F4A7C1B, "word": 0xD6E8FEB86659FD93, "alt": 0xA0761D6478BD642B}
_POWERS: dict[str, tuple[np.ndarray, np.ndarray]] = {}
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, and of its inverse; grown on demand."""
    have = _POWERS.get(kind)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        pair = []
        for base in (_BASE[kind], pow(_BASE[kind], -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            pair.append(np.cumprod(p, dtype=np.uint64))
        have = _POWERS[kind] = (pair[0], pair[1])
    return have[0][:n], have[1][:n]


def spans(values: np.ndarray, start: np.ndarray, end: np.ndarray, kind: str) -> np.ndarray:
    """Polynomial hash of values[start:end] for each pair, comparable across places."""
    p, inv = powers(kind, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * p[:-1], dtype=np.uint64, out=total[1:])
    return (total[end] - total[start]) * inv[start]


class Words:
    """The words of a slice of documents: hash, byte range, and range of words of each document."""

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_string()).fill_null("")
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
        self.bounds = bounds - bounds[0]
        self.raw = raw
        inside = ~_SPACE[raw]
        edge = np.zeros(len(raw) + 1, bool)
        edge[self.bounds] = True
        before, after = np.empty(len(raw), bool), np.empty(len(raw), bool)
        if len(raw):
            before[0], after[-1] = False, False
            before[1:], after[:-1] = inside[:-1], inside[1:]
            before[edge[:-1]] = False
            after[edge[1:]] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, self.bounds)
        self.hash = mix(spans(_BYTE[raw], self.start, self.end, "byte"))

    def __len__(self) -> int:
        return len(self.start)

    def doc(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of text, so that temporary arrays stay small."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.nan_to_num(pc.binary_length(batch[column]).to_numpy(zero_copy_only=False).astype(float)) + 64
        cuts = np.flatnonzero(np.diff(np.floor(np.cumsum(sizes) / limit))) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            if b > a:
                yield batch.slice(a, b - a)
        release()


@cache
def _trim():
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return lambda _: 0


def release() -> None:
    """Gives freed memory back to the system; a worker is kept for later tasks, and what it holds counts for its executor."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def arrays(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """A list column out of flat values and the offset of each row."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values))
