"""Words of Arrow text batches as numpy arrays.

All operators of this folder that run Python inside tasks cut text the same
way: a word is a run of bytes outside space and \\x09-\\x0D. Work is done on the
UTF-8 buffer of a column, a few megabytes at a time, so memory does not follow
the batch. A text longer than that is one piece of its own; only its words'
hashes are held at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 20  # bytes of text worked on at a time

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# Odd multiplier of the polynomial hash, its inverse, and the finalizer's constants (fixed values).
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX[0]
    x ^= x >> np.uint64(27)
    x = x * _MIX[1]
    x ^= x >> np.uint64(31)
    return x


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the multiplier and of its inverse, at least ``n`` of each."""
    if not _POWERS or len(_POWERS[0]) < n:
        out = []
        for base in (_BASE, _INVERSE):
            p = np.full(n, np.uint64(base))
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        if n > 2 * PIECE:  # not kept: only a single word can be this long
            return out
        _POWERS[:] = out
    return _POWERS


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte ranges; equal for equal bytes wherever they stand."""
    up, down = _powers(max(len(data), 2 * PIECE))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    raw = (total[ends] - total[starts]) * down[np.minimum(starts, len(data) - 1 if len(data) else 0)] \
        if len(data) else np.zeros(0, np.uint64)
    return mix(raw + (ends - starts).astype(np.uint64) * _MIX[0])


@dataclass
class Words:
    """Words of several texts in order: ``first[d]:first[d + 1]`` are those of text d."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


@dataclass
class Texts:
    """Bytes of several texts; text d is ``data[offsets[d]:offsets[d + 1]]``. ``at`` is the first one's row."""

    data: np.ndarray
    offsets: np.ndarray
    at: int

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def lowered(self) -> Texts:
        """With A-Z in lower case."""
        return Texts(_LOWER[self.data], self.offsets, self.at)

    def per_text(self, marks: np.ndarray) -> np.ndarray:
        """How many of the marked bytes each text has."""
        total = np.zeros(len(marks) + 1, np.int64)
        np.cumsum(marks, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def bounds(self) -> tuple[np.ndarray, np.ndarray]:
        """Where words start and end."""
        inside = np.zeros(len(self.data) + 2, bool)
        np.logical_not(_SEPARATOR[self.data], out=inside[1:-1])
        starts, ends = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
        cut = self.offsets[1:-1]  # a word ends where its text does
        cut = cut[inside[cut] & inside[cut + 1]]
        starts[cut] = True
        ends[cut] = True
        return np.flatnonzero(starts), np.flatnonzero(ends)

    def words(self) -> Words:
        starts, ends = self.bounds()
        hashes = np.empty(len(starts), np.uint64)
        lo = 0
        while lo < len(starts):  # a long text is hashed in steps that end with a word
            hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + PIECE, "right")))
            a, b = starts[lo], ends[hi - 1]
            hashes[lo:hi] = span_hashes(self.data[a:b], starts[lo:hi] - a, ends[lo:hi] - a)
            lo = hi
        return Words(starts, ends, hashes, np.searchsorted(starts, self.offsets))


def texts(column: pa.Array, size: int = PIECE) -> Iterator[Texts]:
    """The column's texts in runs of about ``size`` bytes; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        hi = min(hi, len(column))
        yield Texts(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], lo)
        lo = hi


def distinct(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, hash) pairs, ordered by both."""
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(doc[order], kind="stable")]
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return doc[new], hashes[new]
