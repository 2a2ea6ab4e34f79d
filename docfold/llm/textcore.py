"""Words, shingles and characters of Arrow string columns as numpy arrays.

Used inside Arrow tasks by the operators of this subpackage. A word is a maximal run of bytes other than space and
\\x09-\\x0D; A-Z are lower-cased. Work goes in pieces that fit a cache, so memory follows the largest text, not the batch.
"""

from __future__ import annotations

import ctypes
import functools
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE_BYTES = 1 << 18
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def tidy(task: Callable) -> Callable:
    """The Arrow task, which in the end gives back to the machine what it has freed: Spark keeps the Python process for later
    tasks, and beside stages without Python it would go on holding memory that nothing uses."""

    @functools.wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it; others are left alone
        if trim:
            trim(0)

    return run


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, salt: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_ODD) + np.uint64(salt))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, and len + 1 offsets into them; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if data is None or offs[-1] == offs[0]:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offs[0]:offs[-1]], offs - offs[0]


def pieces(texts: pa.Array, limit: int = PIECE_BYTES):
    """(first row, last row, bytes, offsets) for runs of rows of about `limit` bytes; a longer text is a run of its own."""
    data, offs = raw(texts)
    rows, a = len(offs) - 1, 0
    while a < rows:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + limit, "right")) - 1)
        yield a, b, data[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
        a = b


class Words:
    """Hashes of the words of texts. One object per task; it holds only tables of constants."""

    def __init__(self) -> None:
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.space = np.zeros(256, bool)
        self.space[[32, 9, 10, 11, 12, 13]] = True
        self.code = seeds(256, 7)[self.lower]  # of the lower-cased byte
        self.size = 0
        self._grow(PIECE_BYTES)

    def _grow(self, n: int) -> None:
        if n > self.size:
            self.power = np.full(n + 1, _ODD, np.uint64)
            self.inverse = np.full(n + 1, pow(_ODD, -1, 1 << 64), np.uint64)
            self.power[0] = self.inverse[0] = 1
            np.multiply.accumulate(self.power, out=self.power)
            np.multiply.accumulate(self.inverse, out=self.inverse)
            self.size = n

    def spans(self, data: np.ndarray, offs: np.ndarray, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Byte starts and ends of the words; words end at row ends too."""
        n = len(data)
        if not n:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        edge = np.zeros(n + 1, bool)
        edge[offs] = True
        dark = ~self.space[data]
        before = np.empty(n, bool)
        before[0] = True
        np.logical_not(dark[:-1], out=before[1:])
        before |= edge[:n]
        after = np.empty(n, bool)
        after[-1] = True
        np.logical_not(dark[1:], out=after[:-1])
        after |= edge[1:]
        return np.flatnonzero(dark & before), np.flatnonzero(dark & after) + 1

    def hashes(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash of each word, len + 1 offsets of each row's words)."""
        starts, ends = self.spans(data, offs)
        at = np.searchsorted(starts, offs)
        if not len(starts):
            return np.empty(0, np.uint64), at
        self._grow(len(data))
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.code[data] * self.power[:len(data)], out=total[1:])
        return mix((total[ends] - total[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64)), at


def shingles(words: np.ndarray, at: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of `size` words, offsets by row). A row of fewer words gives the whole row as one."""
    counts = np.diff(at)
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    out_at = np.concatenate([[0], np.cumsum(made)])
    out = np.empty(int(out_at[-1]), np.uint64)
    k = np.uint64(0xD1342543DE82EF95)
    full = counts >= size
    if full.any():
        n = len(words) - size + 1
        h = np.zeros(n, np.uint64)
        for j in range(size):
            h = h * k + words[j:n + j]
        last = np.repeat(at[1:], counts)[:n]
        rows_full = np.repeat(full, counts)[:n]
        out[np.repeat(full, made)] = h[(np.arange(n) + size <= last) & rows_full]
    for row in np.flatnonzero(~full & (counts > 0)):
        h = 0
        for w in words[at[row]:at[row + 1]]:
            h = (h * int(k) + int(w)) & _MASK
        out[out_at[row]] = (h + int(counts[row]) * _ODD) & _MASK
    return mix(out), out_at


def unique_by_row(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, and their offsets."""
    if not len(values):
        return values, at
    values = values.copy()
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a > 1:
            values[a:b].sort()
    keep = np.empty(len(values), bool)
    keep[0] = True
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    keep[at[:-1][at[:-1] < at[1:]]] = True
    return values[keep], np.concatenate([[0], np.cumsum(keep)])[at]


def by_row(ufunc: np.ufunc, values: np.ndarray, at: np.ndarray, empty) -> np.ndarray:
    """ufunc.reduceat per row, with `empty` for rows without values."""
    out = np.full(len(at) - 1, empty, values.dtype)
    some = at[:-1] < at[1:]
    if some.any():
        out[some] = ufunc.reduceat(values, at[:-1][some])
    return out


def characters(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and offsets by row."""
    lead = (data & 0xC0) != 0x80
    starts = np.flatnonzero(lead)
    at = np.searchsorted(starts, offs)
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
    first = padded[starts]
    points = first.copy()
    for low, high, keep, extra in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0x100, 0x07, 3)):
        some = np.flatnonzero((first >= low) & (first < high))
        if len(some):
            p = first[some] & keep
            for j in range(1, extra + 1):
                p = (p << 6) | (padded[starts[some] + j] & 0x3F)
            points[some] = p
    return points, at
