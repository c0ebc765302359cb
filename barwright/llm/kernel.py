"""Numpy helpers that tasks run on the UTF-8 bytes of a whole batch of texts at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that separate words: space, tab, newline, vertical tab, form feed, carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Bytes outside [0-9A-Za-z] and below 0x80.
SYMBOL = np.zeros(256, bool)
SYMBOL[:0x80] = True
for _low, _high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    SYMBOL[_low:_high] = False

_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser; another salt gives another hash."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((salt * _BYTE_BASE + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[starts[i]:ends[i]] for every i, modulo 2^64, from one prefix sum."""
    n = len(values)
    with np.errstate(over="ignore"):
        prefix = np.empty(n + 1, np.uint64)
        prefix[0] = 0
        np.cumsum(values * powers(base, n)[:n], out=prefix[1:])
        return (prefix[ends] - prefix[starts]) * powers(_inverse(base), n)[starts]


@dataclass
class Words:
    """The words of a batch of texts, in order; doc i owns words first[i]:first[i + 1]."""

    data: np.ndarray  # all bytes of the batch
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hash: np.ndarray  # 64 bits of each word

    def grams(self, size: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(hash, first word) of every run of ``size`` words inside one document."""
        n = len(self.starts)
        if n < size:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        at = np.arange(n - size + 1)
        doc_end = np.repeat(self.first[1:], np.diff(self.first))
        at = at[at + size <= doc_end[: n - size + 1]]
        return mix(range_hash(mix(self.hash, salt), at, at + size, _WORD_BASES[salt % 2]), salt), at

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    if data is None or bounds[-1] == bounds[0]:
        return np.empty(0, np.uint8), bounds - bounds[0]
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def split(texts: pa.Array, separators: np.ndarray = SPACE, fold: bool = False) -> Words:
    """Cut texts into maximal runs of bytes that are no separators; ``fold`` lower-cases A-Z first."""
    data, bounds = buffers(texts)
    if fold:
        data = lower_ascii(data)
    inside = ~separators[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    # a text ends where the next begins, whatever bytes meet there
    lengths = np.diff(bounds)
    heads = bounds[:-1][lengths > 0]
    tails = bounds[1:][lengths > 0] - 1
    opens[heads] = inside[heads]
    closes[tails] = inside[tails]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    first = np.searchsorted(starts, bounds)
    return Words(data, starts, ends, first, word_hashes(data, starts, ends))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int = 1 << 18) -> np.ndarray:
    """The hash of each word; ``step`` bytes at a time, as the sums take many times the room of the text."""
    out, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        low = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, low + step, "right")))
        own = data[low : ends[stop - 1]].astype(np.uint64) + np.uint64(1)
        out[at:stop] = range_hash(own, starts[at:stop] - low, ends[at:stop] - low, _BYTE_BASE)
        at = stop
    return mix(out)


def slices(table: pa.RecordBatch, column: str | int, most_bytes: int = 1 << 20):
    """Parts of a batch whose texts hold about ``most_bytes``; one longer text is a part of its own."""
    lengths = pc.fill_null(pc.binary_length(table.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.cumsum(lengths)
    at = 0
    while at < len(lengths):
        before = total[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(total, before + most_bytes, "right")))
        yield table.slice(at, stop - at)
        at = stop
