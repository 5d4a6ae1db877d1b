"""Vectorised word splitting and hashing over Arrow text columns, used inside Spark tasks.

Everything works on the UTF-8 bytes of a bounded slice of rows: words are runs of bytes that a 256-entry
table allows, so a text of any length is read whole and no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute

#: Bytes of text that are worked on at a time; bounds the memory of a task, not what is read.
SLICE_BYTES = 1_000_000

_BYTES = np.arange(256)
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: ``[^\x20\x09-\x0D]+``
NOT_SPACE = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased text
ALNUM = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if base not in _tables or len(_tables[base][0]) < n:
        m = 1 << max(16, int(n - 1).bit_length())
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            row = np.full(m, b, np.uint64)
            row[0] = 1
            pair.append(np.multiply.accumulate(row))
        _tables[base] = (pair[0], pair[1])
    up, down = _tables[base]
    return up[:n], down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = 0) -> np.ndarray:
    """64-bit hashes of values[start:end], starts ascending; equal spans hash equally wherever they stand."""
    if len(values) > 2 * SLICE_BYTES and len(starts) > 1:  # of a very long text, a stretch at a time
        cuts = np.searchsorted(starts, np.arange(SLICE_BYTES, len(values), SLICE_BYTES))
        groups = [g for g in np.split(np.arange(len(starts)), cuts) if len(g)]
        if len(groups) > 1:
            parts = [(g, starts[g[0]], ends[g].max()) for g in groups]
            return np.concatenate([span_hash(values[a:b], starts[g] - a, ends[g] - a, base) for g, a, b in parts])
    up, down = _powers(_BASES[base], len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=total[1:])
    out = (total[ends] - total[starts]) * down[starts]
    return mix(out + (ends - starts).astype(np.uint64) * np.uint64(_BASES[(base + 1) % 3]))


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct numbers; by sorting, which is many times faster than a hash table for large arrays."""
    values = np.sort(values)
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    return values[keep]


class Texts(NamedTuple):
    """A slice of rows: bytes of all texts, and for each row where it begins."""

    data: np.ndarray
    offsets: np.ndarray

    def words(self, allowed: np.ndarray, lower: bool = False) -> Words:
        data = LOWER[self.data] if lower else self.data
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = allowed[data]
        first = np.zeros(len(data) + 1, bool)
        first[self.offsets] = True
        starts = np.flatnonzero(inside[1:-1] & (first[:-1] | ~inside[:-2]))
        ends = np.flatnonzero(inside[1:-1] & (first[1:] | ~inside[2:])) + 1
        return Words(data, starts, ends, np.searchsorted(starts, self.offsets))


class Words(NamedTuple):
    """Words of a slice of rows: word w is data[starts[w]:ends[w]], row r has words rows[r]:rows[r + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray

    def hashes(self, base: int = 0) -> np.ndarray:
        return span_hash(self.data, self.starts, self.ends, base)

    def counts(self) -> np.ndarray:
        return np.diff(self.rows)

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), self.counts())

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words with one space after each, and where each begins and ends."""
        lengths = self.ends - self.starts
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        out = np.full(int(ends[-1]) + 1 if len(ends) else 0, 32, np.uint8)
        inside = np.zeros(len(self.data) + 1, np.int8)
        inside[self.starts] += 1
        inside[self.ends] -= 1
        to = np.zeros(len(out) + 1, np.int8)
        to[starts] += 1
        to[ends] -= 1
        out[np.cumsum(to[:-1], dtype=np.int8).view(bool)] = self.data[np.cumsum(inside[:-1], dtype=np.int8).view(bool)]
        return out.tobytes(), starts, ends


def texts(column: pa.Array) -> Texts:
    """The bytes of a string column; a null counts as an empty text."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `most` bytes of text; a longer text is a batch of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        part = (np.cumsum(sizes) - sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), len(sizes)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def per_row(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of values[rows[r]:rows[r + 1]]."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[rows[1:]] - total[rows[:-1]]
