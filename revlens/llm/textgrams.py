"""Word hashes of whole Arrow text columns, without a Python call per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_GOLD, _M1, _M2 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)

#: Bytes that separate words: white space, or all ASCII but letters and digits.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[:0x80] = True
for _a, _b in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    NON_ALNUM[_a : _b + 1] = False

#: Text bytes worked on at once; the arrays made of them take some 60 times this.
STEP_BYTES = 1_000_000


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x + _GOLD
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


def text_column(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """Large strings in one piece, NULL as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def steps(texts: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges with at most ``limit`` bytes each (or one longer text)."""
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        base = sizes[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(sizes, base + limit, "right")))
        yield at, end
        at = end


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a large-string array and the offsets of its rows."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


_POWERS = mix64(np.arange(256, dtype=np.uint64)) | U(1)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        _POWERS = mix64(np.arange(2 * n, dtype=np.uint64)) | U(1)
    return _POWERS


def word_hashes(texts: pa.Array, breaks: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and the offsets of each row's words.

    A word is a run of bytes outside ``breaks`` inside one row. Its hash sums
    byte times a pseudo-random odd number by place, then mixes the bits.
    """
    flat, offsets = raw(pc.utf8_lower(texts) if lower else texts)
    n = len(flat)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    inside = ~breaks[flat]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    row_starts = offsets[:-1][offsets[:-1] < n]
    first[row_starts] = inside[row_starts]
    starts = np.flatnonzero(first)
    rows = np.searchsorted(starts, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), rows
    at = np.flatnonzero(inside)
    word_of = np.cumsum(first[at]) - 1
    place = at - starts[word_of]
    values = (flat[at].astype(np.uint64) + U(1)) * _powers(int(place.max()) + 1)[place]
    begin = np.flatnonzero(first[at])
    return mix64(np.add.reduceat(values, begin)), rows


def shingles(words: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside a row, and row offsets.

    A row of fewer words (but at least one) has one shingle of all of them.
    """
    counts = np.diff(rows)
    out_counts = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_rows = np.concatenate([[0], np.cumsum(out_counts)]).astype(np.int64)
    total = int(out_rows[-1])
    if total == 0:
        return np.zeros(0, np.uint64), out_rows
    row_of = np.repeat(np.arange(len(counts)), out_counts)
    start = np.arange(total) - out_rows[row_of] + rows[row_of]
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    short = counts[row_of] < size
    acc = np.zeros(total, np.uint64)
    for k in range(size):
        part = padded[start + k]
        if short.any():
            part = np.where(short & (k >= counts[row_of]), U(0), part)
        acc = (acc + part) * (_M1 + U(2 * k))
        acc ^= acc >> U(29)
    return mix64(acc), out_rows
