"""Arrow text columns as byte arrays: words and shingles hashed without a Python loop.

Everything here works on one block of rows inside a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of text that are held as arrays at a time.
BLOCK = 2 << 20

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
#: Word bytes where words are `[^\x20\x09-\x0D]+`.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        factors = np.full(max(n, BLOCK), base & (1 << 64) - 1, U)
        factors[0] = 1
        known = _powers[base] = np.cumprod(factors, dtype=U)
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A well spread 64-bit value of each value (the splitmix64 finaliser)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_CODES = mix(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its row offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)
    ends = ends[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[ends[0] : ends[-1]], ends - ends[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches so that a block's texts stay near BLOCK bytes; a longer text is alone."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        sofar = np.cumsum(size.astype(np.int64))
        at = 0
        while at < batch.num_rows:
            base = sofar[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(sofar, base + BLOCK, "right")))
            yield batch.slice(at, end - at)
            at = end


def words(
    data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = NOT_BLANK, lower: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and the word offsets of the rows."""
    n = len(data)
    if n == 0:
        return np.zeros(0, U), np.zeros(len(offsets), np.int64)
    inside = np.append(is_word[data], False)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1]))
    starts = np.flatnonzero(inside & (~before | edge))
    ends = np.flatnonzero(before & (~inside | edge))
    folded = ASCII_LOWER[data] if lower else data
    sums = np.empty(n + 1, U)
    sums[0] = 0
    np.cumsum(_CODES[folded] * powers(_BASE, n), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * powers(_INVERSE, n + 1)[starts] + U(1))
    return hashes, np.searchsorted(starts, offsets).astype(np.int64)


def shingles(
    hashes: np.ndarray, offsets: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words, in order, and their row offsets.

    A row of fewer words, but not none, has its whole sequence as its only shingle.
    """
    size = np.diff(offsets)
    count = np.where(size >= n, size - n + 1, np.minimum(size, 1))
    out = np.concatenate(([0], np.cumsum(count)))
    total = int(out[-1])
    if total == 0:
        return np.zeros(0, U), out
    row = np.repeat(np.arange(len(size)), count)
    at = np.arange(total) - out[row] + offsets[row]
    width = np.minimum(size, n)[row]
    value = width.astype(U)
    padded = np.append(hashes, np.zeros(n, U))
    for j in range(n):
        value = mix(value * U(0xD6E8FEB86659FD93) + np.where(j < width, padded[at + j], U(0)))
    return value, out


def sets(value: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct values in ascending order, and their row offsets."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[keep], row[keep]
    return value, np.searchsorted(row, np.arange(len(offsets))).astype(np.int64)


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType | None = None) -> pa.ListArray:
    flat = pa.array(values.view(np.int64) if values.dtype == U else values, kind)
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), flat)
