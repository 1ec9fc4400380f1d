"""Words and their hashes, computed over whole Arrow columns at once.

A word is a longest run of bytes outside ``\\x20`` and ``\\x09-\\x0D``. A word's hash is a
polynomial over its bytes, and a k-gram's hash a polynomial over its words' hashes, modulo 2**64;
both are mixed at the end. Different seeds give independent hashes.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

# Bytes hashed at a time: the arrays made for them are some fifty times as large.
SLICE_BYTES = 1 << 20


class Columns(NamedTuple):
    """The bytes of a text column, and where each row begins (one more than rows)."""

    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Where words begin and end in ``data``, and the number of the first word of each row."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def _odd(seed: int, n: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def byte_table(seed: int, fold_case: bool = False) -> np.ndarray:
    table = _odd(seed, 256)
    if fold_case:
        table[65:91] = table[97:123]
    return table


def powers(seed: int, n: int) -> np.ndarray:
    out = np.full(n, _odd(seed + 1_000_003, 1)[0])
    out[:1] = 1
    return np.multiply.accumulate(out)


def columns(values: pa.Array | pa.ChunkedArray) -> Columns:
    """Null counts as empty."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    values = values.cast(pa.large_binary()).fill_null(b"")
    if not len(values):
        return Columns(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    held = values.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    return Columns(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def split(text: Columns) -> Words:
    data, offsets = text
    inside = ~SPACE[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[edges] = inside[edges]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    stops[last] = inside[last]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets))


def _hash(data: np.ndarray, words: Words, table: np.ndarray, seed: int) -> np.ndarray:
    sizes = words.ends - words.starts
    if not len(sizes):
        return np.zeros(0, np.uint64)
    heads = np.cumsum(sizes) - sizes
    within = np.arange(sizes.sum()) - np.repeat(heads, sizes)
    at = within + np.repeat(words.starts, sizes)
    each = table[data[at]] * powers(seed, int(sizes.max()))[within]
    return mix(np.add.reduceat(each, heads) + sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def slices(text: Columns, limit: int = SLICE_BYTES):
    """Ranges of rows of about ``limit`` bytes; a longer row is alone."""
    offsets, row = text.offsets, 0
    while row < len(offsets) - 1:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end
        row = end


def hashes(text: Columns, *seeds: int, fold_case: bool = False) -> tuple[list[np.ndarray], np.ndarray]:
    """A hash of every word for each seed, and the number of each row's first word."""
    tables = [byte_table(s, fold_case) for s in seeds]
    parts: list[list[np.ndarray]] = [[] for _ in seeds]
    counts = [np.zeros(1, np.int64)]
    for row, end in slices(text):
        part = Columns(text.data[text.offsets[row] : text.offsets[end]], text.offsets[row : end + 1] - text.offsets[row])
        words = split(part)
        counts.append(np.diff(words.first))
        for out, table, seed in zip(parts, tables, seeds, strict=True):
            out.append(_hash(part.data, words, table, seed))
    joined = [np.concatenate(p) if p else np.zeros(0, np.uint64) for p in parts]
    return joined, np.cumsum(np.concatenate(counts))


def grams(words: np.ndarray, k: int, seed: int) -> np.ndarray:
    """The hash of the ``k`` words from each word on, across the ends of rows."""
    n = max(0, len(words) - k + 1)
    out = np.zeros(n, np.uint64)
    for j, p in enumerate(powers(seed, k)):
        out += words[j : j + n] * p
    return mix(out)


def rows_of(first: np.ndarray) -> np.ndarray:
    """The row of each word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def whole(first: np.ndarray, k: int) -> np.ndarray:
    """The words from which ``k`` words of the same row begin."""
    n = int(first[-1])
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    return np.flatnonzero(left >= k)


def binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary value for each range of ``values`` between two bounds."""
    offsets = np.asarray(bounds, np.int64) * values.itemsize
    kept = np.ascontiguousarray(values)
    return pa.Array.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(kept.tobytes())]
    ).cast(pa.binary())


def unpack(values: pa.Array | pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """All values of binary cells, and how many each cell has."""
    data, offsets = columns(values)
    return np.frombuffer(data.tobytes(), kind), np.diff(offsets) // np.dtype(kind).itemsize
