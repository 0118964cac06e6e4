"""Flat numpy views of Arrow text columns: words, lines and rolling hashes without a loop over rows.

A text column is one byte array plus offsets; every helper works on all texts of a piece at once. Pieces
are cut at row borders and hold about ``PIECE_BYTES`` of text (a longer single text is a piece of its own),
so the memory of a task is a fixed multiple of that, whatever the size of Arrow's batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20

U64 = np.uint64
#: An odd base for polynomial hashes modulo 2**64, and its inverse.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)

#: ASCII white space: blank and 0x09 to 0x0D, the complement of a word character.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
BYTE_CODES = np.random.Generator(np.random.PCG64(20240901)).integers(1, 1 << 63, 256, dtype=U64) | U64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out, dtype=U64)


def powers(n: int, base: int = BASE) -> np.ndarray:
    """``base ** 0 .. base ** (n - 1)`` modulo 2**64; kept for the usual piece size."""
    if n <= 2 * PIECE_BYTES:
        return _powers(2 * PIECE_BYTES, base)[:n]
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out, dtype=U64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and ``len + 1`` offsets of a string column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def pieces(batches: Iterator[pa.RecordBatch], *columns: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches, each with about ``limit`` bytes of the text columns."""
    for batch in batches:
        if not batch.num_rows:
            continue
        total = sum(utf8(batch.column(c))[1] for c in columns)
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(total, total[start] + limit, "right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def rows_of(at: np.ndarray) -> np.ndarray:
    """For each byte its row, from offsets."""
    return np.repeat(np.arange(len(at) - 1), np.diff(at))


def per_row(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many flags are set between each two offsets."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word: a maximal run of bytes that are not ASCII white space."""
    inside = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[at] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def line_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r"""Start, end (without the line feed) and row of every ``\n``-split line; an empty text has one line."""
    breaks = np.flatnonzero(data == 10)
    row = np.searchsorted(at, breaks, "right") - 1
    n = len(at) - 1
    starts = np.concatenate([at[:-1], breaks + 1])
    ends = np.concatenate([breaks, at[1:]])
    order = np.lexsort((starts, np.concatenate([np.arange(n), row])))
    order_end = np.lexsort((ends, np.concatenate([row, np.arange(n)])))
    return starts[order], ends[order_end], np.concatenate([np.arange(n), row])[order]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums of ``code[byte] * BASE ** position``; the hash of any span follows from two of them."""
    out = np.zeros(len(data) + 1, dtype=U64)
    np.cumsum(BYTE_CODES[data] * powers(max(1, len(data)))[: len(data)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, equal for equal bytes wherever they stand."""
    shift = powers(max(1, len(sums)), INVERSE)[starts]
    return mix((sums[ends] - sums[starts]) * shift + (ends - starts).astype(U64))


def combine(*hashes: np.ndarray) -> np.ndarray:
    """An order-sensitive hash of hashes."""
    out = hashes[0].astype(U64)
    for h in hashes[1:]:
        out = mix(out * U64(BASE) + h.astype(U64))
    return out


def run_lengths(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of every run of equal keys."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    return first, np.diff(np.append(first, len(sorted_keys)))


def as_binary(data: np.ndarray, at: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """The Arrow column of the given bytes and offsets."""
    kind = kind or pa.binary()
    return pa.Array.from_buffers(kind, len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def as_lists(values: np.ndarray, at: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The Arrow list column of the given values and offsets."""
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values, type=kind))
