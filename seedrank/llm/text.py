"""Vectorised text helpers for code that runs inside Spark tasks (numpy over Arrow buffers).

A *chunk* is a run of whole documents of one Arrow batch: ``data`` (their UTF-8 bytes, one
array) and ``offs`` (n + 1 byte offsets). No helper looks across documents. Working memory is
about 60 bytes per byte of a chunk; a chunk holds ``CHUNK_BYTES`` of text, or one longer document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Invertible mixing of 64-bit values (a fixed finaliser; spreads low and high bits)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U64(30))
        x = x * U64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> U64(27))
        x = x * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


#: one random 64-bit value per byte, from a rule
BYTE_VALUES = mix64(np.arange(1, 257, dtype=U64) * U64(_BASE))

_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, at least ``n`` of each."""
    if len(_POWERS["up"]) < n:
        m = 1 << max(16, (n - 1).bit_length())
        inverse = pow(_BASE, -1, 1 << 64)
        for name, b in (("up", _BASE), ("down", inverse)):
            f = np.full(m, b, U64)
            f[0] = 1
            with np.errstate(over="ignore"):
                _POWERS[name] = np.cumprod(f, dtype=U64)
    return _POWERS["up"], _POWERS["down"]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums of ``values[i] * base^i`` modulo 2^64 (n + 1 entries)."""
    out = np.zeros(len(values) + 1, U64)
    with np.errstate(over="ignore"):
        np.cumsum(values * powers(len(values) + 1)[0][: len(values)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rabin-Karp hash of every span [start, end) from the prefix sums, mixed with its length."""
    with np.errstate(over="ignore"):
        h = (prefix[end] - prefix[start]) * powers(len(prefix))[1][start]
        return mix64(h + (end - start).astype(U64) * U64(0xD1B54A32D192ED03))


def byte_hash(data: np.ndarray) -> np.ndarray:
    return prefix_hash(BYTE_VALUES[data])


def class_table(separators) -> np.ndarray:
    """Boolean table over bytes: True for bytes that belong to words."""
    t = np.ones(256, bool)
    t[list(separators)] = False
    return t


#: bytes outside ``[^\x20\x09-\x0D]``
SPACE_SEPARATED = class_table([0x20, *range(0x09, 0x0E)])
#: bytes outside ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``
ALNUM_WORDS = class_table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def words(data: np.ndarray, offs: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a chunk, and the first word index of each document (n + 1)."""
    n = len(data)
    m = in_word[data]
    before = np.zeros(n, bool)
    after = np.zeros(n, bool)
    if n:
        before[1:] = m[:-1]
        after[:-1] = m[1:]
        before[offs[:-1][offs[:-1] < n]] = False
        after[offs[1:][offs[1:] > 0] - 1] = False
    starts = np.flatnonzero(m & ~before)
    ends = np.flatnonzero(m & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs)


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of an Arrow string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def chunks(batches, column: str, limit: int = 0) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut Arrow batches into chunks of whole rows: (rows, bytes, offsets)."""
    limit = limit or CHUNK_BYTES
    for batch in batches:
        data, offs = text_buffers(batch.column(batch.schema.get_field_index(column)))
        lo, n = 0, batch.num_rows
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
            hi = min(hi, n)
            yield batch.slice(lo, hi - lo), data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
            lo = hi


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated ranges [start, start + length)."""
    lengths = lengths.astype(np.int64)
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    keep = lengths > 0
    s, ln = starts[keep].astype(np.int64), lengths[keep]
    at = np.concatenate(([0], np.cumsum(ln)[:-1]))
    out[0] = s[0]
    out[at[1:]] = s[1:] - (s[:-1] + ln[:-1] - 1)
    return np.cumsum(out)


def covered(starts: np.ndarray, length: int | np.ndarray, touching: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of [start, start + length), starts ascending; spans that only touch
    are one run if ``touching``."""
    if not len(starts):
        return starts, starts
    end = np.maximum.accumulate(starts + length)
    cut = np.flatnonzero(starts[1:] > end[:-1] if touching else starts[1:] >= end[:-1]) + 1
    return starts[np.concatenate(([0], cut))], end[np.concatenate((cut - 1, [len(starts) - 1]))]


def mark(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Boolean array of length ``n``, True inside the disjoint spans."""
    d = np.zeros(n + 1, np.int8)
    d[starts] += 1
    d[ends] -= 1
    return np.cumsum(d[:-1], dtype=np.int8).astype(bool)


def segment_sum(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive entries of ``first`` (n + 1 bounds)."""
    c = np.concatenate((np.zeros(1, np.int64 if values.dtype.kind in "bui" else values.dtype), np.cumsum(values, dtype=np.int64 if values.dtype.kind in "bui" else None)))
    return c[first[1:]] - c[first[:-1]]
