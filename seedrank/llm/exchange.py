"""Counting 64-bit hashes of positions across all documents: which positions hold a repeated hash.

A *map* step turns chunks of documents into packed rows, a *bucket* step counts, and a *chunk* step
gathers the answers per document. Per chunk, hashes that repeat inside it are marked at once and
sent a single time, so a hash that holds a third of all positions costs one entry a chunk; others
are sent with their position. Hashes are split into buckets by ``bucket_of`` (their top bits, or
sampled splitters); a bucket's task sorts its hashes and marks those that occur twice or more.
Entries of a bucket and chunk travel as one binary value (sorted, byte planes apart, which the
shuffle compresses), so the shuffle moves about ten bytes a position and never a row each. Bucket
numbers follow the input size, which bounds what a task holds.

Chunk numbers come from the partition and the order of its rows, so a task that is run again
writes the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from seedrank.llm import text as T

#: packed rows: hashes with positions; hashes repeated in their chunk; positions known to repeat; documents
ASK, KNOWN, MARKED, DOCS = 0, 1, 2, 3
SCHEMA = "bucket int, chunk long, kind byte, a binary, b binary, c binary"


def planes(x: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of every value, one plane after the other."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unplane(raw: bytes, width: int) -> np.ndarray:
    p = np.frombuffer(raw, np.uint8).reshape(width, -1)
    out = np.zeros((p.shape[1], 8), np.uint8)
    out[:, :width] = p.T
    return out.view("<u8").ravel()


def top_bits(n: int) -> Callable[[np.ndarray], np.ndarray]:
    """Buckets by the top 32 bits, ascending with the hash."""
    return lambda h: ((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def requests(docs: DataFrame, items: Callable, buckets: Callable[[], tuple[Callable, int]], limit: int = 0, tell: bool = False) -> DataFrame:
    """Packed rows of ``docs`` (k, rid, text, ...). ``items(rows, data, offs)`` gives the hashes of a
    chunk, their positions (below 2^32), and the position at which each document begins. With
    ``tell``, a hash that repeats in its chunk also carries its first position and its number, and
    marked positions the first position of their hash, so that the bucket can answer for all."""
    def run(batches):
        bucket_of, n = buckets()
        part, number = TaskContext.get().partitionId(), 0
        for rows, data, offs in T.chunks(batches, "text", limit):
            h, pos, base = items(rows, data, offs)
            if not len(h):
                continue
            chunk = (part << 32) | number
            number += 1
            order = np.argsort(h, kind="stable")
            h, pos = h[order], pos[order]
            same = h[1:] == h[:-1]
            many = np.concatenate((same, [False])) | np.concatenate(([False], same))
            head = np.concatenate(([True], ~same))
            out = [(chunk % n, chunk, DOCS, rows.column(0).to_numpy().tobytes(), rows.column(1).to_numpy().tobytes(), base.astype(np.int64).tobytes())]
            if many.any():
                lead = np.flatnonzero(head)[np.cumsum(head) - 1][many]
                out.append((chunk % n, chunk, MARKED, planes(pos[many], 4), planes(pos[lead], 4) if tell else b"", b""))
            number_of = np.diff(np.append(np.flatnonzero(head), len(h)))[np.cumsum(head) - 1] if tell else None
            for kind, pick in ((ASK, ~many), (KNOWN, many & head)):
                hs, ps = h[pick], pos[pick]
                ns = number_of[pick] if tell else None
                b = bucket_of(hs).astype(np.int64)
                cut = np.concatenate(([0], np.flatnonzero(b[1:] != b[:-1]) + 1, [len(b)])) if len(b) else np.zeros(1, np.int64)
                for x, y in zip(cut[:-1], cut[1:]):
                    out.append((int(b[x]), chunk, kind, planes(hs[x:y], 8), planes(ps[x:y], 4) if kind == ASK or tell else b"", planes(ns[x:y], 4) if kind == KNOWN and tell else b""))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int8()), *(pa.array(c, pa.binary()) for c in cols[3:])],
                names=["bucket", "chunk", "kind", "a", "b", "c"])

    return docs.mapInArrow(run, SCHEMA)


def repeated(chunk: np.ndarray, kind: np.ndarray, a: list, b: list, c: list | None = None) -> list[tuple[int, bytes]]:
    """Of one bucket: (chunk, positions) of the hashes that occur at least twice."""
    at = [i for i in range(len(a)) if kind[i] in (ASK, KNOWN)]
    if not at:
        return []
    h = [unplane(a[i], 8) for i in at]
    size = np.array([len(x) for x in h])
    every = np.concatenate(h)
    known = np.repeat(kind[at] == KNOWN, size)
    order = np.argsort(every, kind="stable")
    s = every[order]
    same = s[1:] == s[:-1]
    many = np.concatenate((same, [False])) | np.concatenate(([False], same))
    hit = np.zeros(len(every), bool)
    hit[order] = many
    hit &= ~known
    out, lo = [], 0
    for i, n in zip(at, size.tolist()):
        m = hit[lo:lo + n]
        lo += n
        if kind[i] == ASK and m.any():
            out.append((int(chunk[i]), planes(np.sort(unplane(b[i], 4)[m]), 4)))
    return out


def answers(packed: DataFrame, find: Callable = repeated) -> DataFrame:
    """Packed rows by chunk: the marked positions and the documents."""
    def run(pdf):
        import pandas as pd

        kind = pdf["kind"].to_numpy()
        a, b, c = pdf["a"].tolist(), pdf["b"].tolist(), pdf["c"].tolist()
        out = [(int(pdf["chunk"].iloc[i]), int(kind[i]), a[i], b[i], c[i]) for i in np.flatnonzero(kind >= MARKED)]
        out += [(chunk, MARKED, pos, b"", b"") for chunk, pos in find(pdf["chunk"].to_numpy(), kind, a, b, c)]
        return pd.DataFrame(out, columns=["chunk", "kind", "a", "b", "c"])

    return packed.groupBy("bucket").applyInPandas(run, "chunk long, kind byte, a binary, b binary, c binary")


def per_document(answered: DataFrame, spans: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """(k, rid, spans binary) of the documents with marked positions; ``spans`` makes the value from
    a document's ascending positions (relative to its beginning)."""
    def run(pdf):
        import pandas as pd

        kind = pdf["kind"].to_numpy()
        marked = [unplane(x, 4) for x in pdf["a"][kind == MARKED]]
        out = []
        if marked:
            pos = np.sort(np.concatenate(marked)).astype(np.int64)
            row = pdf[kind == DOCS].iloc[0]
            k, rid, base = np.frombuffer(row["a"], np.int64), np.frombuffer(row["b"], np.int64), np.frombuffer(row["c"], np.int64)
            at = np.searchsorted(pos, np.append(base, np.iinfo(np.int64).max))
            for i in np.flatnonzero(at[1:] > at[:-1]):
                out.append((k[i], rid[i], spans(pos[at[i]:at[i + 1]] - base[i])))
        return pd.DataFrame(out, columns=["k", "rid", "spans"])

    return answered.groupBy("chunk").applyInPandas(run, "k long, rid long, spans binary")
