"""Byte-level deduplication with a partitioned sparse suffix array.

Removed is every byte under a ``length``-byte string that also starts anywhere else. Suffixes are
taken at content-defined positions only: a string's *anchor* is its leftmost position with the
smallest hash of ``LEAD`` bytes, so equal strings have their anchors at the same offset, and the
consecutive strings that share an anchor form one *run*. A run's record is the suffix from its
anchor (as far as the run's last string reaches) together with the bytes before it that its first
string needs; two strings are equal only if their records agree to the left and right of anchors
whose suffixes share the first ``LEAD`` bytes. About one suffix in 70 positions is enough.

1. Anchors are counted by hash (``exchange``): a suffix whose leading bytes occur once is dropped.
2. The records of the others are range-partitioned by their leading bytes with splitters sampled
   from the texts. Equal records of a chunk travel once. Suffixes that agree in all leading bytes
   are never separated by a splitter, so no comparison crosses a bucket boundary.
3. A bucket sorts its records by multikey quicksort on 8-byte tokens (all groups at once, singles
   leave) and compares neighbours: equal records are repeated as a whole; among the distinct
   records of an anchor group every string is sorted the same way, and equal strings are repeated.
4. The repeated spans are merged per document and joined with the texts.

An anchor that occurs in more than ``HOT`` records would make a large group: its strings are dealt
by their own 64-bit Rabin-Karp hashes instead, one entry a string and chunk (the exact way for the
rest, but for an expected n^2 / 2^65 false pairs).

Null texts are empty. Strings never cross documents. Repeated rows remove each other; a null doc_id
is kept; rows that share an id but not a text stay apart. Extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedrank.llm import exchange as X
from seedrank.llm import text as T
from seedrank.llm.tables import Staged, keyed, n_buckets

LENGTH = 200
LEAD = 64
HOT = 2_000
#: leading bytes that splitters compare, and sampled suffixes per bucket
TOKEN = 32
SAMPLES = 64
#: input bytes per bucket; a bucket's sort needs about 30 bytes per byte of its records
BUCKET_BYTES = 2 << 20

#: further kinds of packed rows: records of runs, and strings of hot anchors
RUNS = 4


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def runs(data: np.ndarray, offs: np.ndarray, length: int, lead: int, prefix: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first string start, last string start, anchor) of every run of a chunk."""
    n = len(data)
    if n < length:
        return (np.zeros(0, np.int64),) * 3
    prefix = T.byte_hash(data) if prefix is None else prefix
    with np.errstate(over="ignore"):
        h = T.mix64((prefix[lead:] - prefix[:-lead]) * T.powers(n + 1)[1][: n + 1 - lead])
    bits = np.uint64(max(1, int(n).bit_length()))
    key = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)
    anchor = (sliding_min(key, length - lead + 1) & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    size = np.diff(offs)
    valid = np.zeros(len(anchor) + 1, np.int64)
    full = size >= length
    np.add.at(valid, offs[:-1][full], 1)
    np.add.at(valid, offs[1:][full] - length + 1, -1)
    ok = np.cumsum(valid)[:-1] > 0
    new = ok.copy()
    new[1:] &= (anchor[1:] != anchor[:-1]) | ~ok[:-1]
    # a document boundary always starts a run
    starts = offs[:-1][full]
    new[starts] = True
    lo = np.flatnonzero(new)
    last = ok.copy()
    last[:-1] &= (new[1:] | ~ok[1:])
    return lo, np.flatnonzero(last), anchor[lo]


def anchor_items(length: int, lead: int):
    def items(rows, data, offs):
        prefix = T.byte_hash(data)
        _, _, a = runs(data, offs, length, lead, prefix)
        a = np.unique(a)
        return T.span_hash(prefix, a, a + lead), a, offs[:-1]
    return items


def find_anchors(hot: int):
    """Bucket step of the anchors: repeated ones, with bit 31 set for those of more than ``hot``."""
    def find(chunk, kind, a, b, c):
        at = [i for i in range(len(a)) if kind[i] in (X.ASK, X.KNOWN)]
        if not at:
            return []
        h = [X.unplane(a[i], 8) for i in at]
        number = np.concatenate([X.unplane(c[i], 4) if kind[i] == X.KNOWN else np.ones(len(x), np.uint64) for i, x in zip(at, h)])
        _, inv = np.unique(np.concatenate(h), return_inverse=True)
        count = np.bincount(inv, weights=number)[inv]
        out, lo = [], 0
        for i, part in zip(at, h):
            n = count[lo:lo + len(part)]
            lo += len(part)
            tell = n > (1 if kind[i] == X.ASK else hot)
            if tell.any():
                pos = X.unplane(b[i], 4)
                out.append((int(chunk[i]), X.planes(np.where(n > hot, pos | np.uint64(1 << 31), pos)[tell], 4)))
        return out
    return find


def per_document_anchors(answered: DataFrame) -> DataFrame:
    """(k, rid, spans): uint32 anchors relative to the document, bit 31 set for hot ones."""
    def run(pdf):
        import pandas as pd

        rows = [(a, b) for a, b, kind in zip(pdf["a"], pdf["b"], pdf["kind"]) if kind == X.MARKED]
        out = []
        if rows:
            told = np.concatenate([X.unplane(a, 4) for a, b in rows if not b] or [np.zeros(0, np.uint64)]).astype(np.int64)
            hot_first = told[told >> 31 == 1] & ((1 << 31) - 1)
            every = [told]
            for a, b in rows:  # repeated in the chunk: hot if the first position of the hash is
                if b:
                    every.append(X.unplane(a, 4).astype(np.int64) | (np.isin(X.unplane(b, 4).astype(np.int64), hot_first).astype(np.int64) << 31))
            raw = np.concatenate(every)
            hot, pos = raw >> 31, raw & ((1 << 31) - 1)
            order = np.lexsort((hot, pos))
            hot, pos = hot[order], pos[order]
            last = np.append(pos[1:] != pos[:-1], True)
            hot, pos = hot[last], pos[last]
            row = pdf[pdf["kind"] == X.DOCS].iloc[0]
            k, rid, base = (np.frombuffer(row[c], np.int64) for c in "abc")
            at = np.searchsorted(pos, np.append(base, np.iinfo(np.int64).max))
            for i in np.flatnonzero(at[1:] > at[:-1]):
                s = slice(at[i], at[i + 1])
                out.append((k[i], rid[i], ((pos[s] - base[i]) | (hot[s] << 31)).astype(np.uint32).tobytes()))
        return pd.DataFrame(out, columns=["k", "rid", "spans"])

    return answered.groupBy("chunk").applyInPandas(run, "k long, rid long, spans binary")


def sample_splitters(rows: DataFrame, n: int, length: int, lead: int) -> np.ndarray:
    """Ascending splitters (``TOKEN`` leading bytes) from the anchors of a sample of the documents,
    bounded by ``SAMPLES`` a bucket."""
    total = rows.count()
    if not total or n < 2:
        return np.zeros(0, f"S{TOKEN}")
    per_doc = 8
    share = min(1.0, 2 * n * SAMPLES / per_doc / total)

    def run(batches):
        for _, data, offs in T.chunks(batches, "text"):
            _, _, a = runs(data, offs, length, lead)
            doc = np.searchsorted(offs, a, side="right") - 1
            rank = np.arange(len(a)) - np.searchsorted(doc, doc)
            many = np.bincount(doc, minlength=len(offs))[doc] if len(a) else a
            pick = a[(rank * per_doc) // np.maximum(1, many) != ((rank - 1) * per_doc) // np.maximum(1, many)] if len(a) else a
            yield pa.RecordBatch.from_arrays([pa.array([data[p:p + TOKEN].tobytes() for p in pick], pa.binary())], names=["lead"])

    got = rows.filter(F.pmod(F.xxhash64("rid", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("text").mapInArrow(run, "lead binary")
    s = np.sort(np.array([bytes(r["lead"]) for r in got.limit(4 * n * SAMPLES).collect()], f"S{TOKEN}"))
    return np.unique(s[np.linspace(0, len(s) - 1, n + 1).astype(int)[1:-1]]) if len(s) else s


def run_records(rows: DataFrame, splitters: np.ndarray, n: int, length: int, lead: int) -> DataFrame:
    """Packed records of the candidate runs of ``rows`` (k, rid, text, spans)."""
    shared = rows.sparkSession.sparkContext.broadcast(splitters)

    def run(batches):
        cuts, part, number = shared.value, TaskContext.get().partitionId(), 0
        hashed = X.top_bits(n)
        for b, data, offs in T.chunks(batches, "text"):
            prefix = T.byte_hash(data)
            lo, hi, a = runs(data, offs, length, lead, prefix)
            cand = np.zeros(len(data) + 1, np.int8)
            for i, s in enumerate(b.column(b.schema.get_field_index("spans")).to_pylist()):
                p = np.frombuffer(s, np.uint32)
                cand[offs[i] + (p & np.uint32((1 << 31) - 1))] = 1 + (p >> np.uint32(31))
            state = cand[a]
            chunk = (part << 32) | number
            number += 1
            out = [(chunk % n, chunk, X.DOCS, b.column(0).to_numpy().tobytes(), b.column(1).to_numpy().tobytes(), offs[:-1].astype(np.int64).tobytes())]
            known = []
            # records of ordinary anchors
            s, e, at = lo[state == 1], hi[state == 1] + length, a[state == 1]
            with np.errstate(over="ignore"):
                key = T.mix64(T.span_hash(prefix, s, e) + (at - s).astype(np.uint64))
            _, one, inv, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            twice = count[inv] > 1
            known.append(np.stack([s[twice], e[twice]], axis=1))
            s, e, at, many = s[one], e[one], at[one], count > 1
            token = np.ascontiguousarray(data[at[:, None] + np.arange(TOKEN)]).view(f"S{TOKEN}").ravel() if len(at) else np.zeros(0, f"S{TOKEN}")
            bucket = np.searchsorted(cuts, token, side="right")
            order = np.lexsort((token, bucket))
            s, e, at, many, bucket = s[order], e[order], at[order], many[order], bucket[order]
            for x, y in groups(bucket):
                meta = np.stack([e[x:y] - s[x:y], at[x:y] - s[x:y], np.where(many[x:y], -1, s[x:y])]).astype(np.int32)
                out.append((int(bucket[x]), chunk, RUNS, data[T.ragged(s[x:y], e[x:y] - s[x:y])].tobytes(), meta.tobytes(), b""))
            # strings of hot anchors
            w = T.ragged(lo[state == 2], hi[state == 2] - lo[state == 2] + 1)
            h = T.span_hash(prefix, w, w + length)
            _, one, inv, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
            twice = count[inv] > 1
            known.append(np.stack([w[twice], w[twice] + length], axis=1))
            for kind, pick in ((X.ASK, count == 1), (X.KNOWN, count > 1)):
                hs, ps = h[one][pick], w[one][pick]
                bucket = hashed(hs).astype(np.int64)
                for x, y in groups(bucket):
                    out.append((int(bucket[x]), chunk, kind, X.planes(hs[x:y], 8), X.planes(ps[x:y], 4), b""))
            known = np.concatenate(known)
            if len(known):
                out.append((chunk % n, chunk, X.MARKED, merged(known).tobytes(), b"", b""))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int8()), *(pa.array(c, pa.binary()) for c in cols[3:])],
                names=["bucket", "chunk", "kind", "a", "b", "c"])

    return rows.mapInArrow(run, X.SCHEMA)


def groups(sorted_keys: np.ndarray) -> list[tuple[int, int]]:
    if not len(sorted_keys):
        return []
    cut = np.concatenate(([0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1, [len(sorted_keys)]))
    return list(zip(cut[:-1].tolist(), cut[1:].tolist()))


def merged(spans: np.ndarray, touching: bool = False) -> np.ndarray:
    """Union of (start, end) spans as int32 pairs. In a chunk, spans that touch stay apart: they may
    belong to neighbouring documents."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    s, e = T.covered(spans[:, 0].astype(np.int64), spans[:, 1].astype(np.int64) - spans[:, 0], touching)
    return np.stack([s, e], axis=1).astype(np.int32)


def tokens_at(data: np.ndarray) -> np.ndarray:
    """The 8-byte token (big-endian value) that begins at every byte; zero bytes follow the end."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    out = np.zeros(len(data), np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | padded[j:j + len(data)]
    return out


def multikey(group: np.ndarray, token: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Multikey sort of strings in one group number each: strings are told apart token by token, and
    those that are alone leave the sort. Result: group numbers, equal if and only if the initial
    group and the ``length`` bytes from ``start`` are equal."""
    group = np.unique(group, return_inverse=True)[1].astype(np.int64)
    top = int(group.max(initial=-1)) + 1
    active = np.flatnonzero(np.bincount(group, minlength=top)[group] > 1) if len(group) else np.zeros(0, np.int64)
    j = 0
    while len(active):
        left = length[active] - j
        active, left = active[left > 0], left[left > 0]
        if not len(active):
            break
        # of the last token only the bytes inside the string count
        t = token[start[active] + j] >> (np.uint64(8) * (8 - np.minimum(left, 8)).astype(np.uint64))
        g = group[active]
        order = np.lexsort((t, g))
        g, t, active = g[order], t[order], active[order]
        new_g = np.concatenate(([True], g[1:] != g[:-1]))
        new = new_g | np.concatenate(([True], t[1:] != t[:-1]))
        part = np.cumsum(new) - 1
        size = np.bincount(part)[part]
        first_of_group = np.maximum.accumulate(np.where(new_g, part, 0))
        split = part != first_of_group  # the first part keeps the group's number
        group[active] = np.where(split, top + part, g)
        top += int(part[-1]) + 1
        active = active[size > 1]
        j += 8
    return group


def repeated_spans(length: int, lead: int):
    """Bucket step of the records: (chunk, spans) of repeated strings."""
    def find(chunk, kind, a, b, c):
        out = []
        at = [i for i in range(len(a)) if kind[i] in (X.ASK, X.KNOWN)]
        if at:
            for owner, pos in X.repeated(chunk[at], kind[at], [a[i] for i in at], [b[i] for i in at]):
                w = X.unplane(pos, 4).astype(np.int64)
                out.append((owner, merged(np.stack([w, w + length], axis=1)).tobytes()))
        at = [i for i in range(len(a)) if kind[i] == RUNS]
        if not at:
            return out
        data = np.frombuffer(b"".join(a[i] for i in at), np.uint8)
        meta = np.concatenate([np.frombuffer(b[i], np.int32).reshape(3, -1) for i in at], axis=1).astype(np.int64)
        owner = np.repeat(chunk[at], [len(b[i]) // 12 for i in at])
        size, off, pos = meta
        start = np.concatenate(([0], np.cumsum(size)[:-1]))
        token = tokens_at(data)
        # equal records (same bytes, same anchor)
        same = multikey(size * 4096 + off if length < 2048 else size * (1 << 32) + off, token, start, size)
        _, one, inv, count = np.unique(same, return_index=True, return_inverse=True, return_counts=True)
        whole = (count > 1)[inv] | (np.bincount(inv, weights=pos < 0) > 0)[inv]
        spans = [np.stack([owner, pos, pos + size], axis=1)[whole & (pos >= 0)]]
        # distinct records of an anchor group: its strings
        d_start, d_size, d_off, d_pos, d_owner, d_whole = (v[one] for v in (start, size, off, pos, owner, whole))
        anchor = multikey(np.zeros(len(one), np.int64), token, d_start + d_off, np.full(len(one), lead))
        members = np.bincount(anchor)[anchor] if len(one) else anchor
        open_ = np.bincount(anchor, weights=~d_whole)[anchor] > 0 if len(one) else anchor
        pick = np.flatnonzero((members > 1) & open_)
        if len(pick):
            n_str = d_size[pick] - length + 1
            rec = np.repeat(pick, n_str)
            w = T.ragged(np.zeros(len(pick), np.int64), n_str)
            group = anchor[rec] * 4096 + (d_off[rec] - w) if length < 2048 else anchor[rec] * (1 << 24) + (d_off[rec] - w)
            g = multikey(group, token, d_start[rec] + w, np.full(len(rec), length))
            hit = (np.bincount(g)[g] > 1) & ~d_whole[rec]
            r, w = rec[hit], w[hit]
            spans.append(np.stack([d_owner[r], d_pos[r] + w, d_pos[r] + w + length], axis=1))
        spans = np.concatenate(spans)
        spans = spans[np.argsort(spans[:, 0], kind="stable")]
        out += [(int(spans[x, 0]), merged(spans[x:y, 1:]).tobytes()) for x, y in groups(spans[:, 0])]
        return out
    return find


def per_document_spans(answered: DataFrame) -> DataFrame:
    """(k, rid, spans): maximal removed byte spans (int32 pairs) of each document."""
    def run(pdf):
        import pandas as pd

        kind = pdf["kind"].to_numpy()
        found = [np.frombuffer(x, np.int32).reshape(-1, 2) for x in pdf["a"][kind == X.MARKED]]
        out = []
        if found:
            row = pdf[kind == X.DOCS].iloc[0]
            k, rid, base = (np.frombuffer(row[c], np.int64) for c in "abc")
            spans = np.concatenate(found).astype(np.int64)
            doc = np.searchsorted(base, spans[:, 0], side="right") - 1
            order = np.argsort(doc, kind="stable")
            doc, spans = doc[order], spans[order]
            for x, y in groups(doc):
                i = int(doc[x])
                out.append((k[i], rid[i], merged(spans[x:y] - base[i], touching=True).tobytes()))
        return pd.DataFrame(out, columns=["k", "rid", "spans"])

    return answered.groupBy("chunk").applyInPandas(run, "k long, rid long, spans binary")


def removal_spans(rows: DataFrame, stage: Staged, length: int = LENGTH, lead: int = LEAD, hot: int = HOT) -> DataFrame:
    """(k, rid, spans) of keyed rows."""
    n = n_buckets(rows, BUCKET_BYTES)
    packed = X.requests(rows.select("k", "rid", "text"), anchor_items(length, lead), lambda: (X.top_bits(n), n), tell=True)
    anchors = stage.write(per_document_anchors(X.answers(packed, find_anchors(hot))), "anchors").distinct()
    splitters = sample_splitters(rows, n, length, lead)
    records = run_records(rows.join(anchors, ["k", "rid"]).select("k", "rid", "text", "spans"), splitters, n, length, lead)
    spans = stage.write(per_document_spans(X.answers(records, repeated_spans(length, lead))), "spans")
    stage.drop("anchors")
    return spans.distinct()


def deduplicate(docs: DataFrame, length: int = LENGTH, lead: int = LEAD, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256, kept): ``kept`` are the remaining bytes."""
    stage = Staged(docs.sparkSession, "suffix")
    rows = keyed(docs, id_col=id_col, text_col=text_col)
    found = removal_spans(rows, stage, length, lead, hot)

    def run(batches):
        for part, data, offs in T.chunks(batches, "text"):
            spans = part.column(part.schema.get_field_index("spans"))
            out = []
            for i, s in enumerate(spans.to_pylist()):
                raw = data[offs[i]:offs[i + 1]]
                gone = np.frombuffer(s, np.int32).reshape(-1, 2) if s else np.zeros((0, 2), np.int32)
                edge = np.concatenate(([0], gone.ravel(), [len(raw)]))
                kept = b"".join(raw[x:y].tobytes() for x, y in zip(edge[::2], edge[1::2]))
                out.append((len(raw), len(raw) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), spans, pa.array(cols[3]), pa.array(cols[4], pa.binary())],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256", "kept"])

    joined = rows.join(found, ["k", "rid"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, spans binary, kept_sha256 string, kept binary")


def digests(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    return deduplicate(docs, **how).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
