"""Language-model scoring by cross-entropy difference.

Two bigram models share one vocabulary (hashed lower-cased words and a begin mark): the background
model counts all documents, the target model those rated good. Both smooth alike,
p(w | v) = (c(v, w) + ALPHA) / (c(v) + ALPHA * V), and background counts are scaled to the target's
size, so the models are matched. A document's score is the mean over its tokens of the target loss
minus the background loss; lower is closer to the target. Counts leave out the scored document
itself, else a rated document would be scored by its own words.

The loss difference of a token splits into a term of its bigram and one of its context, so every
n-gram is scored where it is counted: per chunk of documents the n-grams go, hashed, to buckets with
their documents and frequencies; a bucket sums both counts over the corpus and returns one partial
sum per document. An n-gram in more than ``HEAVY`` documents of a chunk travels as one summed entry,
its document list waits in the chunk's own rows, and the bucket returns its counts: an n-gram that
all documents share costs one entry a chunk. No n-gram is dropped at any count.

Null and empty texts have no tokens and score 0. Documents rated more than once count as target if
any rating is good. Null ids are kept. Repeated rows count and are scored one by one. Without a
target all scores follow from smoothing alone. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedrank.llm import text as T
from seedrank.llm.exchange import planes, top_bits, unplane
from seedrank.llm.tables import Staged, keyed, n_buckets

ALPHA = 0.1
VOCABULARY = 1 << 16
HEAVY = 8
#: n-grams are known by this many bytes of their hash: the vocabulary of n-grams has 2^48 places
KEY_BYTES = 6
#: input bytes per bucket, and entries that a bucket counts at once (its keys are cut into ranges)
BUCKET_BYTES = 4 << 20
AT_ONCE = 400_000
#: target ids up to this number are broadcast (16 MB); beyond it they are joined by a shuffle
BROADCAST_ROWS = 1_000_000

#: packed rows: entries with documents; summed entries; documents of summed entries; the documents; answers
ENTRY, SUMMED, LISTS, DOCS, SUMS, COUNTS = 0, 1, 2, 3, 4, 5
SCHEMA = "bucket int, chunk long, kind byte, a binary, b binary, c binary, d binary"
_BEGIN = np.uint64(0x5851F42D4C957F2D)
#: lowest bit of a key: 1 for bigrams, 0 for contexts
_ORDER = np.uint64(1)


def ngrams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, document) of every bigram and context of a chunk, and the tokens of each document."""
    low = T.lower_ascii(data)
    starts, ends, first = T.words(low, offs, T.SPACE_SEPARATED)
    w = T.span_hash(T.byte_hash(low), starts, ends)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(first))
    prev = np.empty_like(w)
    prev[1:] = w[:-1]
    prev[first[:-1][np.diff(first) > 0]] = _BEGIN
    with np.errstate(over="ignore"):
        context = T.mix64(prev ^ np.uint64(0x9E3779B97F4A7C15))
        pair = T.mix64(context * np.uint64(0xD6E8FEB86659FD93) + w)
    shift = np.uint64(64 - 8 * KEY_BYTES)
    key = np.concatenate([context >> shift & ~_ORDER, pair >> shift | _ORDER])
    return key, np.concatenate([doc, doc]), np.diff(first)


def loss_term(key: np.ndarray, target: np.ndarray, background: np.ndarray, ratio: float) -> np.ndarray:
    """Target loss minus background loss that an n-gram adds: minus the log ratio of the smoothed
    counts for bigrams, plus it for contexts."""
    add = np.where(key & _ORDER == 1, ALPHA, ALPHA * VOCABULARY)
    r = np.log(target + add) - np.log(background * ratio + add)
    return np.where(key & _ORDER == 1, -r, r)


def requests(rows: DataFrame, n: int, most: int = HEAVY) -> DataFrame:
    """Packed rows of (k, rid, text, target)."""
    def run(batches):
        bucket_of = top_bits(n)
        part, number = TaskContext.get().partitionId(), 0
        for b, data, offs in T.chunks(batches, "text"):
            chunk = (part << 32) | number
            number += 1
            good = np.array(b.column(b.schema.get_field_index("target")).to_pylist(), bool)
            key, doc, tokens = ngrams(data, offs)
            out = [(chunk % n, chunk, DOCS, b.column(0).to_numpy().tobytes(), tokens.astype(np.int64).tobytes(), good.tobytes(), b"")]
            order = np.argsort(key, kind="stable")  # documents ascend among the contexts and among the bigrams
            key, doc = key[order], doc[order]
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]))) if len(key) else np.zeros(0, bool)
            at = np.flatnonzero(new)
            tf = np.diff(np.append(at, len(key)))
            key, doc = key[at], doc[at]
            head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
            docs_of = np.diff(np.append(head, len(key)))
            heavy = np.repeat(docs_of > most, docs_of)
            if heavy.any():
                out.append((chunk % n, chunk, LISTS, planes(key[heavy], KEY_BYTES), planes(doc[heavy], 4), planes(tf[heavy], 4), b""))
            first = head[docs_of > most]
            total = np.add.reduceat(tf, head)[docs_of > most] if len(head) else head
            on_target = np.add.reduceat(tf * good[doc], head)[docs_of > most] if len(head) else head
            send = [(ENTRY, key[~heavy], doc[~heavy] * 2 + good[doc[~heavy]], tf[~heavy], None), (SUMMED, key[first], total, on_target, None)]
            for kind, ks, x, y, _ in send:
                where = bucket_of(ks << np.uint64(64 - 8 * KEY_BYTES)).astype(np.int64)
                cut = np.concatenate(([0], np.flatnonzero(where[1:] != where[:-1]) + 1, [len(where)])) if len(where) else np.zeros(1, np.int64)
                for lo, hi in zip(cut[:-1], cut[1:]):
                    out.append((int(where[lo]), chunk, kind, planes(ks[lo:hi], KEY_BYTES), planes(x[lo:hi], 4), planes(y[lo:hi], 4), b""))
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int8()), *(pa.array(c, pa.binary()) for c in cols[3:])],
                names=["bucket", "chunk", "kind", "a", "b", "c", "d"])

    return rows.mapInArrow(run, SCHEMA)


def score_bucket(ratio: float):
    def run(pdf):
        import pandas as pd

        kind, chunk = pdf["kind"].to_numpy(), pdf["chunk"].to_numpy()
        a, b, c = pdf["a"].tolist(), pdf["b"].tolist(), pdf["c"].tolist()
        out = [(int(chunk[i]), int(kind[i]), a[i], b[i], c[i]) for i in np.flatnonzero((kind == LISTS) | (kind == DOCS))]
        single, summed = np.flatnonzero(kind == ENTRY), np.flatnonzero(kind == SUMMED)
        every = [*single.tolist(), *summed.tolist()]
        keys = [unplane(a[i], KEY_BYTES) for i in every]
        x = [unplane(b[i], 4).astype(np.int32) for i in every]
        y = [unplane(c[i], 4).astype(np.int32) for i in every]
        m, total = len(single), sum(map(len, keys))
        sums = [np.zeros(int(v.max()) // 2 + 1) for v in x[:m]]
        counts = [[] for _ in summed]
        low, high = min((int(k[0]) for k in keys), default=0), max((int(k[-1]) for k in keys), default=0)
        parts = max(1, total // AT_ONCE)
        edges = [low + (high + 1 - low) * i // parts for i in range(1, parts)]
        cuts = [np.concatenate(([0], np.searchsorted(k, np.array(edges, np.uint64)), [len(k)])) for k in keys]
        for p in range(parts if total else 0):
            at = [slice(cut[p], cut[p + 1]) for cut in cuts]
            size = [s.stop - s.start for s in at]
            key, xs, ys = (np.concatenate([v[s] for v, s in zip(vs, at)]) for vs in (keys, x, y))
            u, inv = np.unique(key, return_inverse=True)
            n = int(sum(size[:m]))
            good, tf = xs[:n] & 1, ys[:n].astype(np.float64)
            background = np.bincount(inv, weights=np.concatenate([tf, xs[n:]]), minlength=len(u))
            target = np.bincount(inv, weights=np.concatenate([tf * good, ys[n:]]), minlength=len(u))
            term = tf * loss_term(key[:n], target[inv[:n]] - tf * good, background[inv[:n]] - tf, ratio)
            doc, lo = xs[:n] >> 1, 0
            for j, w in enumerate(size):
                if j < m:
                    sums[j] += np.bincount(doc[lo:lo + w], weights=term[lo:lo + w], minlength=len(sums[j]))
                elif w:
                    counts[j - m].append((target[inv[lo:lo + w]], background[inv[lo:lo + w]]))
                lo += w
        for j, i in enumerate(every):
            if j < m:
                have = np.unique(x[j] >> 1)
                out.append((int(chunk[i]), SUMS, planes(have, 4), sums[j][have].astype(np.float32).tobytes(), b""))
            else:
                t, g = (np.concatenate(v) for v in zip(*counts[j - m]))
                out.append((int(chunk[i]), COUNTS, a[i], t.tobytes(), g.tobytes()))
        return pd.DataFrame(out, columns=["chunk", "kind", "a", "b", "c"])
    return run


def score_chunk(ratio: float):
    def run(pdf):
        import pandas as pd

        at = {k: pdf[pdf["kind"] == k] for k in (DOCS, LISTS, SUMS, COUNTS)}
        row = at[DOCS].iloc[0]
        k, tokens, good = np.frombuffer(row["a"], np.int64), np.frombuffer(row["b"], np.int64), np.frombuffer(row["c"], bool)
        total = np.zeros(len(k))
        parts = sorted((a, b) for a, b in zip(at[SUMS]["a"], at[SUMS]["b"]))  # one order of addition
        for a, b in parts:
            total[unplane(a, 4).astype(np.int64)] += np.frombuffer(b, np.float32)
        if len(at[LISTS]):
            lists = at[LISTS].iloc[0]
            key, doc, tf = unplane(lists["a"], KEY_BYTES), unplane(lists["b"], 4).astype(np.int64), unplane(lists["c"], 4).astype(np.int64)
            known = np.concatenate([unplane(x, KEY_BYTES) for x in at[COUNTS]["a"]])
            target, background = (np.concatenate([np.frombuffer(x) for x in at[COUNTS][c]]) for c in "bc")
            order = np.argsort(known)
            j = order[np.searchsorted(known[order], key)]
            term = tf * loss_term(key, target[j] - tf * good[doc], background[j] - tf, ratio)
            total += np.bincount(doc, weights=term, minlength=len(k))
        return pd.DataFrame({"k": k, "n_tokens": tokens, "score": total / np.maximum(tokens, 1)})
    return run


def cross_entropy_difference(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY) -> DataFrame:
    """(doc_id, n_tokens, score, keep); ``ratings`` is (doc_id, good boolean); keep: score below 0."""
    stage = Staged(docs.sparkSession, "lm")
    good = ratings.filter("good AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("target", F.lit(True))
    good = stage.write(good, "target")
    good = F.broadcast(good) if good.count() <= BROADCAST_ROWS else good
    rows = keyed(docs, id_col=id_col, text_col=text_col)
    n = n_buckets(rows, BUCKET_BYTES)
    joined = rows.join(good, "doc_id", "left").select("k", "rid", "text", F.coalesce("target", F.lit(False)).alias("target"))
    sizes = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.octet_length(text_col).alias("n")).join(good, "doc_id", "left").agg(
        F.sum(F.when(F.col("target"), F.col("n"))).alias("t"), F.sum("n").alias("b")).first()
    ratio = (sizes["t"] or 0) / sizes["b"] if sizes["b"] else 1.0
    answered = requests(joined, n, heavy).groupBy("bucket").applyInPandas(score_bucket(ratio), "chunk long, kind byte, a binary, b binary, c binary")
    scored = stage.write(answered.groupBy("chunk").applyInPandas(score_chunk(ratio), "k long, n_tokens long, score double"), "scores")
    return scored.select(F.when(F.col("k") != F.lit(-(1 << 63)), F.col("k")).alias("doc_id"), "n_tokens", "score", (F.col("score") < 0).alias("keep"))


def score(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """Target: documents of quality 1 that are not toxic in ``labels`` (doc_id, quality, toxic)."""
    return cross_entropy_difference(docs, labels.select("doc_id", ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good")), **how)
