"""Substring deduplication by Rabin-Karp hashes of every token window.

Every window of ``window`` consecutive words of every document gets a rolling 64-bit hash (of the
words' own hashes). The hashes are counted in Spark (``exchange``); windows whose hash occurs
anywhere else, same document included, are repeated, and repeated windows merge into maximal
removal intervals of each document. The intervals then meet the texts by document key once and the
kept words are joined by one space. Words of a window are compared by hash: 64 bits on each level
leave an expected n^2 / 2^65 false pairs among n windows.

Documents shorter than a window lose nothing. Null texts have no words. Rows that repeat in full
remove each other's windows like any others; rows that share an id but not a text stay apart. A null
doc_id is kept. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedrank.llm import exchange as X
from seedrank.llm import text as T
from seedrank.llm.tables import Staged, keyed, n_buckets

WINDOW = 35


def window_items(window: int):
    def items(rows, data, offs):
        starts, ends, first = T.words(data, offs, T.SPACE_SEPARATED)
        h = T.span_hash(T.byte_hash(data), starts, ends)
        n_win = np.maximum(0, np.diff(first) - window + 1)
        pos = T.ragged(first[:-1], n_win)
        return T.span_hash(T.prefix_hash(h), pos, pos + window), pos, first[:-1]
    return items


def word_spans(window: int):
    def spans(pos: np.ndarray) -> bytes:
        s, e = T.covered(pos, window)
        return np.stack([s, e], axis=1).astype(np.int32).tobytes()
    return spans


def removal_intervals(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """(k, rid, spans): maximal removal intervals (int32 pairs of word numbers) of keyed rows."""
    n = n_buckets(rows)
    packed = X.requests(rows.select("k", "rid", "text"), window_items(window), lambda: (X.top_bits(n), n))
    return X.per_document(X.answers(packed), word_spans(window))


def keep_words(data: np.ndarray, offs: np.ndarray, spans: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Kept bytes (words joined by one space), their bounds per document, and words and removed
    words of each document."""
    starts, ends, first = T.words(data, offs, T.SPACE_SEPARATED)
    n = len(offs) - 1
    removed = np.zeros(len(starts), bool)
    for i, s in enumerate(spans):
        if s:
            for a, b in np.frombuffer(s, np.int32).reshape(-1, 2):
                removed[first[i] + a:first[i] + b] = True
    kept = ~removed
    doc = np.repeat(np.arange(n), np.diff(first))
    ks, ke, kd = starts[kept], ends[kept], doc[kept]
    lengths = ke - ks
    later = np.concatenate(([False], kd[1:] == kd[:-1])) if len(kd) else np.zeros(0, bool)
    out = data[T.ragged(ks - later, lengths + later)].copy()
    at = np.concatenate(([0], np.cumsum(lengths + later)))
    out[at[:-1][later]] = 32
    bounds = at[np.searchsorted(kd, np.arange(n + 1))]
    return out, bounds, np.diff(first), T.segment_sum(removed, first)


def deduplicate(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept_text): one row per row of ``docs``."""
    stage = Staged(docs.sparkSession, "substring")
    rows = keyed(docs, id_col=id_col, text_col=text_col)
    found = stage.write(removal_intervals(rows, window), "intervals").distinct()

    def run(batches):
        for part, data, offs in T.chunks(batches, "text"):
            spans = part.column(part.schema.get_field_index("spans"))
            out, bounds, words, removed = keep_words(data, offs, spans.to_pylist())
            raw = out.tobytes()
            texts = pa.array([raw[a:b] for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words.astype(np.int64)), pa.array(removed.astype(np.int64)), spans, texts],
                                             names=["doc_id", "n_words", "n_removed", "spans", "kept"])

    joined = rows.join(found, ["k", "rid"], "left").select("doc_id", "text", "spans")
    out = joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, spans binary, kept binary")
    return out.select("doc_id", "n_words", "n_removed", "spans", out.kept.cast("string").alias("kept_text"))


def digests(docs: DataFrame, window: int = WINDOW, **how) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256)."""
    return deduplicate(docs, window, **how).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
