"""Benchmark decontamination with a distributed positional inverted index.

The index is partitioned by document: one row holds the postings of a chunk of whole documents, that
is, for every term the ascending word positions at which it occurs. It is written once to the
shared folder, without a shuffle: of all terms if the test set comes in several blocks, which then share it, or of the
terms of the only block. Test windows (``window`` consecutive words; a shorter item is one window) are a stated query set, taken
in blocks of a bounded number of words and matched against all index rows: a window's terms are ordered by the length
of their postings in the row, the rarest list is moved back by its offset in the window and intersected
with the next rarest, and so on through *all* terms, so a surviving start is an exact phrase; all windows of a row take
each step together. With ``slack`` > 0 a second search accepts ordered proximity: from a position of the rarest term, every
other term within ``slack`` words of its place.

Terms are 64-bit hashes of lower-cased words. Null or empty texts have no words and are never
contaminated; items without words are ignored; the windows of an item with a null id hit words like any other,
but the item is not listed; items that repeat count once;
repeated documents are judged row by row. Extra columns are ignored. Empty tables give no hits
(no benchmark) or no rows (no documents).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedrank.llm import text as T
from seedrank.llm.tables import Staged

WINDOW = 13
#: test words taken to the tasks at once; more are searched in further blocks
BLOCK_WORDS = 2_000_000
#: starts that a task follows at once
CANDIDATES = 1 << 20


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words and the first word of each document."""
    data = T.lower_ascii(data)
    starts, ends, first = T.words(data, offs, T.ALNUM_WORDS)
    return T.span_hash(T.byte_hash(data), starts, ends), first


class Queries:
    """The windows of a block of test items: ``terms`` (ascending vocabulary), ``ids`` (row per
    distinct window, vocabulary numbers, -1 beyond its length), ``items`` of each window."""

    def __init__(self, items: list[tuple[str | None, np.ndarray]], window: int):
        seen: dict[bytes, set[str]] = {}
        for item, h in items:
            for i in range(max(1, len(h) - window + 1) if len(h) else 0):
                seen.setdefault(h[i:i + window].tobytes(), set()).update([] if item is None else [item])
        self.terms = np.unique(np.concatenate([h for _, h in items])) if items else np.zeros(0, np.uint64)
        keys = sorted(seen)
        self.length = np.array([len(k) // 8 for k in keys], np.int64)
        self.ids = np.full((len(keys), window), -1, np.int64)
        for row, k in enumerate(keys):
            self.ids[row, : len(k) // 8] = np.searchsorted(self.terms, np.frombuffer(k, np.uint64))
        self.items = [sorted(seen[k]) for k in keys]


def index(docs: DataFrame, terms: np.ndarray | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Index rows: (chunk, doc_ids, bounds, terms, counts, postings) of each chunk of documents; ``bounds`` are first word
    numbers, ``terms`` the distinct terms, ascending, with their ``counts`` and, one term after the other, ``postings``. Only
    ``terms`` are indexed, or all (None)."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        wanted, part, number = vocabulary.value, TaskContext.get().partitionId(), 0
        for rows, data, offs in T.chunks(batches, "text"):
            h, first = word_hashes(data, offs)
            hit = np.arange(len(h)) if wanted is None else np.flatnonzero(found_in(wanted, h)[0])
            order = np.argsort(h[hit], kind="stable")
            own, counts = np.unique(h[hit], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) | number]), pa.array([rows.column(0).to_pylist()], pa.list_(pa.int64())),
                 *[pa.array([x.tobytes()], pa.binary()) for x in (first.astype(np.int64), own, counts.astype(np.int32), hit[order].astype(np.int32))]],
                names=["chunk", "doc_ids", "bounds", "terms", "counts", "postings"])
            number += 1

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(run, "chunk long, doc_ids array<long>, bounds binary, terms binary, counts binary, postings binary"))


def found_in(sorted_values: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which ``x`` are among the ascending values, and where."""
    if not len(sorted_values):
        return np.zeros(len(x), bool), np.zeros(len(x), np.int64)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x, at


def intersect(terms: np.ndarray, counts: np.ndarray, postings: np.ndarray, q: Queries, slack: int = 0):
    """(window numbers, starts, exact) of the phrase matches of an index row and, with ``slack``, of its proximity matches; all
    windows at once, some of them at a time."""
    here, own = found_in(terms, q.terms)  # the row's list of each test term
    have = np.where(here, counts[own] if len(counts) else 0, 0)
    size = np.where(q.ids >= 0, have[np.maximum(q.ids, 0)], np.iinfo(np.int32).max) if len(q.ids) else np.zeros((0, 1), np.int64)
    windows = np.flatnonzero(size.min(axis=1) > 0)
    rarity = np.argsort(size[windows], axis=1, kind="stable")  # places in the window, rarest term first
    first = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
    span = int(postings.max(initial=0)) + 2 * q.ids.shape[1] + 2 * slack + 2 if len(postings) else 1
    at_key = np.repeat(np.arange(len(counts)), counts) * span + postings  # ascending: lists one after the other
    work = size[windows, rarity[:, 0]] if len(windows) else np.zeros(0, np.int64)
    cuts = np.searchsorted(np.cumsum(work), np.arange(CANDIDATES, work.sum() + CANDIDATES, CANDIDATES)) + 1
    for lo, hi in zip(np.concatenate(([0], cuts[:-1])), cuts):
        w, by = windows[lo:hi], rarity[lo:hi]
        if not len(w):
            continue
        lists = own[q.ids[w, by[:, 0]]]
        row = np.repeat(np.arange(len(w)), counts[lists])
        start = postings[T.ragged(first[lists], counts[lists])].astype(np.int64) - by[row, 0]
        exact = start >= 0
        row, start, exact = (row, start, exact) if slack else (row[exact], start[exact], exact[exact])
        for place in range(1, by.shape[1]):
            if not len(row):
                break
            offset = by[row, place]
            used = offset < q.length[w[row]]
            term = own[np.maximum(q.ids[w[row], offset], 0)]
            key = term * span + start + offset
            hit = found_in(at_key, key)[0] | ~used
            exact &= hit
            if slack:
                i = np.searchsorted(at_key, np.maximum(key - slack, term * span))
                close = (i < len(at_key)) & (at_key[np.minimum(i, len(at_key) - 1)] <= key + slack) | ~used
                row, start, exact = row[close], start[close], exact[close]
            else:
                row, start, exact = row[hit], start[hit], exact[hit]
        yield w[row], start, exact


def matches(stored: DataFrame, q: Queries, slack: int = 0) -> DataFrame:
    """(chunk, i, doc_id, n_words, spans, near, hits, items): per document of the index its merged hit
    spans (int32 pairs of word numbers; ``hits``: the same as structs), its proximity spans, and the
    items found as phrases."""
    queries = stored.sparkSession.sparkContext.broadcast(q)

    def run(batches):
        q = queries.value
        for b in batches:
            for row in b.to_pylist():
                bounds = np.frombuffer(row["bounds"], np.int64)
                n = len(bounds) - 1
                parts = list(intersect(np.frombuffer(row["terms"], np.uint64), np.frombuffer(row["counts"], np.int32), np.frombuffer(row["postings"], np.int32), q, slack))
                w, start, exact = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
                doc = np.searchsorted(bounds, start, side="right") - 1
                inside = (start >= 0) & (doc < n)
                inside[inside] &= start[inside] + q.length[w[inside]] <= bounds[doc[inside] + 1]
                w, start, exact, doc = w[inside], start[inside], exact[inside], doc[inside]
                length = q.length[w]
                merged = merged_spans(doc[exact], start[exact] - bounds[doc[exact]], length[exact], n)
                near = merged_spans(doc[~exact], start[~exact] - bounds[doc[~exact]], length[~exact], n)
                items: dict[int, set] = {}
                for d, k in set(zip(doc[exact].tolist(), w[exact].tolist())):
                    items.setdefault(d, set()).update(q.items[k])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["chunk"]] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array(row["doc_ids"], pa.int64()),
                     pa.array(np.diff(bounds)), pa.array([m.tobytes() for m in merged], pa.binary()),
                     pa.array([m.tobytes() for m in near], pa.binary()), span_lists(merged),
                     pa.array([sorted(items.get(d, ())) for d in range(n)], pa.list_(pa.string()))],
                    names=["chunk", "i", "doc_id", "n_words", "spans", "near", "hits", "items"])

    return stored.mapInArrow(run, "chunk long, i long, doc_id long, n_words long, spans binary, near binary, hits array<struct<s int, e int>>, items array<string>")


def merged_spans(doc: np.ndarray, start: np.ndarray, length: np.ndarray, n: int) -> list[np.ndarray]:
    """Per document the merged spans [start, start + length)."""
    order = np.lexsort((start, doc))
    doc, start, length = doc[order], start[order], length[order]
    first = np.searchsorted(doc, np.arange(n + 1))
    out = [np.zeros((0, 2), np.int32)] * n
    for d in np.unique(doc).tolist():
        s, e = T.covered(start[first[d]:first[d + 1]], length[first[d]:first[d + 1]])
        out[d] = np.stack([s, e], axis=1).astype(np.int32)
    return out


def span_lists(merged: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(merged) if merged else np.zeros((0, 2), np.int32)
    bounds = np.concatenate(([0], np.cumsum([len(m) for m in merged]))).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in (0, 1)], names=["s", "e"])
    return pa.ListArray.from_arrays(pa.array(bounds), pairs)


def search(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slack: int = 0, block_words: int = BLOCK_WORDS,
           id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, n_words, spans, near, hits, items) of every row of ``docs``; lists of one entry a block
    (``hits``: one list of structs)."""
    stage = Staged(docs.sparkSession, "decontam")

    def hashed(batches):
        for rows, data, offs in T.chunks(batches, "text"):
            h, first = word_hashes(data, offs)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array(np.diff(first)), pa.array([h[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())],
                names=["item", "n", "words"])

    items = stage.write(benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("text"))
                        .mapInArrow(hashed, "item string, n long, words binary").filter("n > 0"), "items")
    total = items.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, math.ceil(total / block_words))
    found = []
    whole = stage.write(index(docs, None, id_col, text_col), "index") if blocks > 1 else None  # one index for all blocks
    for b in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == b)
        q = Queries([(r.item, np.frombuffer(r.words, np.uint64)) for r in part.toLocalIterator()], window)
        found.append(matches(stage.write(index(docs, q.terms, id_col, text_col), "index") if whole is None else whole, q, slack))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    if blocks == 1:
        return out.select("doc_id", "n_words", F.array("spans").alias("spans"), F.array("near").alias("near"), "hits", "items")
    return out.groupBy("chunk", "i").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.collect_list("spans").alias("spans"),
        F.collect_list("near").alias("near"), F.flatten(F.collect_list("hits")).alias("hits"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")).drop("chunk", "i")


def judge(found: DataFrame, per_hit: int = 20) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) from ``search``: contaminated if
    words are hit and ``per_hit`` times their number is at least the document's words."""
    # words in the union of the blocks' spans, which may overlap: from left to right
    def add(acc, span):
        new = span["e"] - F.greatest(acc["till"], span["s"])
        return F.struct(F.greatest(acc["till"], span["e"]).alias("till"), (acc["n"] + F.greatest(new, F.lit(0))).cast("long").alias("n"))

    n_hit = F.aggregate(F.array_sort("hits"), F.struct(F.lit(0).alias("till"), F.lit(0).cast("long").alias("n")), add)["n"]
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (F.lit(per_hit) * F.col("n_hit") >= F.col("n_words")))


def contamination(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    return judge(search(docs, benchmark, **how))
