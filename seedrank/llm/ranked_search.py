"""Ranked lexical search by pipelined term partitioning.

Every term belongs to one owner: the owners are bands of document frequency, rarest first. Items are
grouped into bundles, and a bundle goes through the owners in that order, a stage each. It carries
sparse accumulators (document, integer score so far), kept by chunk of documents, so that
no accumulator or posting list meets in one place whole: a stage cogroups the accumulators and the
owner's postings by (bundle, chunk) and adds the integer contributions. After the last stage the best
``k`` documents of an item are selected from the accumulators.

After a stage the k-th best score so far of an item is a lower bound of its k-th best score in the
end. An accumulator is dropped if its score with the most that the later owners can add
stays below that bound, and a later stage opens no accumulator that would; ties with the bound are
kept. So the result is that of full accumulation.

``index`` holds every term of every document, written once: chunks of whole documents (``CHUNK_BYTES``
of text and at most ``CHUNK_DOCS`` documents), each with its distinct terms and their postings. Items come in
blocks of about ``BLOCK_WORDS`` words, whose distinct terms (16 bytes each) and bounds (8 bytes an
item) are what a task is sent; a block reads the index twice, never the texts.

Terms are 64-bit hashes of lower-cased words. Null or empty texts have no terms and are never found.
Items are the distinct (id, text) rows; null ids are items too; items without terms find nothing, and
neither does anything in an empty table. Repeated documents are ranked row by row; equal scores rank by
ascending id, null last. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seedrank.llm import text as T
from seedrank.llm.tables import Staged

TOP = 20
#: upper ends, as shares of all documents, of the owners' document frequencies; the last owner has the rest
BANDS = (0.002, 0.02, 0.2)
BUNDLE = 256
BLOCK_WORDS = 1_000_000
#: text and documents of a chunk (a longer document is a chunk of its own)
CHUNK_BYTES, CHUNK_DOCS = 2 << 20, 4096
#: chunks that a task of a stage takes
TASK_CHUNKS = 32
#: bytes that a writer of wide cells holds before they go to disk
ROW_GROUP = 8 << 20
#: fixed values of the score: the integer saturation of a term's occurrences
SCALE, TF_FACTOR, M_FACTOR, M_BASE, M_SLOPE = 1_000_000_000, 1000, 12, 75, 25
#: a term adds less than its weight times this
MOST = SCALE // TF_FACTOR

INDEX = "chunk long, doc_ids array<long>, lengths binary, terms binary, bounds binary, docs binary, tf binary"
POSTINGS = "owner int, bundle long, chunk long, lengths binary, terms binary, bounds binary, docs binary, tf binary"
ACCUMULATORS = "bundle long, chunk long, item int, docs binary, scores binary, best array<long>"


def term_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms and the first term of each text."""
    data = T.lower_ascii(data)
    starts, ends, first = T.words(data, offs, T.ALNUM_WORDS)
    return T.span_hash(T.byte_hash(data), starts, ends), first


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per chunk: document ids and term counts, distinct terms ascending, their postings."""
    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        for rows, data, offs in T.chunks(batches, "text", CHUNK_BYTES):
            for lo in range(0, rows.num_rows, CHUNK_DOCS):
                own = offs[lo:lo + CHUNK_DOCS + 1]
                h, first = term_hashes(data[own[0]:own[-1]], own - own[0])
                n = np.diff(first)
                order = np.argsort(h, kind="stable")
                h, doc = h[order], np.repeat(np.arange(len(n)), n)[order]
                fresh = np.ones(len(h), bool)
                fresh[1:] = h[1:] != h[:-1]
                at = np.flatnonzero(fresh | np.concatenate(([False], doc[1:] != doc[:-1]))[:len(h)])
                term = np.flatnonzero(fresh[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(part << 32) | number]), pa.array([rows.column(0).slice(lo, CHUNK_DOCS).to_pylist()], pa.list_(pa.int64())),
                     *binary(n.astype(np.int32), h[at[term]], np.append(term, len(at)).astype(np.int32), doc[at].astype(np.int32),
                             np.diff(np.append(at, len(h))).astype(np.int32))],
                    names=["chunk", "doc_ids", "lengths", "terms", "bounds", "docs", "tf"])
                number += 1

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, INDEX)


def rows_of(batches):
    """The rows of Arrow batches one at a time; binary cells stay in the batch's memory."""
    for b in batches:
        names, kinds = b.schema.names, b.schema.types
        for i in range(b.num_rows):
            yield {name: b.column(c)[i].as_buffer() if pa.types.is_binary(kinds[c]) else b.column(c)[i].as_py() for c, name in enumerate(names)}


def binary(*arrays: np.ndarray) -> list[pa.Array]:
    return [pa.array([a.tobytes()], pa.binary()) for a in arrays]


class Vocabulary:
    """The distinct terms of a block of items: hashes ascending, and each item's (term, repeats)."""

    def __init__(self, items: list[np.ndarray]):
        self.terms = np.unique(np.concatenate(items)) if items else np.zeros(0, np.uint64)
        pairs = [np.unique(np.searchsorted(self.terms, h), return_counts=True) for h in items]
        self.item = np.repeat(np.arange(len(items)), [len(t) for t, _ in pairs])
        self.term = np.concatenate([t for t, _ in pairs]) if pairs else np.zeros(0, np.int64)
        self.repeats = np.concatenate([c for _, c in pairs]) if pairs else np.zeros(0, np.int64)
        self.n_items = len(items)


def frequencies(stored: DataFrame, terms: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all terms with repeats, and the document frequency of each of ``terms``;
    added up in each task, then by term."""
    shared = stored.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        terms = shared.value
        count = np.zeros(len(terms) + 2, np.int64)
        for row in rows_of(batches):
            n = np.frombuffer(row["lengths"], np.int32)
            have, here, bounds = found(row, terms)
            count[0] += (n > 0).sum()
            count[1] += n.sum(dtype=np.int64)
            count[have + 2] += bounds[here + 1] - bounds[here]
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[at])], names=["term", "n"])

    total = np.zeros(len(terms) + 2, np.int64)
    for r in stored.select("lengths", "terms", "bounds").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator():
        total[r["term"]] = r["n"]
    return int(total[0]), int(total[1]), total[2:]


def found(row: dict, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the ``terms`` that an index row has, their places in the row, and the row's bounds."""
    own = np.frombuffer(row["terms"], np.uint64)
    at = np.searchsorted(own, terms)
    have = np.flatnonzero(own[np.minimum(at, len(own) - 1)] == terms) if len(own) else np.zeros(0, np.int64)
    return have, at[have], np.frombuffer(row["bounds"], np.int32)


class Plan:
    """What a task knows of a block: weights, owners, items by term, and what later owners can add."""

    def __init__(self, v: Vocabulary, n_docs: int, n_terms: int, df: np.ndarray, bands: tuple, bundle: int):
        self.n_docs, self.n_terms, self.bundle, self.stages = n_docs, n_terms, bundle, len(bands) + 1
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        self.owner = np.searchsorted(np.array(bands) * n_docs, df, side="left")
        self.terms, self.n_items = v.terms, v.n_items
        order = np.argsort(v.term, kind="stable")
        self.item, self.repeats = v.item[order], v.repeats[order].astype(np.int64)
        self.first = np.searchsorted(v.term[order], np.arange(len(v.terms) + 1))
        most = self.weight[v.term] * v.repeats * MOST
        self.rest = np.zeros((self.stages + 1, v.n_items), np.int64)  # what the owners from a stage on can add
        for s in range(self.stages - 1, -1, -1):
            own = self.owner[v.term] == s
            self.rest[s] = self.rest[s + 1]
            np.add.at(self.rest[s], v.item[own], most[own])

    def contribution(self, term: int, tf: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        m = M_BASE + (M_SLOPE * lengths * self.n_docs) // self.n_terms
        return self.weight[term] * ((SCALE * tf) // (TF_FACTOR * tf + M_FACTOR * m))


def owned(stored: DataFrame, shared, owner_path: str) -> None:
    """Write every owner's postings of the block's terms: a row per owner, bundle and chunk."""
    def run(batches):
        plan = shared.value
        bundles = -(-plan.n_items // plan.bundle)
        in_bundle = [np.zeros(len(plan.terms), bool) for _ in range(bundles)]
        of = np.repeat(np.arange(len(plan.terms)), np.diff(plan.first))
        for b in range(bundles):
            in_bundle[b][of[plan.item // plan.bundle == b]] = True
        for row in rows_of(batches):
            have, here, bounds = found(row, plan.terms)
            docs, tf = np.frombuffer(row["docs"], np.int32), np.frombuffer(row["tf"], np.int32)
            for s in range(plan.stages):
                for b in range(bundles):
                    mine = (plan.owner[have] == s) & in_bundle[b][have] & (plan.weight[have] > 0)
                    if not mine.any():
                        continue
                    sizes = (bounds[here + 1] - bounds[here])[mine]
                    at = T.ragged(bounds[here[mine]], sizes)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([s], pa.int32()), pa.array([b], pa.int64()), pa.array([row["chunk"]], pa.int64()), pa.array([row["lengths"].to_pybytes()], pa.binary()),
                         *binary(have[mine].astype(np.int32), np.concatenate(([0], np.cumsum(sizes))).astype(np.int32), docs[at], tf[at])],
                        names=["owner", "bundle", "chunk", "lengths", "terms", "bounds", "docs", "tf"])

    (stored.select("chunk", "lengths", "terms", "bounds", "docs", "tf").mapInArrow(run, POSTINGS)
     .write.mode("overwrite").option("parquet.block.size", str(ROW_GROUP)).partitionBy("owner").parquet(owner_path))


def add_stage(s: int, shared, least, k: int):
    """The cogroup function of owner ``s``; ``least`` holds each item's lower bound so far."""
    def run(key, carried: pa.Table, postings: pa.Table):
        plan, floor = shared.value, least.value
        bundle, chunk = (x.as_py() for x in key)
        lo = bundle * plan.bundle
        items = min(plan.n_items - lo, plan.bundle)
        floor, rest, later = floor[lo:lo + items], plan.rest[s][lo:lo + items], plan.rest[s + 1][lo:lo + items]
        held = [(r["item"], np.frombuffer(r["docs"], np.int32), np.frombuffer(r["scores"], np.int64)) for r in carried.select(["item", "docs", "scores"]).to_pylist()]
        rows = postings.to_pylist()
        n = max([len(r["lengths"]) // 4 for r in rows] + [int(d.max()) + 1 for _, d, _ in held])
        score, seen = np.zeros((items, n), np.int64), np.zeros((items, n), bool)
        for i, d, x in held:
            score[i, d] = x
            seen[i, d] = x + rest[i] >= floor[i]
        opens = rest >= floor  # a document first found here can still reach the bound
        for r in rows:
            lengths, bounds = np.frombuffer(r["lengths"], np.int32).astype(np.int64), np.frombuffer(r["bounds"], np.int32)
            docs, tf = np.frombuffer(r["docs"], np.int32), np.frombuffer(r["tf"], np.int32).astype(np.int64)
            for term, a, b in zip(np.frombuffer(r["terms"], np.int32).tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                x, y = plan.first[term], plan.first[term + 1]
                own = (plan.item[x:y] >= lo) & (plan.item[x:y] < lo + items)
                who, d = plan.item[x:y][own] - lo, docs[a:b]
                grid = np.ix_(who, d)
                score[grid] += plan.repeats[x:y][own][:, None] * plan.contribution(term, tf[a:b], lengths[d])
                seen[grid] |= opens[who][:, None]
        keep = seen & (score > 0) & (score + later[:, None] >= floor[:, None])
        out = []
        for i in np.flatnonzero(keep.any(axis=1)).tolist():
            d = np.flatnonzero(keep[i])
            x = score[i, d]
            best = -np.sort(-x)[:k]
            if s == plan.stages - 1 and len(best) == k:  # the last stage: the chunk's best, ties included
                d, x = d[x >= best[-1]], x[x >= best[-1]]
            out.append((bundle, chunk, i, d.astype(np.int32).tobytes(), x.tobytes(), best.tolist()))
        columns = list(zip(*out)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["bundle", "chunk", "item", "docs", "scores", "best"])

    return run


def lower_bounds(carried: DataFrame, n_items: int, bundle: int, k: int) -> np.ndarray:
    """Each item's k-th best score so far (0: fewer)."""
    w = Window.partitionBy("bundle", "item").orderBy(F.desc("score"))
    ranked = carried.select("bundle", "item", F.explode("best").alias("score")).withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k)
    least = np.zeros(n_items, np.int64)
    for r in ranked.filter(F.col("r") == k).select((F.col("bundle") * bundle + F.col("item")).alias("i"), "score").toLocalIterator():
        least[r["i"]] = r["score"]
    return least


def search_block(stage: Staged, stored: DataFrame, items: list, name: str, k: int, bands: tuple, bundle: int, tasks: int) -> DataFrame:
    """(row, rank, doc_id, score) of a block: ``items`` are (row, term hashes)."""
    spark = stored.sparkSession
    v = Vocabulary([h for _, h in items])
    n_docs, n_terms, df = frequencies(stored, v.terms)
    plan = Plan(v, n_docs, max(1, n_terms), df, bands, bundle)
    shared = spark.sparkContext.broadcast(plan)
    path = stage.path(f"owners-{name}")
    owned(stored, shared, path)
    owners = spark.read.schema(POSTINGS).parquet(path)
    carried = spark.createDataFrame([], ACCUMULATORS)
    least = np.zeros(plan.n_items, np.int64)
    by = ["bundle", "chunk"]
    for s in range(plan.stages):
        left, right = (x.repartition(tasks, *by).groupBy(*by) for x in (carried, owners.filter(F.col("owner") == s).drop("owner")))
        bounds = spark.sparkContext.broadcast(least)
        carried = stage.write(left.cogroup(right).applyInArrow(add_stage(s, shared, bounds, k), ACCUMULATORS), f"carried-{name}-{s}")
        if s:
            stage.drop(f"carried-{name}-{s - 1}")
        least = lower_bounds(carried, plan.n_items, bundle, k)
    stage.drop(f"owners-{name}")
    numbers = [i for i, _ in items]

    def unpack(batches):
        for r in rows_of(batches):
            d, x = np.frombuffer(r["docs"], np.int32), np.frombuffer(r["scores"], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([numbers[r["bundle"] * bundle + r["item"]]] * len(d), pa.int64()),
                                              pa.array([r["doc_ids"][i] for i in d.tolist()], pa.int64()), pa.array(x)], names=["row", "doc_id", "score"])

    hits = (carried.join(stored.select("chunk", "doc_ids"), "chunk").select("bundle", "item", "docs", "scores", "doc_ids")
            .mapInArrow(unpack, "row long, doc_id long, score long"))
    w = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = TOP, bands: tuple = BANDS, bundle: int = BUNDLE, block_words: int = BLOCK_WORDS,
           id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` documents of highest score above 0."""
    spark = docs.sparkSession
    stage = Staged(spark, "search")

    def hashed(batches):
        for rows, data, offs in T.chunks(batches, "text"):
            h, first = term_hashes(data, offs)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(np.diff(first)), pa.array([h[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())],
                names=["row", "item_id", "n", "words"])

    kind = items.schema[item_col].dataType.simpleString()
    asked = (items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).distinct()
             .select(F.monotonically_increasing_id().alias("row"), "item_id", "text"))
    asked = stage.write(asked.mapInArrow(hashed, f"row long, item_id {kind}, n long, words binary").filter("n > 0"), "items")
    stored = stage.write(index(docs, id_col, text_col), "index", ROW_GROUP)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, math.ceil(stored.count() / TASK_CHUNKS))
    blocks = max(1, math.ceil((asked.agg(F.sum("n")).first()[0] or 0) / block_words))
    out = None
    for b in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).select("row", "words").toLocalIterator()
        block = sorted((r["row"], r["words"]) for r in part)
        if block:
            got = search_block(stage, stored, [(i, np.frombuffer(h, np.uint64)) for i, h in block], str(b), k, bands, bundle, tasks)
            out = got if out is None else out.unionByName(got)
    if out is None:
        return asked.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    return out.join(asked.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")
