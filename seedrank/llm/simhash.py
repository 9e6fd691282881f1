"""SimHash near-duplicate detection by deletion variants.

Every text gets a 64-bit SimHash of its word shingles. Two fingerprints link at ``max_bits``
differing bits or fewer. The fingerprint is cut into ``(max_bits + 1) // 2`` segments (two for three
bits), so at least one segment of a linked pair differs by at most one bit. For every segment, each
fingerprint is indexed under one key per bit position with that bit deleted (wildcard): segments
that differ by at most one bit share such a key. Equal keys meet in one shuffle over *distinct*
fingerprints, and the whole fingerprints are verified inside the key group.

Groups never become pairs: a key group returns the members' links to the smallest fingerprint of
their component inside the group (at most one row a member). A group of more than ``GROUP`` members
is dealt anew by the bits that its key has not fixed, cut into ``max_bits + 1`` parts of which a linked pair
agrees on one, and so on up to ``LEVELS`` times; after three bits' last level fewer than 14 bits are
open, so a group is bounded. Links are contracted to components by joins and grouped minima, with written tables
between rounds.

Nulls and texts without words have fingerprint zero and link like any other fingerprint; a text
shorter than the shingle is one shingle of all its words. Documents with a null id get a component
like others (the smallest non-null id reachable, null if there is none). Repeated rows share a
fingerprint and component. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedrank.llm import text as T
from seedrank.llm.tables import Staged

SHINGLE = 3
MAX_BITS = 3
#: members of a key group beyond which it is dealt anew by the bits still open, and how often
GROUP = 20_000
LEVELS = 4


def fingerprints_of(data: np.ndarray, offs: np.ndarray, shingle: int) -> np.ndarray:
    """SimHash of every document of a chunk (lower-cased A-Z, words joined by one space)."""
    starts, ends, first = T.words(data, offs, T.SPACE_SEPARATED)
    n_docs, n_words = len(offs) - 1, len(starts)
    out = np.zeros(n_docs, np.uint64)
    if not n_words:
        return out
    # normalised bytes: the words in order, one space after each
    lengths = ends - starts
    buf = np.full(int(lengths.sum()) + n_words, 32, np.uint8)
    at = np.concatenate(([0], np.cumsum(lengths + 1)))
    buf[T.ragged(at[:-1], lengths)] = T.lower_ascii(data[T.ragged(starts, lengths)])
    raw = buf.tobytes()
    per_doc = np.diff(first)
    n_sh = np.where(per_doc >= shingle, per_doc - shingle + 1, np.minimum(per_doc, 1))
    begin = T.ragged(first[:-1], n_sh)
    doc = np.repeat(np.arange(n_docs), n_sh)
    last = np.minimum(begin + shingle, first[doc + 1]) - 1
    view, digest = memoryview(raw), xxhash.xxh64_intdigest
    lo, hi = at[begin].tolist(), (at[last] + lengths[last]).tolist()
    h = np.fromiter((digest(view[a:b], 42) for a, b in zip(lo, hi)), np.uint64, len(lo))
    bounds = np.concatenate(([0], np.cumsum(n_sh)))
    has = np.flatnonzero(n_sh)
    counts = np.empty((len(has), 64), np.int64)
    for bit in range(64):
        counts[:, bit] = np.add.reduceat(((h >> np.uint64(bit)) & np.uint64(1)).astype(np.int32), bounds[has])
    ones = 2 * counts > n_sh[has][:, None]
    out[has] = (ones.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``."""
    def run(batches):
        for rows, data, offs in T.chunks(batches, "text"):
            fp = fingerprints_of(data, offs, shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(fp)], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, fp long")


def bit_count(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def group_links(members: np.ndarray, max_bits: int, block: int = 512) -> np.ndarray:
    """Of one key group: for each member the smallest member of its component under distance <=
    ``max_bits`` (labels spread until they no longer change; memory is one block of rows)."""
    label = members.copy()
    while True:
        new = label.copy()
        for lo in range(0, len(members), block):
            near = bit_count(members[lo:lo + block, None] ^ members[None, :]) <= max_bits
            new[lo:lo + block] = np.where(near, label[None, :], np.uint64(2**64 - 1)).min(axis=1)
        new = new[np.searchsorted(members, new)]
        if np.array_equal(new, label):
            return label
        label = new


def pair_links(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of many key groups, sorted by (key, fingerprint): small groups by comparing each member
    with the following ones (all groups at once), larger ones by ``group_links``."""
    same = np.concatenate(([False], keys[1:] == keys[:-1]))
    start = np.flatnonzero(~same)
    length = np.diff(np.concatenate((start, [len(keys)])))
    a_out, b_out = [], []
    small = length <= 8
    for d in range(1, int(length[small].max(initial=1))):
        s = start[small & (length > d)]
        i = T.ragged(s, length[small & (length > d)] - d)
        near = bit_count(fps[i] ^ fps[i + d]) <= max_bits
        a_out.append(fps[i[near]])
        b_out.append(fps[i[near] + d])
    for s, n in zip(start[~small], length[~small]):
        members = fps[s:s + n]
        label = group_links(members, max_bits)
        moved = label != members
        a_out.append(label[moved])
        b_out.append(members[moved])
    if not a_out:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    a, b = np.concatenate(a_out), np.concatenate(b_out)
    pairs = np.unique(np.stack([a, b], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.uint64)
    return pairs[:, 0], pairs[:, 1]


def segment_bounds(bits: int, parts: int) -> list[tuple[int, int]]:
    cuts = [round(bits * i / parts) for i in range(parts + 1)]
    return list(zip(cuts[:-1], cuts[1:]))


def variant_keys(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """One-wildcard keys of every segment: (key, index of the fingerprint)."""
    parts = (max_bits + 1) // 2 if max_bits else 1
    keys, number = [], 0
    for lo, hi in segment_bounds(64, parts):
        seg = (fp >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)
        for bit in range(hi - lo):
            with np.errstate(over="ignore"):
                keys.append(T.mix64((seg & ~np.uint64(1 << bit)) * np.uint64(2 * 64 + 1) + T.BYTE_VALUES[number % 256] + np.uint64(number)))
            number += 1
    return np.concatenate(keys) if keys else np.zeros(0, np.uint64), np.tile(np.arange(len(fp)), number)


def links(distinct: DataFrame, max_bits: int = MAX_BITS, group: int = GROUP, stage: Staged | None = None) -> DataFrame:
    """(a, b) links between distinct fingerprints ``fp`` that connect every pair at ``max_bits`` or
    fewer differing bits (the transitive closure is that of all such pairs)."""
    stage = stage or Staged(distinct.sparkSession, "simhash")

    def index(batches):
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            for lo in range(0, len(fp), 4096):
                part = fp[lo:lo + 4096]
                key, i = variant_keys(part, max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(part[i].view(np.int64))], names=["key", "fp"])

    def deal_anew(first: bool):
        """Keys of the next level for rows (key, fp, free)."""
        def run(batches):
            for b in batches:
                key, fp = b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy().view(np.uint64)
                for lo in range(0, len(fp), 4096):
                    part, own = fp[lo:lo + 4096], key[lo:lo + 4096]
                    free = free_bits(own, part, max_bits) if first else b.column(2).to_numpy().view(np.uint64)[lo:lo + 4096]
                    k, i, left = finer_keys(own, part, free, max_bits)
                    yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (k, part[i], left)], names=["key", "fp", "free"])
        return run

    def match(batches: Iterator[pa.RecordBatch]):
        """Rows come sorted by key within the partition; a group that a batch cuts is carried on."""
        key, fp = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        for b in batches:
            key = np.concatenate((key, b.column(0).to_numpy().view(np.uint64)))
            fp = np.concatenate((fp, b.column(1).to_numpy().view(np.uint64)))
            if not len(key):
                continue
            done = int(np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))[-1])
            if done:
                yield from emit(key[:done], fp[:done])
                key, fp = key[done:], fp[done:]
        if len(key):
            yield from emit(key, fp)

    def emit(key, fp):
        order = np.lexsort((fp, key))
        a, b = pair_links(key[order], fp[order], max_bits)
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    rows = distinct.select("fp").mapInArrow(index, "key long, fp long")
    def split_off(rows: DataFrame, name: str) -> tuple[DataFrame, DataFrame | None]:
        """Rows of groups of at most ``group`` members, and those of larger ones (None: there are none)."""
        big = stage.write(rows.groupBy("key").count().filter(F.col("count") > group).select("key"), name)
        if big.isEmpty():
            return rows, None
        return rows.join(big, "key", "left_anti"), rows.join(big, "key", "left_semi")

    ready, hot = split_off(rows, "big_groups")
    ready = ready.select("key", "fp")
    for level in range(LEVELS):
        if hot is None:
            break
        dealt = stage.write(hot.mapInArrow(deal_anew(level == 0), "key long, fp long, free long").distinct(), f"dealt{level}")
        small, hot = split_off(dealt, f"big_groups{level}")
        ready = ready.unionByName(small.select("key", "fp"))
    if hot is not None:
        ready = ready.unionByName(hot.select("key", "fp"))
    found = ready.repartition("key").sortWithinPartitions("key").mapInArrow(match, "a long, b long")
    return found.distinct()


def free_bits(key: np.ndarray, fp: np.ndarray, max_bits: int) -> np.ndarray:
    """Bits outside the segment that a first-level key was made of (the key tells which it is)."""
    keys, _ = variant_keys(fp, max_bits)
    of = (keys.reshape(-1, len(fp)) == key).argmax(axis=0)
    out = np.zeros(len(fp), np.uint64)
    number = 0
    for lo, hi in segment_bounds(64, (max_bits + 1) // 2 if max_bits else 1):
        mine = (of >= number) & (of < number + hi - lo)
        out[mine] = ~np.uint64(((1 << (hi - lo)) - 1) << lo)
        number += hi - lo
    return out


def finer_keys(key: np.ndarray, fp: np.ndarray, free: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The next level of a group's keys: the bits that no key has fixed yet (``free``) are cut into ``max_bits + 1`` parts, on one of
    which any linked pair agrees; each part in turn is fixed. (key, index of the row, bits that stay free)."""
    keys, rows, left = [], [], []
    for mask in np.unique(free):
        at = np.flatnonzero(free == mask)
        bits = [b for b in range(64) if int(mask) >> b & 1]
        for number, (lo, hi) in enumerate(segment_bounds(len(bits), max_bits + 1)):
            part = np.uint64(sum(1 << b for b in bits[lo:hi]))
            with np.errstate(over="ignore"):
                keys.append(T.mix64(T.mix64(key[at] + np.uint64(number)) + (fp[at] & part) * np.uint64(0x9E3779B97F4A7C15) + part))
            rows.append(at)
            left.append(np.full(len(at), mask & ~part, np.uint64))
    return np.concatenate(keys), np.concatenate(rows), np.concatenate(left)


def components(edges: DataFrame, stage: Staged) -> DataFrame:
    """(v, root): connected components of (a, b) edges, root = smallest member, by contraction.

    A round points every vertex to its smallest neighbour or itself and follows the pointers to their end by doubling
    (``jump``), then relabels the edges and drops loops. Only vertices that are smaller than all their neighbours are
    left, at most half of them, so the number of rounds is logarithmic, and so is the number of doublings in a
    round, however long a path is."""
    both = lambda e: e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    e = stage.write(edges, "edges0")
    labels, r = None, 0
    while not e.isEmpty():
        step = jump(stage.write(both(e).groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("p")), f"step{r}"), stage, f"step{r}")
        to_a, to_b = step.select(F.col("v").alias("a"), F.col("p").alias("pa")), step.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        nxt = (e.join(to_a, "a").join(to_b, "b").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
               .filter("a <> b").distinct())
        nxt = stage.write(nxt, f"edges{r + 1}")
        if labels is None:
            new = step.select("v", F.col("p").alias("root"))
        else:
            new = labels.join(step.select(F.col("v").alias("root"), "p"), "root", "left").select("v", F.coalesce("p", "root").alias("root"))
        labels = stage.write(new, f"labels{r}")
        stage.drop(f"edges{r}", *([f"labels{r - 1}"] if r else []))
        e, r = nxt, r + 1
    if labels is None:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("root"))
    return labels


def jump(step: DataFrame, stage: Staged, name: str) -> DataFrame:
    """Pointers (v, p) followed to their end: p becomes p's pointer until nothing moves."""
    k = 0
    while True:
        onward = step.select(F.col("v").alias("p"), F.col("p").alias("q"))
        nxt = stage.write(step.join(onward, "p").select("v", F.col("q").alias("p"), (F.col("q") != F.col("p")).alias("moved")), f"{name}_{k}")
        if nxt.filter("moved").isEmpty():
            return step
        step, k = nxt.select("v", "p"), k + 1


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, group: int = GROUP,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row of ``docs``."""
    stage = Staged(docs.sparkSession, "simhash")
    fps = stage.write(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    distinct = stage.write(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct, max_bits, group, stage), stage)
    of = distinct.join(roots.withColumnRenamed("v", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = of.groupBy("root").agg(F.min("least").alias("component_id"))
    per_fp = stage.write(of.join(least, "root").select("fp", "component_id"), "classes")
    return fps.join(per_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
