"""Boosted regression trees, one model per set, all sets at once.

MLlib fits one model at a time; here every set has its own trees, so a set's predictions do not depend on the
other sets. Features are standardised per set and cut at fixed normal quantiles into ``BINS`` bins (a byte
each), so no pass over the data is needed to find cut points, and a tree level needs only the gradient
histogram per (set, node, feature, bin).

A set whose fit takes at most ``MAX_BYTES`` is fitted in one task from its bytes (rows x features). A larger set is never
gathered: every level is one pass, in which tasks add up their histograms, the sums meet per
(set, feature), and the best cuts, a few numbers a node, go back with the next pass. Both ways grow the same trees.

Rows and features are sampled per tree by hash, so a retry grows the same trees."""

from __future__ import annotations

import statistics
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedrank.functions.params import materialize

BINS = 32
#: our own bounds: bytes of a set that one task fits (a row: its bins as they come and by feature, and its numbers), and larger sets
#: that are fitted in the same passes
MAX_BYTES, ROW_BYTES = 600_000_000, 130
#: columns of a binned row beside its key, id and what is kept: hash, bins, target
HASH, BINNED, TARGET = "__boost_h", "__boost_x", "__boost_y"
BLOCK_SETS = 64
MAX_TASKS = 2_000
EDGES = np.array([statistics.NormalDist().inv_cdf(i / BINS) for i in range(1, BINS)])


@dataclass
class Shape:
    """The reference's settings of its filter model are the defaults."""

    trees: int = 100
    depth: int = 5
    rate: float = 0.05
    rows: float = 0.8
    features: float = 0.8
    ridge: float = 1.0
    seed: int = 42


@dataclass
class Trees:
    """A set's model: per tree and level the feature and cut of every node, and the leaves' values."""

    base: float = 0.0
    splits: list[list[tuple[np.ndarray, np.ndarray]]] = field(default_factory=list)
    values: list[np.ndarray] = field(default_factory=list)

    def nodes(self, x: np.ndarray, tree: int) -> np.ndarray:
        """The node of every row after the levels that the tree has."""
        node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for feature, cut in self.splits[tree]:
            node = 2 * node + (x[rows, feature[node]] > cut[node])
        return node

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for t, value in enumerate(self.values):
            out += value[self.nodes(x, t)]
        return out


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """Uniform numbers in [0, 1) from 64-bit hashes and a salt."""
    with np.errstate(over="ignore"):
        h = (x ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(11)).astype(float) / (1 << 53)


def used_features(shape: Shape, tree: int, p: int) -> np.ndarray:
    draw = _mix(np.arange(1, p + 1, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D), shape.seed * 100_003 + tree)
    return np.sort(np.argsort(draw, kind="stable")[: max(1, round(shape.features * p))])


def histogram(x: np.ndarray, g: np.ndarray, node: np.ndarray, nodes: int, used: np.ndarray, take: np.ndarray | None = None) -> np.ndarray:
    """(2, nodes, features used, bins): sums of residuals and counts of the rows of ``x`` that ``take`` marks (None: all), a feature at a
    time (a number a row beside the bins)."""
    out, first = np.empty((2, nodes, len(used), BINS)), node * BINS
    for j, f in enumerate(used):
        cell = first + (x[:, f] if take is None else x[:, f][take])
        out[0, :, j] = np.bincount(cell, g, nodes * BINS).reshape(nodes, BINS)
        out[1, :, j] = np.bincount(cell, minlength=nodes * BINS).reshape(nodes, BINS)
    return out


def gains(hist: np.ndarray, ridge: float) -> np.ndarray:
    """Gain of every cut (bins up to it go left) of (2, nodes, features, bins)."""
    left = hist.cumsum(axis=3)
    g, n = left
    gt, nt = g[:, :, -1:], n[:, :, -1:]
    gain = g ** 2 / (n + ridge) + (gt - g) ** 2 / (nt - n + ridge) - gt ** 2 / (nt + ridge)
    return np.where((n > 0) & (nt - n > 0), gain, 0.0)


def best_cuts(gain: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node's feature and cut; a node without gain sends all rows left (cut ``BINS``)."""
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)
    found = flat[np.arange(len(gain)), at] > 1e-12
    return used[at // BINS], np.where(found, at % BINS, BINS)


def fit_one(x: np.ndarray, y: np.ndarray, h: np.ndarray, shape: Shape) -> tuple[Trees, np.ndarray]:
    """The model of one set, and its predictions: bins ``x`` (by feature in memory), targets, row hashes. A tree's rows are taken a
    feature at a time."""
    model = Trees(float(y.mean()))
    margin = np.full(len(y), model.base)
    for t in range(shape.trees):
        take = _mix(h, shape.seed * 1_000_003 + t) < shape.rows
        if not take.any():
            take[:] = True
        at, g, used = np.flatnonzero(take), (y - margin)[take], used_features(shape, t, x.shape[1])
        model.splits.append([])
        node = np.zeros(len(at), np.int64)
        for level in range(shape.depth):
            feature, cut = best_cuts(gains(histogram(x, g, node, 1 << level, used, take), shape.ridge), used)
            model.splits[-1].append((feature, cut))
            node = 2 * node + (x[at, feature[node]] > cut[node])
        leaves = 1 << shape.depth
        value = shape.rate * np.bincount(node, g, leaves) / (np.bincount(node, minlength=leaves) + shape.ridge)
        model.values.append(value)
        margin += value[model.nodes(x, t)]
    return model, margin


# ---------------------------------------------------------------- all sets

def binned(rows: DataFrame, key: str, id_col: str, z: str, target: str, keep: Sequence[str] = ()) -> DataFrame:
    """(key, id, ``keep``, hash, bins, target) written once: bins of the standardised features ``z`` (array<double>, NULL as 0) as bytes, so
    neither the features nor their standardised values are written."""
    names = [key, id_col, *keep, HASH, BINNED, TARGET]

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            values = np.nan_to_num(b.column(len(names) - 2).flatten().to_numpy(zero_copy_only=False).astype(float))
            x = np.searchsorted(EDGES, values, side="left").astype(np.uint8).reshape(b.num_rows, -1)
            bins = pa.array([r.tobytes() for r in x], pa.binary())
            yield pa.RecordBatch.from_arrays([bins if n == BINNED else b.column(i) for i, n in enumerate(names)], names=names)

    kinds = dict(rows.dtypes)
    src = rows.select(key, id_col, *keep, F.xxhash64(id_col).alias(HASH), F.col(z).alias(BINNED), F.col(target).cast("double").alias(TARGET))
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in (key, id_col, *keep)] + [f"{HASH} long, {BINNED} binary, {TARGET} double"])
    return materialize(src.mapInArrow(run, schema), "boost_rows")


def _matrix(column) -> np.ndarray:
    """The rows' bins, all of one length, read from the column's buffers."""
    parts = []
    for c in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        if len(c):
            _, offsets, data = c.buffers()
            at = np.frombuffer(offsets, np.int64 if pa.types.is_large_binary(c.type) else np.int32)[c.offset:c.offset + len(c) + 1]
            parts.append(np.frombuffer(data, np.uint8)[at[0]:at[-1]].reshape(len(c), -1))
    return np.concatenate(parts) if len(parts) != 1 else parts[0]


def _hashes(column) -> np.ndarray:
    return column.to_numpy().view(np.uint64) if not isinstance(column, pa.ChunkedArray) else column.combine_chunks().to_numpy().astype(np.int64).view(np.uint64)


def _by_feature(group: pa.Table, place: np.ndarray) -> np.ndarray:
    """The group's bins, by feature in memory: row i at ``place[i]``. A chunk at a time, so that there is one copy beside the group's own."""
    chunks, at, out = [_matrix(c) for c in group.column(BINNED).chunks if len(c)], 0, None
    for c in chunks:
        out = np.empty((len(place), c.shape[1]), np.uint8, order="F") if out is None else out
        out[place[at:at + len(c)]] = c
        at += len(c)
    return out


def boosted_predictions(rows: DataFrame, z: str, target: str, key: str = "set_id", id_col: str = "item_id", out: str = "prediction",
                        shape: Shape | None = None, max_rows: int | None = None) -> DataFrame:
    """(key, id, ``out``) of every row: the prediction of its set's trees for ``target`` from the features ``z``. Ids must be
    unique within a set; a NULL target is not allowed. ``max_rows``: rows of a set that one task fits, by default as many as
    ``MAX_BYTES`` hold."""
    return fitted_predictions(binned(rows, key, id_col, z, target), key, id_col, out, shape, max_rows)


def fitted_predictions(table: DataFrame, key: str = "set_id", id_col: str = "item_id", out: str = "prediction", shape: Shape | None = None,
                       max_rows: int | None = None) -> DataFrame:
    """``boosted_predictions`` of ``binned`` rows."""
    shape = shape or Shape()
    table = table.select(key, id_col, HASH, BINNED, TARGET)
    sizes = table.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.avg(TARGET).alias("base"), F.octet_length(F.first(BINNED)).alias("p"))
    sizes = materialize(sizes, "boost_sizes")
    most = F.lit(MAX_BYTES) / (2 * F.col("p") + ROW_BYTES) if max_rows is None else F.lit(max_rows)
    large = sizes.where(F.col("n") > most).orderBy(key)
    schema = f"{key} {dict(table.dtypes)[key]}, {id_col} {dict(table.dtypes)[id_col]}, {out} double"

    def whole(group: pa.Table) -> pa.Table:
        y, h = group.column(TARGET).to_numpy(), _hashes(group.column(HASH))
        order = np.lexsort((y, h))  # sums in an order that does not depend on the tasks
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        x, y, h = _by_feature(group, place), y[order], h[order]
        del order
        return pa.table([group.column(key), group.column(id_col), pa.array(fit_one(x, y, h, shape)[1][place])], names=[key, id_col, out])

    wide = [(r[key], float(r["base"]), int(r["p"])) for r in large.collect()]  # at most rows / max_rows sets
    small = table if not wide else table.join(F.broadcast(large.select(key)), key, "left_anti")
    # sets are few and their fits long: dealt over many tasks, so that a task seldom has two
    tasks = max(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(8 * sizes.count(), MAX_TASKS))
    parts = small.repartition(tasks, key).groupBy(key).applyInArrow(whole, schema)
    for lo in range(0, len(wide), BLOCK_SETS):
        parts = parts.unionByName(_wide_predictions(table, wide[lo:lo + BLOCK_SETS], key, id_col, out, shape, schema))
    return parts


def _groups(batch: pa.RecordBatch, key: str, known: dict):
    """(set, row numbers) of the known sets of a batch."""
    names = np.array(batch.column(batch.schema.get_field_index(key)).to_pylist(), object)
    for name in dict.fromkeys(names.tolist()):
        if name in known:
            yield name, np.flatnonzero(names == name)


def _wide_predictions(table: DataFrame, sets: list, key: str, id_col: str, out: str, shape: Shape, schema: str) -> DataFrame:
    """Trees of sets that no task holds: one pass a level."""
    spark = table.sparkSession
    own = table.where(F.col(key).isin([s for s, _, _ in sets]))
    models = {s: Trees(base) for s, base, _ in sets}
    width = {s: p for s, _, p in sets}
    kind = dict(table.dtypes)[key]

    def level_sums(level: int, t: int):
        """Partial histograms (or, past the last level, leaf sums) of every task: (set, feature, cells)."""
        shared = spark.sparkContext.broadcast(models)

        def run(batches):
            known, sums = shared.value, {}
            for b in batches:
                for s, at in _groups(b, key, known):
                    x = _matrix(b.column(b.schema.get_field_index(BINNED)).take(pa.array(at)))
                    h = _hashes(b.column(b.schema.get_field_index(HASH)).take(pa.array(at)))
                    take = _mix(h, shape.seed * 1_000_003 + t) < shape.rows
                    x, y = x[take], b.column(b.schema.get_field_index(TARGET)).to_numpy()[at][take]
                    m = known[s]
                    g, node = y - m.predict(x), m.nodes(x, t)
                    if level < shape.depth:
                        part = histogram(x, g, node, 1 << level, used_features(shape, t, width[s]))
                    else:
                        n = 1 << level
                        part = np.stack([np.bincount(node, g, n), np.bincount(node, minlength=n).astype(float)]).reshape(2, n, 1, 1)
                    sums[s] = sums.get(s, 0.0) + part
            rows = [(s, f, part[:, :, f].tobytes()) for s, part in sums.items() for f in range(part.shape[2])]
            if rows:
                names, features, cells = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(names, type=key_type), pa.array(features, pa.int32()), pa.array(cells, pa.binary())], names=[key, "f", "cells"])

        key_type = pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()
        return own.mapInArrow(run, f"{key} {kind}, f int, cells binary")

    def add_up(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c, float) for c in group.column("cells").to_pylist())
        return pa.table([group.column(key).slice(0, 1), group.column("f").slice(0, 1), pa.array([total.tobytes()], pa.binary())], names=[key, "f", "cells"])

    for t in range(shape.trees):
        for m in models.values():
            m.splits.append([])
        for level in range(shape.depth + 1):
            sums = level_sums(level, t).groupBy(key, "f").applyInArrow(add_up, f"{key} {kind}, f int, cells binary")
            got: dict = {}
            for r in sums.toLocalIterator():  # per set and feature: a few numbers a node
                got.setdefault(r[key], {})[r["f"]] = np.frombuffer(r["cells"], float)
            for s, m in models.items():
                n = 1 << level
                if level < shape.depth:
                    used = used_features(shape, t, width[s])
                    hist = np.stack([got[s][f].reshape(2, n, BINS) for f in range(len(used))], axis=2) if s in got else np.zeros((2, n, len(used), BINS))
                    m.splits[t].append(best_cuts(gains(hist, shape.ridge), used))
                else:
                    g, c = got[s][0].reshape(2, n) if s in got else np.zeros((2, n))
                    m.values.append(shape.rate * g / (c + shape.ridge))
    final = spark.sparkContext.broadcast(models)

    def predict(batches):
        for b in batches:
            for s, at in _groups(b, key, final.value):
                x = _matrix(b.column(b.schema.get_field_index(BINNED)).take(pa.array(at)))
                rows = pa.array(at)
                yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(1).take(rows), pa.array(final.value[s].predict(x))], names=[key, id_col, out])

    return own.mapInArrow(predict, schema)


def standardized_array(rows: DataFrame, x: str, dim: int, key: str, out: str, keep: Sequence[str]) -> DataFrame:
    """``keep`` with ``out``: the array ``x`` standardised per set (population deviation, zero → 1; NULL entries → 0)."""
    from seedrank.functions import exprs as X
    from seedrank.functions.params import attach
    from seedrank.operators import vectors as V

    stats = V.array_stats(rows, [key], x, dim)
    j = attach(rows, stats, key)
    z = F.transform(F.zip_with(x, F.arrays_zip("__mean", "__sd"), lambda v, s: X.standardized(v, s["__mean"], s["__sd"])), lambda v: F.coalesce(v, F.lit(0.0)))
    return j.select(*keep, z.alias(out))
