"""Ridge logistic regression of every set at once over sparse named inputs (M4, M5), without a matrix.

Newton's method with the step of each round solved by conjugate gradients: the second derivatives are only ever
multiplied by a vector, which for sparse rows is two passes over their entries, so no pair of inputs is formed and the
state is a few vectors of the inputs.

A set of at most ``max_entries`` row entries is fitted in one task (bounded by its entries, which come as 64-bit hashes of their names; where
two names of a set share one, as the names). A larger set is never gathered: its inputs are numbered by hash buckets (no task sees all its names), its rows stay where they are written, and
every product is one pass in which tasks add up what their rows give and the sums meet per input; vectors of
8 bytes an input travel, for sets of at most ``BLOCK_INPUTS`` inputs together (or one larger set)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seedrank.functions.params import materialize

#: our own bounds: entries of a set that one task fits (about 20 bytes each; as texts), tasks, entries that it works on at once, and
#: inputs whose vectors travel together
MAX_ENTRIES, MAX_TEXT_ENTRIES = 28_000_000, 4_000_000
MAX_TASKS = 2_000
BLOCK_ENTRIES = 1_000_000
BLOCK_INPUTS = 4_000_000
NAME_BUCKETS = 256
TOLERANCE = 1e-9


def conjugate_gradient(times: Callable[[np.ndarray], np.ndarray], diagonal: np.ndarray, rhs: np.ndarray, tol: float = 1e-12) -> np.ndarray:
    """Solution of the symmetric system whose product with a vector is ``times``, preconditioned with ``diagonal``. Ends when the
    residual is ``tol`` of the right side or, at the limit of double precision, after twice as many steps as unknowns (50 at least)."""
    out, r = np.zeros(len(rhs)), rhs.copy()
    z = r / diagonal
    p, rz, stop = z.copy(), float(r @ z), tol * float(np.abs(rhs).max(initial=0.0))
    for _ in range(max(50, 2 * len(rhs))):
        if np.abs(r).max(initial=0.0) <= stop:
            break
        q = times(p)
        step = rz / float(p @ q)
        out += step * p
        r -= step * q
        z = r / diagonal
        rz, before = float(r @ z), rz
        p = z + (rz / before) * p
    return out


class Rows:
    """Sparse rows: entry ``k`` is input ``at[k]`` of row ``row[k]`` with value ``v[k]``."""

    def __init__(self, row: np.ndarray, at: np.ndarray, v: np.ndarray, n: int):
        self.row, self.at, self.v, self.n = row, at, v, n

    def times(self, b: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.v * b[self.at], self.n)

    def back(self, s: np.ndarray, inputs: int) -> np.ndarray:
        return np.bincount(self.at, self.v * s[self.row], inputs)

    def square(self, s: np.ndarray, inputs: int) -> np.ndarray:
        return np.bincount(self.at, self.v ** 2 * s[self.row], inputs)


def newton(gradient, product, inputs: int, reg: float, max_rounds: int, tol: float = TOLERANCE) -> np.ndarray:
    """Coefficients; input 0 is the intercept, which is free. ``gradient(b)`` gives (sums of w (p - y) x, sums of w p (1 - p) x², Σ w);
    ``product(b, d)`` the sums of w p (1 - p) (x d) x."""
    ridge = np.full(inputs, reg)
    ridge[0] = 0.0
    b = np.zeros(inputs)
    for _ in range(max_rounds):
        g, square, total = gradient(b)
        step = conjugate_gradient(lambda d, b=b, total=total: product(b, d) / total + (ridge + 1e-12) * d, square / total + ridge + 1e-12, g / total + ridge * b)
        b = b - step
        if np.abs(step).max() < tol:
            break
    return b


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -700, 700)))


def _terms(x: Rows, y: np.ndarray, w: np.ndarray, b: np.ndarray, inputs: int) -> tuple[np.ndarray, np.ndarray]:
    p = _sigmoid(x.times(b))
    return x.back(w * (p - y), inputs), x.square(w * p * (1 - p), inputs)


def _hessian_times(x: Rows, w: np.ndarray, b: np.ndarray, d: np.ndarray, inputs: int) -> np.ndarray:
    p = _sigmoid(x.times(b))
    return x.back(w * p * (1 - p) * x.times(d), inputs)


def fit_rows(x: Rows, y: np.ndarray, w: np.ndarray, inputs: int, reg: float, max_rounds: int) -> np.ndarray:
    total = w.sum()
    return newton(lambda b: (*_terms(x, y, w, b, inputs), total), lambda b, d: _hessian_times(x, w, b, d, inputs), inputs, reg, max_rounds)


class Blocks:
    """A set's rows in blocks of few entries: numbers of 4 bytes, and values only of entries that are not 1. Input 0 is the intercept."""

    def __init__(self, ones: pa.ChunkedArray, valued: pa.ChunkedArray, n: int):
        own = [np.unique(c.flatten().to_numpy(zero_copy_only=False)) for c in ones.chunks]
        own += [np.unique(c.flatten().field("i").to_numpy(zero_copy_only=False)) for c in valued.chunks]
        names = np.unique(np.concatenate(own)) if own else np.zeros(0, np.int64)
        self.n, self.inputs, self.parts = n, len(names) + 1, []
        number = lambda a: (np.searchsorted(names, a) + 1).astype(np.int32)
        lo = 0
        for a, b in zip(ones.chunks, valued.chunks):
            for at in range(0, len(a), step := max(1, BLOCK_ENTRIES * len(a) // max(len(a) + len(a.flatten()) + len(b.flatten()), 1))):
                (row, name), (vrow, entry) = _entries(a.slice(at, step)), _entries(b.slice(at, step))
                m = len(a.slice(at, step))
                one = Rows(np.r_[np.arange(m), row].astype(np.int32), np.r_[np.zeros(m, np.int32), number(name.to_numpy(zero_copy_only=False))], 1.0, m)
                rest = Rows(vrow.astype(np.int32), number(entry.field("i").to_numpy(zero_copy_only=False)), entry.field("v").to_numpy(zero_copy_only=False).copy(), m)
                self.parts.append((slice(lo, lo + m), one, rest))
                lo += m

    def times(self, b: np.ndarray) -> np.ndarray:
        out = np.empty(self.n)
        for at, one, rest in self.parts:
            out[at] = one.times(b) + rest.times(b)
        return out

    def back(self, s: np.ndarray) -> np.ndarray:
        return sum((one.back(s[at], self.inputs) + rest.back(s[at], self.inputs) for at, one, rest in self.parts), np.zeros(self.inputs))

    def square(self, s: np.ndarray) -> np.ndarray:
        return sum((one.square(s[at], self.inputs) + rest.square(s[at], self.inputs) for at, one, rest in self.parts), np.zeros(self.inputs))

    def fit(self, y: np.ndarray, w: np.ndarray, reg: float, max_rounds: int) -> np.ndarray:
        """``fit_rows`` over blocks; what depends on the round's coefficients only is computed once a round."""
        total, curve = w.sum(), np.empty(0)

        def gradient(b):
            nonlocal curve
            p = _sigmoid(self.times(b))
            curve = w * p * (1 - p)
            return self.back(w * (p - y)), self.square(curve), total

        return newton(gradient, lambda b, d: self.back(curve * self.times(d)), self.inputs, reg, max_rounds)


def _entries(lists) -> tuple[np.ndarray, pa.StructArray]:
    """Row of every entry, and the entries, of a column of lists of structs."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    return np.repeat(np.arange(len(sizes)), sizes), lists.flatten()


def _numbered_rows(lists: pa.ChunkedArray, n: int) -> tuple[Rows, int]:
    """The rows' entries with the intercept's (input 0) first, and the number of inputs, which are in the order of their names. A
    chunk's texts become numbers before the next one is looked at, and every number is written where it stays."""
    known, at_row = {}, 0
    size = n + sum(len(c.flatten()) for c in lists.chunks)
    row, at, v = np.empty(size, np.int64), np.zeros(size, np.int64), np.ones(size)
    row[:n], k = np.arange(n), n
    for c in lists.chunks:
        own, entries = _entries(c)
        names, end = entries.field("name").dictionary_encode(), k + len(own)
        if len(own):
            row[k:end], v[k:end] = own + at_row, entries.field("v").to_numpy(zero_copy_only=False)
            number = np.array([known.setdefault(t, len(known)) for t in names.dictionary.to_pylist()], np.int64)
            at[k:end] = number[names.indices.to_numpy(zero_copy_only=False)]
        at_row, k = at_row + len(c), end
    order = np.argsort(np.array(list(known), object).astype(str), kind="stable") if known else np.zeros(0, np.int64)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(1, len(order) + 1)
    at[n:] = place[at[n:]] if len(order) else at[n:]
    return Rows(row, at, v, n), len(order) + 1


def logistic_probabilities(rows: DataFrame, key: str, id_col: str, reg: float, max_rounds: int = 50, max_entries: int = MAX_ENTRIES) -> DataFrame:
    """(key, id, glm_probability) of the rows with ``__y`` 0. ``rows``: key, id, ``__y``, ``__w``, ``__f`` array<struct<name, v>> (inputs
    that are not 0; the intercept is added). Minimises Σ w·loss / Σ w + reg/2·|b|², the intercept free, per set."""
    rows = materialize(rows, "glm_rows")
    every = rows.groupBy(key).agg(F.sum(F.size("__f")).alias("n"))
    # equal hashes of unlike names would make two inputs one; names repeat, so tasks count most of them away
    hashes = rows.select(key, F.explode("__f.name").alias("name")).distinct().groupBy(key, F.xxhash64("name")).agg(F.count(F.lit(1)).alias("n"))
    text = not hashes.where(F.col("n") > 1).isEmpty()
    sizes = every.where(F.col("n") > (min(max_entries, MAX_TEXT_ENTRIES) if text else max_entries))
    wide = [r[key] for r in sizes.collect()]  # at most all entries / max_entries sets
    kinds = dict(rows.dtypes)
    schema = f"{key} {kinds[key]}, {id_col} {kinds[id_col]}, glm_probability double"

    def scored(group: pa.Table, p: np.ndarray, y: np.ndarray) -> pa.Table:
        item = pa.array(np.flatnonzero(y == 0.0))
        return pa.table([group.column(key).take(item), group.column(id_col).take(item), pa.array(p).take(item)], names=[key, id_col, "glm_probability"])

    def by_name(group: pa.Table) -> pa.Table:
        n = group.num_rows
        x, inputs = _numbered_rows(group.column("__f"), n)
        y, w = group.column("__y").to_numpy(), group.column("__w").to_numpy()
        group = group.select([key, id_col])  # the entries' texts can go
        return scored(group, _sigmoid(x.times(fit_rows(x, y, w, inputs, reg, max_rounds))), y)

    def by_hash(group: pa.Table) -> pa.Table:
        x = Blocks(group.column("__one"), group.column("__rest"), group.num_rows)
        y, w = group.column("__y").to_numpy(), group.column("__w").to_numpy()
        return scored(group, _sigmoid(x.times(x.fit(y, w, reg, max_rounds))), y)

    small = rows.where(~F.col(key).isin(wide)) if wide else rows
    # sets are few and their fits long: dealt over many tasks, so that a task seldom has two
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(8 * every.count(), MAX_TASKS))
    if text:
        out = small.repartition(tasks, key).groupBy(key).applyInArrow(by_name, schema)
    else:
        ones = F.transform(F.filter("__f", lambda e: e["v"] == 1.0), lambda e: F.xxhash64(e["name"]))
        rest = F.transform(F.filter("__f", lambda e: e["v"] != 1.0), lambda e: F.struct(F.xxhash64(e["name"]).alias("i"), e["v"].alias("v")))
        packed = small.select(key, id_col, "__y", "__w", ones.alias("__one"), rest.alias("__rest"))
        out = packed.repartition(tasks, key).groupBy(key).applyInArrow(by_hash, schema)
    return out.unionByName(_wide_probabilities(rows.where(F.col(key).isin(wide)), key, id_col, reg, max_rounds, schema)) if wide else out


# ---------------------------------------------------------------- sets that no task holds

def numbered_inputs(rows: DataFrame, key: str) -> DataFrame:
    """(key, name, i): a set's inputs numbered from 1 without a task that sees them all: by place in their hash bucket,
    after the buckets before."""
    names = rows.select(key, F.explode("__f.name").alias("name")).distinct().withColumn("__b", F.pmod(F.xxhash64("name"), F.lit(NAME_BUCKETS)).cast("int"))
    placed = names.withColumn("__r", F.row_number().over(Window.partitionBy(key, "__b").orderBy("name")))
    counts = names.groupBy(key, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.withColumn("__o", F.sum("__n").over(Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)))
    return placed.join(before, [key, "__b"]).select(key, "name", (F.coalesce("__o", F.lit(0)) + F.col("__r")).cast("int").alias("i"))


def _wide_probabilities(rows: DataFrame, key: str, id_col: str, reg: float, max_rounds: int, schema: str) -> DataFrame:
    numbers = materialize(numbered_inputs(rows, key), "glm_numbers")
    tagged = materialize(rows.withColumn("__row", F.monotonically_increasing_id()), "glm_wide")
    entries = tagged.select("__row", key, F.explode("__f").alias("e")).select("__row", key, F.col("e.name").alias("name"), F.col("e.v").alias("v"))
    lists = (entries.join(numbers, [key, "name"]).groupBy("__row").agg(F.collect_list(F.struct("i", "v")).alias("__x")))
    empty = F.array().cast("array<struct<i:int,v:double>>")
    train = materialize(tagged.drop("__f").join(lists, "__row", "left").select(key, id_col, "__y", "__w", F.coalesce("__x", empty).alias("__x")), "glm_train")
    sizes = sorted(((r[key], r["n"], r["w"]) for r in train.groupBy(key).agg(F.sum("__w").alias("w")).join(
        numbers.groupBy(key).agg((F.max("i") + 1).alias("n")), key).collect()), key=lambda r: str(r[0]))
    out, block = None, []
    for s in [*sizes, None]:
        if block and (s is None or sum(n for _, n, _ in block) + s[1] > BLOCK_INPUTS):
            part = _fit_block(train, key, id_col, block, reg, max_rounds, schema)
            out = part if out is None else out.unionByName(part)
            block = []
        block.append(s)
    return out


def _fit_block(train: DataFrame, key: str, id_col: str, sets: list, reg: float, max_rounds: int, schema: str) -> DataFrame:
    """The sets' fits as one Newton run over their inputs side by side: the systems do not touch, so the run is each set's own."""
    spark = train.sparkSession
    first = dict(zip([s for s, _, _ in sets], np.concatenate(([0], np.cumsum([n for _, n, _ in sets]))).tolist()))
    inputs = sum(n for _, n, _ in sets)
    total = np.concatenate([np.full(n, w) for _, n, w in sets])
    free = np.array(list(first.values()))
    own = train.where(F.col(key).isin(list(first)))

    def parse(b: pa.RecordBatch):
        row, e = _entries(b.column(b.schema.get_field_index("__x")))
        start = np.array([first[s] for s in b.column(b.schema.get_field_index(key)).to_pylist()], np.int64)
        x = Rows(np.concatenate((np.arange(b.num_rows), row)), np.concatenate((start, start[row] + e.field("i").to_numpy(zero_copy_only=False))),
                 np.concatenate((np.ones(b.num_rows), e.field("v").to_numpy(zero_copy_only=False))), b.num_rows)
        return x, b.column(b.schema.get_field_index("__y")).to_numpy(), b.column(b.schema.get_field_index("__w")).to_numpy()

    def summed(part, columns: int, *vectors: np.ndarray) -> np.ndarray:
        """Sums over all rows of ``part(x, y, w, *vectors)``: tasks add up theirs, then the sums meet per input."""
        shared = spark.sparkContext.broadcast(vectors)

        def run(batches):
            acc = np.zeros((columns, inputs))
            for b in batches:
                if b.num_rows:
                    acc += part(*parse(b), *shared.value)
            at = np.flatnonzero(acc.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(a[at]) for a in acc]], names=["i", *[f"s{c}" for c in range(columns)]])

        sums = own.mapInArrow(run, "i long, " + ", ".join(f"s{c} double" for c in range(columns)))
        sums = sums.groupBy("i").agg(*[F.sum(f"s{c}").alias(f"s{c}") for c in range(columns)])
        out = np.zeros((columns, inputs))
        for r in sums.toLocalIterator():
            out[:, r["i"]] = [r[f"s{c}"] for c in range(columns)]
        shared.destroy()
        return out

    ridge = np.full(inputs, reg)
    ridge[free] = 0.0
    b = np.zeros(inputs)
    for _ in range(max_rounds):
        g, square = summed(lambda x, y, w, b: np.stack(_terms(x, y, w, b, inputs)), 2, b)
        times = lambda d, b=b: summed(lambda x, y, w, b, d: _hessian_times(x, w, b, d, inputs)[None], 1, b, d)[0] / total + (ridge + 1e-12) * d
        step = conjugate_gradient(times, square / total + ridge + 1e-12, g / total + ridge * b, tol=1e-9)
        b = b - step
        if np.abs(step).max() < 1e-7:
            break
    final = spark.sparkContext.broadcast(b)

    def predict(batches):
        for batch in batches:
            if batch.num_rows:
                x, y, _ = parse(batch)
                p = pa.array(_sigmoid(x.times(final.value)))
                item = pa.array(np.flatnonzero(y == 0.0))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(item), batch.column(1).take(item), p.take(item)], names=batch.schema.names[:2] + ["glm_probability"])

    return own.mapInArrow(predict, schema)
