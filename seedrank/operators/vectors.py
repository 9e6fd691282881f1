"""Vectors, scaling, similarity.

Statistics are per ``set_id`` aggregates (map-side partial aggregation), joined back through
``attach`` (size-checked broadcast). No un-partitioned window is ever used: a global min/max
would otherwise pull every row into one task."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedrank.functions import exprs as X
from seedrank.functions.params import attach, bounded_broadcast


def parse_vector(df: DataFrame, col: str, dim: int, out: str | None = None) -> DataFrame:
    """V1."""
    return df.withColumn(out or col, X.parse_vector(col, dim))


def split_tags(df: DataFrame, col: str, out: str = "tags") -> DataFrame:
    """V2."""
    return df.withColumn(out, X.split_tags(col))


#: sums that fit into one generated aggregate (Spark generates code up to 100 fields)
SUMS_AT_ONCE = 90


def mean_pool(pairs: DataFrame, id_cols: Sequence[str], vec: str, dim: int, out: str = "vec") -> DataFrame:
    """V3: element-wise mean of the vectors of each id (a repeated tag counts twice; a NULL vector does not
    count, and an id with none but NULL vectors gets NULL entries). For many small groups: ``dim`` sums and one count are one
    aggregate with generated code, where as many averages are not; a wider vector takes a buffer per group
    (``array_sums``)."""
    if dim > SUMS_AT_ONCE:
        agg = array_sums(pairs.select(*id_cols, vec, F.coalesce(F.col(vec), X.zeros(dim)).alias("__v")), id_cols, "__v", dim, "__s", {"__n": F.count(vec)})
        sums = F.col("__s")
    else:
        agg = pairs.groupBy(*id_cols).agg(F.count(vec).alias("__n"), *[F.sum(F.col(vec)[i].cast("double")).alias(f"__d{i}") for i in range(dim)])
        sums = F.array(*[F.col(f"__d{i}") for i in range(dim)])
    return agg.select(*id_cols, F.transform(sums, lambda v: F.when(F.col("__n") > 0, v / F.col("__n"))).alias(out))


#: our own bounds: bytes of vectors that every Python worker may hold, and beyond which only vectors that rows name are looked at
MAX_SHARED_BYTES, PLAIN_SHARED_BYTES = 256 << 20, 64 << 20
#: members that are added up at once
MEMBERS_AT_ONCE = 65_536


class Vectors:
    """Vectors by number: sorted ``keys``, per key the sums of its vectors (NULL entries as 0), how many they are, and how many entries
    of each dimension are not NULL (None: all)."""

    def __init__(self, keys: np.ndarray, lists: pa.ListArray, dim: int):
        known = lists.is_valid().to_numpy(zero_copy_only=False)
        start, end = (np.asarray(lists.offsets)[i:len(lists) + i] for i in (0, 1))
        size = (end - start)[known]
        width = min(dim, int(size.min())) if len(size) else dim
        if len(size) and width < dim and size.max() != width:
            raise ValueError(f"vectors of {width} and {size.max()} entries")
        place = np.where(known, start, 0)[:, None] + np.arange(width)
        flat = lists.values
        number = np.float32 if pa.types.is_float32(flat.type) else float
        entry = pc.fill_null(flat, 0).to_numpy(zero_copy_only=False).astype(number, copy=False)
        value = entry[place] if len(size) else np.zeros((len(keys), width), number)
        value[~known] = 0
        valid = flat.is_valid().to_numpy(zero_copy_only=False)[place] & known[:, None] if flat.null_count else None
        order = np.argsort(keys, kind="stable")
        keys, value, known = keys[order], value[order], known[order].astype(np.int64)
        valid = None if valid is None else valid[order].astype(np.int64)
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        if len(first) < len(keys):  # a number of several vectors stands for all of them
            value, known, valid = (None if a is None else np.add.reduceat(a, first, axis=0, dtype=kind) for a, kind in ((value, float), (known, None), (valid, None)))
        self.keys, self.value, self.count, self.valid = keys[first], value, known, valid

    def add_up(self, group: np.ndarray, members: np.ndarray, groups: int):
        """(sums, members found, their vectors, their entries or None) of ``groups`` groups; ``group`` is that of every member, in order."""
        width = self.value.shape[1]
        sums, hits, count = np.zeros((groups, width)), np.zeros(groups, np.int64), np.zeros(groups, np.int64)
        valid = None if self.valid is None else np.zeros((groups, width), np.int64)
        for lo in range(0, len(members) if len(self.keys) else 0, MEMBERS_AT_ONCE):
            own, g = members[lo:lo + MEMBERS_AT_ONCE], group[lo:lo + MEMBERS_AT_ONCE]
            at = np.minimum(np.searchsorted(self.keys, own), len(self.keys) - 1)
            found = self.keys[at] == own
            at, g = at[found], g[found]
            if len(g):
                first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
                to = g[first]
                sums[to] += np.add.reduceat(self.value[at], first, axis=0, dtype=float)
                hits[to] += np.diff(np.r_[first, len(g)])
                count[to] += np.add.reduceat(self.count[at], first)
                if valid is not None:
                    valid[to] += np.add.reduceat(self.valid[at], first, axis=0)
        return sums, hits, count, valid


def mean_lists(sums: np.ndarray, hits: np.ndarray, count: np.ndarray, valid: np.ndarray | None, by_entry: bool) -> pa.ListArray:
    """The groups' means as a column, NULL where no member was found. NULL entries are left out (``by_entry``: of the number that sums
    are divided by, too); an entry without a value is NULL."""
    per = np.broadcast_to(count[:, None], sums.shape) if valid is None or not by_entry else valid
    none = (per == 0) if valid is None else (per == 0) | (valid == 0)
    mean = sums / np.maximum(per, 1)
    flat = pa.array(mean.ravel(), mask=none.ravel()) if none.any() else pa.array(mean.ravel())
    offsets = pa.array(np.arange(0, mean.size + 1, max(mean.shape[1], 1), dtype=np.int32) if mean.size else np.zeros(len(sums) + 1, np.int32))
    return pa.ListArray.from_arrays(offsets, flat, mask=pa.array(hits == 0))


def shared_vectors(vectors: DataFrame, ref: str, vec: str, dim: int, named: DataFrame | None = None, max_bytes: int | None = None):
    """The rows of a written table (``ref`` a whole number, ``vec`` of ``dim`` entries) as ``Vectors``, in the memory of every Python
    worker that pools with them, or None if they are more than ``max_bytes``. Of more than ``PLAIN_SHARED_BYTES`` only
    those are kept that ``named`` (a column of numbers) names. No row meets its vector in a shuffle so."""
    max_bytes = MAX_SHARED_BYTES if max_bytes is None else max_bytes
    own = vectors.where(F.col(ref).isNotNull()).select(F.col(ref).cast("long").alias("ref"), F.col(vec).alias("vec"))
    size = own.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("width")).first()
    kind = own.schema["vec"].dataType.elementType.simpleString()
    if kind not in ("float", "double"):
        own = own.withColumn("vec", F.transform("vec", lambda v: v.cast("double")))
    row = max(size["width"] or 0, 0) * (4 if kind == "float" else 8) + 16
    n = size["n"]
    if named is not None and n * row > PLAIN_SHARED_BYTES:
        own = own.join(named.toDF("ref").distinct(), "ref", "left_semi")
        n = own.count()
    if n * row > max_bytes:
        return None
    table = own.toArrow()
    lists = table.column("vec").combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else pa.concat_arrays(lists.chunks)
    return vectors.sparkSession.sparkContext.broadcast(Vectors(table.column("ref").to_numpy().astype(np.int64), lists, dim))


def pooled_lists(df: DataFrame, refs: str, shared, out: str = "vec") -> DataFrame:
    """V3 row by row: ``out`` in the place of ``refs`` (array<bigint>), the mean of the vectors that it names (a repeated number counts
    each time, NULL entries do not count; none found: NULL)."""
    at = df.columns.index(refs)
    kinds = dict(df.dtypes)
    names = [out if c == refs else c for c in df.columns]

    def run(batches):
        vectors = shared.value
        for b in batches:
            lists = b.column(at)
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            members = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
            vec = mean_lists(*vectors.add_up(np.repeat(np.arange(len(sizes)), sizes), members, len(sizes)), by_entry=True)
            yield pa.RecordBatch.from_arrays([vec if i == at else b.column(i) for i in range(b.num_columns)], names=names)

    return df.mapInArrow(run, ", ".join(f"`{n}` {'array<double>' if c == refs else kinds[c]}" for n, c in zip(names, df.columns)))


def _changes(column) -> np.ndarray:
    """Whether a value differs from the one before it (NULLs are alike)."""
    a, b = column.slice(1), column.slice(0, len(column) - 1)
    other = pc.fill_null(pc.not_equal(a, b), False)
    if pa.types.is_floating(column.type):
        other = pc.and_not(other, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
    return pc.or_(other, pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)


def pooled_rows(pairs: DataFrame, id_cols: Sequence[str], ref: str, shared, out: str = "vec", by_entry: bool = False) -> DataFrame:
    """V3 of rows (ids, ``ref`` bigint) that lie in one task by their ids: (ids, ``out``), the mean of the vectors that an id's rows name.
    The rows are sorted where they lie and added up as they come, so a task holds one id's sums, however many rows it has."""
    ids, kinds = list(id_cols), dict(pairs.dtypes)
    k = len(ids)

    def run(batches):
        vectors, held, sums = shared.value, None, None

        def rows(columns, parts):
            vec = mean_lists(*parts, by_entry=by_entry)
            keep = pa.array(parts[1] > 0)
            return pa.RecordBatch.from_arrays([*[c.filter(keep) for c in columns], vec.filter(keep)], names=[*ids, out])

        for b in batches:
            if not b.num_rows:
                continue
            columns = [b.column(i) if held is None else pa.concat_arrays([held[i], b.column(i)]) for i in range(k)]
            new = np.r_[False if held is None else True, np.logical_or.reduce([_changes(c) for c in columns])] if len(columns[0]) > 1 else np.zeros(1, bool)
            new[0] = True
            first, skip = np.flatnonzero(new), 0 if held is None else 1  # a held id is the first row
            group = np.cumsum(new)[skip:] - 1
            parts = vectors.add_up(group, b.column(k).to_numpy(zero_copy_only=False).astype(np.int64, copy=False), len(first))
            if held is not None:
                for a, h in zip(parts, sums):
                    if a is not None:
                        a[0] += h[0]
            starts = pa.array(first)
            found = [c.take(starts) for c in columns]
            if len(first) > 1:
                yield rows([c.slice(0, len(first) - 1) for c in found], [None if a is None else a[:-1] for a in parts])
            held, sums = [c.slice(len(first) - 1) for c in found], [None if a is None else a[-1:] for a in parts]
        if held is not None:
            yield rows(held, sums)

    ordered = pairs.where(F.col(ref).isNotNull()).select(*ids, F.col(ref).cast("long").alias(ref)).sortWithinPartitions(*ids)
    return ordered.mapInArrow(run, ", ".join([f"`{c}` {kinds[c]}" for c in ids] + [f"`{out}` array<double>"]))


def array_sums(df: DataFrame, keys: Sequence[str], col: str, dim: int, out: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """(keys, ``out``, extra): element-wise sums of an array<double> of ``dim`` entries (none NULL) per key, in one buffer a
    group whatever ``dim`` is; ``extra`` are further aggregates of the same pass."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    extra = extra or {}
    agg = df.groupBy(*keys).agg(Summarizer.metrics("sum").summary(array_to_vector(col)).alias("__sums"), *[c.alias(n) for n, c in extra.items()])
    return agg.select(*keys, vector_to_array("__sums.sum").alias(out), *extra)


def array_stats(df: DataFrame, keys: Sequence[str], col: str, dim: int) -> DataFrame:
    """(keys, __mean, __sd): element-wise mean and population deviation of an array<double> (no entry NULL), one buffer a group."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    agg = df.groupBy(*keys).agg(Summarizer.metrics("mean", "variance", "count").summary(array_to_vector(col)).alias("__s"))
    n = F.col("__s.count").cast("double")
    # the summary's variance is that of a sample
    return agg.select(*keys, vector_to_array("__s.mean").alias("__mean"),
                      F.transform(vector_to_array("__s.variance"), lambda v: F.sqrt(v * (n - 1) / n)).alias("__sd"))


def named_vectors(df: DataFrame, vectors: DataFrame, ref: str, vec: str) -> DataFrame:
    """``df`` with ``vec``, the vector of the row of ``vectors`` (``ref``, ``vec``; refs unique) that ``ref`` names, beside ``ref`` (none: NULL)."""
    v = bounded_broadcast(vectors.where(F.col(ref).isNotNull()).select(ref, vec))
    return df.join(v, ref, "left").select(*[x for c in df.columns for x in ((vec, c) if c == ref else (c,))])


def expand_vector(df: DataFrame, col: str, dim: int, prefix: str = "genre_dim_", drop: bool = True) -> DataFrame:
    """V5: array → ``prefix0..prefix{dim-1}`` double columns."""
    out = df.select("*", *[F.col(col)[i].cast("double").alias(f"{prefix}{i}") for i in range(dim)])
    return out.drop(col) if drop else out


def centroid(seeds: DataFrame, features: Sequence[str], key: str = "set_id", prefix: str = "c_") -> DataFrame:
    """V6: per-set column means of the seed rows."""
    return seeds.groupBy(key).agg(*[F.avg(f).alias(f"{prefix}{f}") for f in features])


def scaler_stats(fit_rows: DataFrame, features: Sequence[str], key: str = "set_id") -> DataFrame:
    """V7 fit: per-set mean and *population* std (what the reference's scaler uses)."""
    aggs = []
    for f in features:
        aggs += [F.avg(f).alias(f"m_{f}"), F.stddev_pop(f).alias(f"s_{f}")]
    return fit_rows.groupBy(key).agg(*aggs)


def standardize(df: DataFrame, stats: DataFrame, features: Sequence[str], key: str = "set_id",
                prefix: str = "z_") -> DataFrame:
    """V7 transform: adds ``z_<feature>`` columns; zero std divides by 1."""
    j = attach(df, stats, key)
    z = [X.standardized(F.col(f), F.col(f"m_{f}"), F.col(f"s_{f}")).alias(f"{prefix}{f}") for f in features]
    return j.select(*df.columns, *z)


def cosine_to(df: DataFrame, target: DataFrame, features: Sequence[str], key: str = "set_id",
              out: str = "cosine", weights: Sequence[float] | None = None,
              a_prefix: str = "z_", b_prefix: str = "t_") -> DataFrame:
    """V8: cosine of each row's ``a_prefix`` vector to the set's ``b_prefix`` target vector."""
    j = attach(df, target, key)
    cos = X.cosine([F.col(f"{a_prefix}{f}") for f in features], [F.col(f"{b_prefix}{f}") for f in features], weights)
    return j.select(*df.columns, cos.alias(out))


def minmax_100(df: DataFrame, col: str, out: str, flat: str = "fifty", key: str = "set_id") -> DataFrame:
    """V9: per-set (x-min)/(max-min)*100 with the model's flat-range rule."""
    mm = df.groupBy(key).agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"))
    j = attach(df, mm, key)
    return j.select(*[c for c in df.columns if c != out],
                    X.minmax_100(F.col(col), F.col("__lo"), F.col("__hi"), flat).alias(out))


def rescale_if_needed(df: DataFrame, col: str | Sequence[str], key: str = "set_id") -> DataFrame:
    """Re-apply V9 to a score only when its per-set max > 100, min < 0 or range < 0.01
    (flat → 0). Several columns share one aggregate (one pass)."""
    cols = [col] if isinstance(col, str) else list(col)
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"__lo_{c}"), F.max(c).alias(f"__hi_{c}")]
    j = attach(df, df.groupBy(key).agg(*aggs), key)

    def fix(c):
        lo, hi, x = F.col(f"__lo_{c}"), F.col(f"__hi_{c}"), F.col(c)
        need = (hi > 100) | (lo < 0) | ((hi - lo) < 0.01)
        scaled = F.when(hi > lo, (x - lo) / (hi - lo) * F.lit(100.0)).otherwise(F.lit(0.0))
        return F.when(need, scaled).otherwise(x).alias(c)
    return j.select(*[fix(c) if c in cols else F.col(c) for c in df.columns])


def pca_fit(df: DataFrame, features: Sequence[str], key: str = "set_id", min_rows: int = 10, k: int = 2) -> DataFrame:
    """(key, mean, loadings, explained): ``k`` principal components of each set's complete rows, centred, not scaled;
    ``explained`` are their shares of the variance. One aggregate gathers a set's covariances, and the decomposition runs on
    that one row. The entry of largest size of a component is positive (of equal sizes the first). Sets of at
    most ``min_rows`` complete rows have no row."""
    p = len(features)
    rows = df.dropna(subset=list(features))
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    agg = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("__n"), F.array(*[F.avg(f).cast("double") for f in features]).alias("mean"),
        F.array(*[F.covar_pop(F.col(features[i]).cast("double"), F.col(features[j]).cast("double")) for i, j in pairs]).alias("cov")).where(F.col("__n") > min_rows)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        c = np.zeros((p, p))
        for (i, j), v in zip(pairs, pdf["cov"].iloc[0]):
            c[i, j] = c[j, i] = v
        value, vector = np.linalg.eigh(c)
        order = np.argsort(-value, kind="stable")[:k]
        load = vector[:, order]
        top = load[np.abs(load).round(12).argmax(axis=0), np.arange(load.shape[1])]
        load = load * np.where(top < 0, -1.0, 1.0)
        total = float(np.trace(c))
        return pd.DataFrame({key: pdf[key].iloc[:1], "mean": pdf["mean"].iloc[:1], "loadings": [load.T.tolist()],
                             "explained": [(value[order] / total if total > 0 else np.zeros(len(order))).tolist()]})

    kind = dict(df.dtypes)[key]
    return agg.groupBy(key).applyInPandas(solve, f"{key} {kind}, mean array<double>, loadings array<array<double>>, explained array<double>")


def pca_2d(df: DataFrame, features: Sequence[str], id_cols: Sequence[str], min_rows: int = 10, key: str = "set_id") -> DataFrame:
    """(ids..., pc1, pc2, explained1, explained2): every complete row on its set's two principal components
    (``pca_fit``). The catalogue view takes ``min_rows`` 10; the seed view fewer features and 5. Without a ``key`` column the
    frame is one set."""
    rows = df.dropna(subset=list(features))
    if key not in df.columns:
        rows, key = rows.withColumn("__set", F.lit(0)), "__set"
    j = attach(rows, pca_fit(rows, features, key, min_rows), key)

    def on(c):
        total = F.lit(0.0)
        for i, f in enumerate(features):
            total = total + (F.col(f) - F.col("mean")[i]) * F.col("loadings")[c][i]
        return total

    return j.select(*id_cols, on(0).alias("pc1"), on(1).alias("pc2"), F.col("explained")[0].alias("explained1"), F.col("explained")[1].alias("explained2"))


def embed_seeds(seeds: DataFrame, id_cols: Sequence[str], tags: str | None, vec: str, lookup: DataFrame | None,
                dim: int, recompute: str = "missing", key: str = "set_id") -> DataFrame:
    """V4: give every seed row a tag vector. Rows keep a vector they already have; the others
    get V2 → J5 → V3 from ``lookup`` (zeros when nothing is found). ``recompute='all'`` is
    the reference's rule: if any row of a set lacks a vector, every row of that set is recomputed
    (vectors copied from the catalogue are discarded); without a ``key`` column the frame is one set. No tag column or no lookup → zeros."""
    from seedrank.functions.exprs import split_tags, zeros
    from seedrank.operators.enrich import lookup_vectors
    has_vec = vec in seeds.columns
    if tags is None or tags not in seeds.columns or lookup is None:
        fill = F.coalesce(F.col(vec), zeros(dim)) if has_vec else zeros(dim)
        return seeds.withColumn(vec, fill)
    base = seeds if has_vec else seeds.withColumn(vec, F.lit(None).cast("array<double>"))
    looked = lookup_vectors(base.withColumn("__tl", split_tags(tags)), list(id_cols), "__tl", lookup, dim, out="__lv")
    if recompute == "all":
        looked = looked.withColumn("__j", F.col(key) if key in looked.columns else F.lit(1))
        flag = looked.groupBy(F.col("__j").alias("__k")).agg(F.bool_or(F.col(vec).isNull()).alias("__m"))
        j = looked.join(flag, F.col("__j").eqNullSafe(F.col("__k")))
        val = F.when(F.col("__m"), F.col("__lv")).otherwise(F.col(vec))
        return j.select(*[val.alias(c) if c == vec else F.col(c) for c in base.columns])
    return looked.select(*[F.coalesce(F.col(vec), F.col("__lv")).alias(c) if c == vec else F.col(c) for c in base.columns])
