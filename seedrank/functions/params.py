"""Per-set parameter frames and how they meet the item table.

Every model in the library reduces the item table to *parameters*: one row per ``set_id``
(centroids, means, population std, min/max of a score, era constants). Those frames are
joined back on ``set_id``. They are broadcast only where the number of sets has been counted on
the data at hand (``count_key_bound`` inside a ``bound_scope``) and that many rows of the frame's
schema stay under ``MAX_BROADCAST_BYTES``; otherwise the join carries no hint and AQE decides
from measured sizes (and splits a hot set). A bound ends with its scope, so no plan depends on
what ran before.
"""

from __future__ import annotations

import gc
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seedrank.session import ensure_checkpoint_dir

MAX_BROADCAST_BYTES = 64 << 20
# Assumed widths for the size check: a scalar, a text, and the entries of an array or map
# (the widest parameter is a 70-d vector; packed centres hold at most 10 of them).
SCALAR_BYTES, TEXT_BYTES, ARRAY_ITEMS = 16, 64, 128
ARRAY_HEAD_BYTES = 32

# counted distinct values per key column, for the query being built (None: no scope is open)
_BOUNDS: ContextVar[dict[str, int] | None] = ContextVar("bounds", default=None)
# tables written by ``materialize``, per application, for ``drop_written``
_WRITTEN: dict[str, list[str]] = {}


@contextmanager
def bound_scope():
    """Bounds declared inside hold until the block ends; an open scope is shared."""
    if _BOUNDS.get() is not None:
        yield
        return
    token = _BOUNDS.set({})
    try:
        yield
    finally:
        _BOUNDS.reset(token)


def count_key_bound(df: DataFrame, key: str = "set_id") -> int:
    """Count the distinct values of ``key`` (one column-pruned scan) and declare the bound."""
    n = df.select(key).distinct().count()
    declare_key_bound(key, n)
    return n


def declare_key_bound(key: str, n: int) -> None:
    """Declare a counted distinct-value bound of ``key`` for the open scope (without one: no effect)."""
    bounds = _BOUNDS.get()
    if bounds is not None:
        bounds[key] = max(n, bounds.get(key, 0))


def key_bound(key: str) -> int | None:
    return (_BOUNDS.get() or {}).get(key)


def row_bytes(dt: T.DataType) -> int:
    """Assumed bytes of one value of a type."""
    if isinstance(dt, T.StructType):
        return sum(row_bytes(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return ARRAY_ITEMS * row_bytes(dt.elementType)
    if isinstance(dt, T.MapType):
        return ARRAY_ITEMS * (row_bytes(dt.keyType) + row_bytes(dt.valueType))
    return TEXT_BYTES if isinstance(dt, (T.StringType, T.BinaryType)) else SCALAR_BYTES


def bounded_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` written once, broadcast-hinted if its rows stay under ``max_bytes``."""
    df = materialize(df, "bounded")
    n = df.count()  # read from the file footers
    return F.broadcast(df) if n * row_bytes(df.schema) <= max_bytes or n * measured_row_bytes(df) <= max_bytes else df


def measured_row_bytes(df: DataFrame) -> int:
    """Bytes of the widest row of a written table as Spark holds it: arrays of numbers by their longest, other values as assumed."""
    plain = {f.name: f.dataType.elementType for f in df.schema.fields
             if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, (T.NumericType, T.DateType, T.BooleanType))}
    rest = sum(row_bytes(f.dataType) for f in df.schema.fields if f.name not in plain)
    if not plain:
        return rest
    longest = df.agg(*[F.max(F.size(c)).alias(c) for c in plain]).first()
    wide = {T.FloatType(): 4, T.IntegerType(): 4, T.DateType(): 4, T.ShortType(): 2, T.ByteType(): 1, T.BooleanType(): 1}
    entry = lambda t: 32 if isinstance(t, T.DecimalType) else wide.get(t, 8)
    return rest + sum(ARRAY_HEAD_BYTES + max(longest[c] or 0, 0) * (entry(t) + 1) for c, t in plain.items())


def by_key(df: DataFrame) -> DataFrame:
    """``df`` for a join that shuffles both sides. Without the hint Spark judges a table by its compressed file size, some tens of
    times below its size in memory, and collects tables of millions of rows on the driver to broadcast them."""
    return df.hint("merge")


def attach(items: DataFrame, params: DataFrame, on: str | list[str] = "set_id", how: str = "inner",
           max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Join parameters onto items (J8): an equi-join on the set key, never a cross join.
    ``params`` must hold one row per value of ``on``."""
    keys = [on] if isinstance(on, str) else list(on)
    bound = key_bound(keys[0]) if len(keys) == 1 else None
    if bound is not None and bound * row_bytes(params.schema) <= max_bytes:
        params = F.broadcast(params)
    return items.join(params, on=on, how=how)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as parquet under the session's checkpoint folder and read it back.

    Cuts lineage (a lost executor re-reads files instead of recomputing joins) and gives the
    later passes a columnar, prunable input. The folder is the cluster's shared
    ``spark.checkpoint.dir``; a private one is only created when none is configured.
    ``drop_written`` removes the tables at the end of a run.
    """
    spark = df.sparkSession
    return spark.read.parquet(write_once(df, name))


def write_once(df: DataFrame, name: str) -> str:
    """The folder ``df`` was written to."""
    path = new_folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return path


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder name of its own in the shared folder, for ``drop_written`` to remove."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/seedrank-{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_table(spark: SparkSession, path: str) -> None:
    """Remove a written table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    if path in (own := _WRITTEN.get(spark.sparkContext.applicationId, [])):
        own.remove(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs that no frame refers to any more: it does so when the driver's objects for them
    are collected, which an idle driver puts off, while every round of a fit leaves its files on the executors' disks."""
    gc.collect()
    spark._jvm.System.gc()


def drop_written(spark: SparkSession) -> int:
    """Remove every table this application wrote (call it when its results have been read)."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)
