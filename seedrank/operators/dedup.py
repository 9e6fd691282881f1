"""De-duplication and set operations.

"Keep the first row of each key" is a ``min`` over a struct whose first field is the tie-break, with
map-side partial aggregation: a key that holds a third of all rows is reduced inside each task before the shuffle (a
``row_number`` window would pull that whole key into one task). A struct is no value that a hash aggregate can
update in place, so this sorts: by key in each task, and the reduced rows again after the shuffle. ``dedup_by_key``
therefore sends only rows through it that can be first, or only those of repeated keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seedrank.functions.params import ARRAY_HEAD_BYTES, MAX_BROADCAST_BYTES, row_bytes


def track_key(name: str, owner: str, trim: bool = True) -> Column:
    """lower(trim(name)) | lower(trim(owner)); D1 trims, J1/J3 do not."""
    n, o = F.col(name), F.col(owner)
    if trim:
        n, o = F.trim(n), F.trim(o)
    return F.concat(F.lower(n), F.lit("|"), F.lower(o))


def keep_first(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[str]) -> DataFrame:
    """Keep one row per key: the one with the smallest ``order_by`` tuple (NULL keys form
    one group, as in pandas). Implemented as min(struct) per key."""
    key_cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    key_names = [f"__k{i}" for i in range(len(key_cols))]
    rest = [c for c in df.columns]
    # every column once: the row is what is sorted and shuffled
    packed = F.struct(*[F.col(c) for c in dict.fromkeys([*order_by, *rest])]).alias("__row")
    agg = (df.select(*[k.alias(n) for k, n in zip(key_cols, key_names)], packed)
           .groupBy(*key_names).agg(F.min("__row").alias("__row")))
    return agg.select(*[F.col(f"__row.{c}").alias(c) for c in rest])


def order_bound(df: DataFrame, col: str) -> Column:
    """A number, never NULL, that no row has below that of a row before it in the order of ``col`` (NULLs first): the value itself, of a text
    its first seven bytes. Rows of different values may share it. Types without one get 0."""
    c, t = F.col(col), df.schema[col].dataType
    if t == T.StringType():
        return F.coalesce(F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long"), F.lit(-1).cast("long"))
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return F.coalesce(c.cast("double"), F.lit(float("-inf")))
    number = c if isinstance(t, T.IntegralType) else F.unix_date(c) if t == T.DateType() else F.unix_micros(c) if t == T.TimestampType() else F.lit(0)
    return F.coalesce(number.cast("long"), F.lit(-(1 << 63)).cast("long"))


def dedup_by_key(df: DataFrame, name: str, owner: str, order_by: Sequence[str], key: str = "set_id",
                 max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """One row per (set, lower(trim(name))|lower(trim(owner))), first by ``order_by``.

    The keys and the longest of them are counted in one scan. Where all keys fit into a broadcast (a catalogue that lists its tracks many
    times), a hash aggregate, reduced in each task, gives the least ``order_bound`` of every key, and rows above it, which cannot be
    first, are left out where they lie: only the few others are reduced whole, and no row is shuffled to find them.

    With more keys than that most of them occur once, and their rows need no comparing: an aggregate over the keys' 64-bit hashes
    alone finds the hashes that occur more than once, and only rows of those hashes are reduced
    whole. The other rows are neither sorted nor, where the repeated hashes are few enough to be broadcast, shuffled. A hash
    that two keys share sends both through the exact reduction."""
    track = track_key(name, owner, trim=True)
    own = df.withColumn("__h", F.xxhash64(F.col(key), track))
    size = own.agg(F.approx_count_distinct("__h").alias("n"), F.max(F.octet_length(track)).alias("longest")).first()
    if size["n"] * (2 * ARRAY_HEAD_BYTES + row_bytes(df.schema[key].dataType) + (size["longest"] or 0)) <= max_bytes:
        own = df.withColumns({"__t": track, "__b": order_bound(df, order_by[0])})
        least = own.groupBy(F.col(key).alias("__lk"), F.col("__t").alias("__lt")).agg(F.min("__b").alias("__least"))
        ahead = own.join(F.broadcast(least), F.col(key).eqNullSafe(F.col("__lk")) & F.col("__t").eqNullSafe(F.col("__lt")) & (F.col("__b") <= F.col("__least")), "left_semi")
        return keep_first(ahead.select(*df.columns), [key, track], order_by)
    repeated = own.groupBy("__h").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1).select("__h")
    once = own.join(repeated, "__h", "left_anti").select(*df.columns)
    more = own.join(repeated, "__h", "left_semi").select(*df.columns)
    return once.unionByName(keep_first(more, [key, track], order_by))


def distinct_rows(df: DataFrame) -> DataFrame:
    """D2."""
    return df.distinct()


def duplicate_count(df: DataFrame, name: str, owner: str, key: str = "set_id") -> DataFrame:
    """D3: rows minus distinct keys, per set."""
    return df.groupBy(key).agg(
        (F.count(F.lit(1)) - F.count_distinct(F.coalesce(track_key(name, owner), F.lit("\u0000null")))).alias("duplicates"),
        F.count(F.lit(1)).alias("rows"),
    )


def union_seed_items(seeds: DataFrame, items: DataFrame, cols: Sequence[str], label: str = "label") -> DataFrame:
    """Stack seeds (label 1) and items (label 0) by column name."""
    return (seeds.select(*cols).withColumn(label, F.lit(1))
            .unionByName(items.select(*cols).withColumn(label, F.lit(0))))


def distinct_values(df: DataFrame, col: str, split: str | None = ",") -> DataFrame:
    """Sorted distinct (trimmed) values of a column, split into a list first if asked."""
    v = df.select(F.explode(F.split(F.col(col), split)).alias("__v")) if split else df.select(F.col(col).alias("__v"))
    return v.select(F.trim("__v").alias("value")).where(F.col("value").isNotNull()).distinct().orderBy("value")


def upsample(df: DataFrame, n: int = 5, weight_col: str | None = "weight") -> DataFrame:
    """The seeds repeated ``n`` times. With ``weight_col`` a weight column is added instead
    (same likelihood for a weighted fit, no copies); with ``None`` rows are really repeated."""
    if weight_col:
        return df.withColumn(weight_col, F.lit(float(n)))
    return df.withColumn("__rep", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("__rep")
