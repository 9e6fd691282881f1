"""Projections, filters and cleaning (C1–C17). All narrow transformations except the
imputation statistics, which are single aggregates joined back per set."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedrank.functions import exprs as X
from seedrank.functions.params import MAX_BROADCAST_BYTES, attach

# Fixed values that must equal the reference's behaviour.
# Columns the cleaner removes when present.
UNUSED_COLUMNS = ["Added At", "Added By", "Key", "Mode", "Time Signature"]
# Base of the item link.
ITEM_LINK_BASE = "https://open.spotify.com/track/"
# Placeholder for a category value not seen in the seed set.
UNSEEN = "????"
# Our own bound: values of a set that travel as one dictionary row.
WIDE_SET = 65_536


def drop_self_titled(df: DataFrame, name: str, owner: str) -> DataFrame:
    """Drop rows whose name equals the owner; a missing side keeps the row."""
    return df.filter(X.null_safe_ne(name, owner))


def extract_year_text(df: DataFrame, date_col: str) -> DataFrame:
    """Rewrite ``date_col`` to its 4-digit year text."""
    return df.withColumn(date_col, X.extract_year_text(date_col))


def with_release_year(df: DataFrame, date_col: str, out: str = "release_year") -> DataFrame:
    """Integer release year."""
    return df.withColumn(out, X.release_year(date_col))


def drop_unused(df: DataFrame, cols: Iterable[str] = UNUSED_COLUMNS) -> DataFrame:
    """C4: drop the listed columns that exist (absent ones are ignored)."""
    return df.drop(*[c for c in cols if c in df.columns])


def clean_items(df: DataFrame, name: str, owner: str, date_col: str | None,
                unused: Iterable[str] = UNUSED_COLUMNS) -> DataFrame:
    """C1 + C2 + C4 as the reference's cleaner applies them."""
    if name in df.columns and owner in df.columns:
        df = drop_self_titled(df, name, owner)
    if date_col and date_col in df.columns:
        df = extract_year_text(df, date_col)
    return drop_unused(df, unused)


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Non-numeric text → NULL double."""
    return df.select(*[F.col(c).try_cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


MEDIAN_ACCURACY = 100_000   # rank error of the approximate bounds: at most n / accuracy


def exact_medians(pool: DataFrame, cols: Sequence[str], key: str = "set_id", prefix: str = "__med_",
                  accuracy: int = MEDIAN_ACCURACY) -> DataFrame:
    """(key, ``<prefix><col>`` ...): exact (interpolated, as ``quantile_cont``) medians of every column per
    ``key`` in three scans, however many columns, without holding a group's values in one task.

    The first scan takes approximate bounds just below and above each median rank (``percentile_approx``, rank error
    ≤ n / accuracy), the second counts the values under and up to the bounds, the third keeps only the
    (column, value) pairs inside the bands (at most ~4·n/accuracy + 2 distinct per group and column) and ranks them.
    A column whose band misses a median rank (only possible when the approximation is loose, i.e. tiny
    groups) is ranked over its whole range instead."""
    from pyspark.sql import Window

    eps, n = 2.0 / accuracy, range(len(cols))
    ends = F.array(F.lit(max(0.0, 0.5 - eps)), F.lit(min(1.0, 0.5 + eps)))
    first = pool.groupBy(key).agg(*[F.struct(F.count(c).alias("n"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
                                             F.percentile_approx(F.col(c).cast("double"), ends, accuracy).alias("b")).alias(f"__s{i}") for i, c in enumerate(cols)])
    first = first.select(key, *[F.struct(
        F.floor((F.col(f"__s{i}.n") - 1) / 2).cast("long").alias("r1"), F.ceil((F.col(f"__s{i}.n") - 1) / 2).cast("long").alias("r2"),
        F.col(f"__s{i}.b")[0].alias("lo"), F.col(f"__s{i}.b")[1].alias("hi"), F.col(f"__s{i}.min").alias("min"), F.col(f"__s{i}.max").alias("max")).alias(f"__s{i}") for i in n])
    counts = attach(pool.select(key, *cols), first, key).groupBy(key).agg(*[x for i, c in enumerate(cols) for x in (
        F.count_if(F.col(c) < F.col(f"__s{i}.lo")).alias(f"__below{i}"), F.count_if(F.col(c) <= F.col(f"__s{i}.hi")).alias(f"__upto{i}"))])

    def band(i):
        s, below = (lambda f: F.col(f"__s{i}.{f}")), F.col(f"__below{i}")
        ok = (below <= s("r1")) & (F.col(f"__upto{i}") > s("r2"))
        return F.struct(F.lit(i).alias("c"), F.when(ok, s("lo")).otherwise(s("min")).alias("lo"), F.when(ok, s("hi")).otherwise(s("max")).alias("hi"),
                        F.when(ok, below).otherwise(F.lit(0)).cast("long").alias("below"), s("r1").alias("r1"), s("r2").alias("r2"))

    bands = attach(first, counts, key).select(key, F.array(*[band(i) for i in n]).alias("__bands"))
    values = F.array(*[F.col(c).cast("double") for c in cols])
    inside = F.filter(F.zip_with("__bands", values, lambda b, x: F.struct(b.alias("b"), x.alias("x"))),
                      lambda e: (e["x"] >= e["b"]["lo"]) & (e["x"] <= e["b"]["hi"]))
    near = (attach(pool.select(key, *cols), bands, key).select(key, F.explode(inside).alias("e"))
            .select(key, "e.b.c", "e.b.below", "e.b.r1", "e.b.r2", "e.x")
            .groupBy(key, "c", "below", "r1", "r2", "x").agg(F.count(F.lit(1)).alias("m")))
    w = Window.partitionBy(key, "c").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = near.withColumn("end", F.col("below") + F.sum("m").over(w))  # ranks [end - m, end)
    at = lambda r: F.when((F.col(r) >= F.col("end") - F.col("m")) & (F.col(r) < F.col("end")), F.col("x"))
    both = near.select(key, "c", at("r1").alias("a"), at("r2").alias("z"))
    got = both.groupBy(key).agg(*[F.max(F.when(F.col("c") == i, F.col(v))).alias(f"__{v}{i}") for i in n for v in ("a", "z")])
    return got.select(key, *[(F.col(f"__a{i}") + (F.col(f"__z{i}") - F.col(f"__a{i}")) * 0.5).alias(f"{prefix}{c}") for i, c in enumerate(cols)])


def exact_median(pool: DataFrame, col: str, key: str = "set_id", out: str = "median", accuracy: int = MEDIAN_ACCURACY) -> DataFrame:
    """``exact_medians`` of one column."""
    return exact_medians(pool, [col], key, "__med_", accuracy).withColumnRenamed(f"__med_{col}", out)


def impute_median(df: DataFrame, others: DataFrame | None, cols: Sequence[str], key: str = "set_id") -> DataFrame:
    """Fill NULLs with the exact (interpolated) median over ``df`` ∪ ``others`` per set
    (``exact_medians``: one search for all columns, bounded memory per group)."""
    pool = df.select(key, *cols)
    if others is not None:
        pool = pool.unionByName(others.select(key, *cols))
    out = attach(df, exact_medians(pool, cols, key), key, how="left")
    return out.select(*[F.coalesce(F.col(c), F.col(f"__med_{c}")).alias(c) if c in cols else F.col(c)
                        for c in df.columns])


def impute_mean(df: DataFrame, cols: Sequence[str], key: str = "set_id") -> DataFrame:
    """Fill NULLs with the per-set column mean of ``df``."""
    means = df.groupBy(key).agg(*[F.avg(c).alias(f"__avg_{c}") for c in cols])
    out = attach(df, means, key)
    return out.select(*[F.coalesce(F.col(c), F.col(f"__avg_{c}")).alias(c) if c in cols else F.col(c)
                        for c in df.columns])


def impute_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """C8."""
    return df.na.fill(0.0, subset=list(cols))


def impute_unknown(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Categorical NULL → 'Unknown' (values are made text first, as the reference does)."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("Unknown")).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """C10."""
    return df.dropna(subset=list(cols))


def common_columns(a: DataFrame, b: DataFrame, wanted: Sequence[str]) -> list[str]:
    """C11: wanted columns present in both schemas, in ``wanted`` order (no job)."""
    return [c for c in wanted if c in a.columns and c in b.columns]


def exclude_by_tags(df: DataFrame, tag_col: str, tags: Sequence[str]) -> DataFrame:
    """Drop rows whose ','-split (untrimmed) tag list contains a listed tag; NULL keeps."""
    hit = F.arrays_overlap(F.split(F.col(tag_col), ","), F.array(*[F.lit(t) for t in tags]))
    return df.filter(F.col(tag_col).isNull() | ~F.coalesce(hit, F.lit(False)))


def exclude_by_value(df: DataFrame, col: str, values: DataFrame | Sequence[str], value_col: str = "value") -> DataFrame:
    """Drop rows whose ``col`` is in ``values`` (a list or a one-column frame); NULL keeps."""
    if isinstance(values, DataFrame):
        vals = values.select(F.col(value_col).alias("__v")).distinct()
        return df.join(vals, F.col(col) == F.col("__v"), "left_anti")
    return df.filter(F.col(col).isNull() | ~F.col(col).isin(list(values)))


def threshold_filter(df: DataFrame, score: str, t: float = 0.60) -> DataFrame:
    """C14: keep score ≥ t."""
    return df.filter(F.col(score) >= F.lit(t))


def seen_values(seeds: DataFrame, cols: Sequence[str], key: str = "set_id") -> DataFrame:
    """(key, __e): the distinct values of every column among a set's seeds, as ``<column number>=<value>``."""
    entry = F.array(*[F.concat(F.lit(f"{i}="), F.col(c).cast("string")) for i, c in enumerate(cols)])
    return seeds.select(key, F.explode(entry).alias("__e")).where(F.col("__e").isNotNull()).distinct()


def with_seen_flags(items: DataFrame, seeds: DataFrame, cols: Sequence[str], key: str = "set_id", suffix: str = "_in_seeds",
                    wide: int = WIDE_SET) -> DataFrame:
    """``<col><suffix>`` = 1 when the item's value occurs among its set's seeds, else 0.

    A set's values of all columns travel as one dictionary row, dealt by hash into as many lists as it has
    values (a probe reads one list), so all columns take one join. Where some set has more than ``wide`` values (a
    dictionary row would grow without bound) each column meets the distinct (set, value) pairs by an equi-join."""
    if not cols:
        return items
    entries = seen_values(seeds, cols, key)
    size = entries.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("__e")).alias("b")).agg(F.max("n"), F.sum("b"), F.count(F.lit(1))).first()
    if (size[0] or 0) > wide:
        for c in cols:
            seen = seeds.select(F.col(key).alias("__k"), F.col(c).alias("__v")).distinct().withColumn("__hit", F.lit(1))
            items = (items.join(seen, (items[key] == seen["__k"]) & (items[c] == seen["__v"]), "left")
                     .drop("__k", "__v").withColumn(f"{c}{suffix}", F.coalesce(F.col("__hit"), F.lit(0))).drop("__hit"))
        return items
    entries = entries.join(entries.groupBy(key).agg(F.count(F.lit(1)).alias("__n")), key)
    lists = entries.withColumn("__b", F.pmod(F.xxhash64("__e"), F.col("__n")).cast("int"))

    def pack(pdf):
        out = [[] for _ in range(int(pdf["__n"].iloc[0]))]
        for b, e in zip(pdf["__b"], pdf["__e"]):
            out[b].append(e)
        return pd.DataFrame({key: pdf[key].iloc[:1], "__seen": [out]})

    packed = lists.groupBy(key).applyInPandas(pack, f"{key} {dict(seeds.dtypes)[key]}, __seen array<array<string>>")
    # entries, list headers and row headers as they lie in memory
    packed = F.broadcast(packed) if (size[1] or 0) * 2 + 64 * (size[0] or 0) * size[2] <= MAX_BROADCAST_BYTES else packed
    j = items.join(packed, key, "left")

    def flag(i, c):
        e = F.concat(F.lit(f"{i}="), F.col(c).cast("string"))
        own = F.get("__seen", F.pmod(F.xxhash64(e), F.size("__seen")).cast("int"))
        return F.coalesce(F.array_contains(own, e).cast("int"), F.lit(0)).alias(f"{c}{suffix}")

    return j.select(*items.columns, *[flag(i, c) for i, c in enumerate(cols)])


def mask_unseen(items: DataFrame, seeds: DataFrame, cols: Sequence[str], key: str = "set_id") -> DataFrame:
    """Replace a category value the item's seed set never uses with '????' (``with_seen_flags``)."""
    flagged = with_seen_flags(items, seeds, cols, key, "__seen_flag")
    return flagged.select(*[F.when(F.col(f"{c}__seen_flag") == 1, F.col(c)).otherwise(F.lit(UNSEEN)).alias(c) if c in cols else F.col(c)
                            for c in items.columns])


def item_link(df: DataFrame, id_col: str, out: str = "link", base: str = ITEM_LINK_BASE) -> DataFrame:
    """C17: link for rows with an id; rows without one are skipped."""
    return df.filter(F.col(id_col).isNotNull()).withColumn(out, F.concat(F.lit(base), F.col(id_col).cast("string")))


def format_scores(df: DataFrame) -> DataFrame:
    """Every column with 'score' in its name → '12.3%' text (one decimal, half-even as
    Python's round does on the stored double)."""
    return df.select(*[
        F.concat(F.format_string("%.1f", F.bround(F.col(c), 1)), F.lit("%")).alias(c)
        if "score" in c.lower() else F.col(c)
        for c in df.columns
    ])
