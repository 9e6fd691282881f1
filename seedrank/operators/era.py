"""Era (release-time) adjustment.

The seed set's year statistics are one row per set (``era_params``); every item-level value
is a column expression over that row, joined on ``set_id``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedrank.functions.exprs import clip
from seedrank.functions.params import attach

# Fixed values that must equal the reference's behaviour.
# Era classes with (max distance in years, max penalty in %).
ERA_PENALTY = {"decade": (10, 40.0), "recent": (20, 25.0), "tight": (15, 30.0), "standard": (25, 20.0)}
RECENT_FROM_YEAR = 2019        # mean seed year from which a set counts as recent
DECADE_SHARE = 0.8             # share of dated seeds in one decade for a decade set
TIGHT_STD = 5                  # sample std (years) below which a set is tight
RECENT_BONUS = (2019, 15.0)    # recent sets: bonus from this year, up to this %
MILD_BONUS = (2022, 5.0)       # other sets: bonus from this year, up to this %
CURRENT_YEAR = 2025            # the reference fixes "now" at 2025
ADJ_MIN = -10.0                # bonus cap
# Adjustment histogram edges (left-closed) and the labels as the reference assigns them.
ADJ_EDGES = [-10, -5, 0, 5, 10, 20, 30, 40]
ADJ_LABELS = ["Bonus 5-10%", "Bonus 0-5%", "No adj.", "0-5%", "5-10%", "10-20%", "20-30%"]


def seed_year_stats(seeds: DataFrame, year: str = "release_year", key: str = "set_id") -> DataFrame:
    """A3 + A4 per set: int-truncated mean, min, max, range, sample std, dated count, and the
    focus decade (a decade holding ≥ 80 % of dated seeds), if any."""
    dated = seeds.select(key, F.col(year).alias("__y")).where(F.col("__y").isNotNull())
    base = dated.groupBy(key).agg(
        F.avg("__y").cast("int").alias("avg_year"),
        F.min("__y").alias("min_year"),
        F.max("__y").alias("max_year"),
        F.stddev_samp("__y").alias("std_year"),
        F.count(F.lit(1)).alias("n_dated"),
    ).withColumn("year_range", F.col("max_year") - F.col("min_year"))
    dec = (dated.groupBy(key, (F.floor(F.col("__y") / 10) * 10).cast("int").alias("decade"))
           .agg(F.count(F.lit(1)).alias("__n")))
    focus = (dec.join(base.select(key, "n_dated"), key)
             .where(F.col("__n") / F.col("n_dated") >= DECADE_SHARE)
             .select(key, F.col("decade").alias("focus_decade")))
    return base.join(focus, key, "left")


def era_class(stats: DataFrame) -> DataFrame:
    """Recent / decade / tight / standard, plus that class's (max distance, max penalty)."""
    recent = F.col("avg_year") >= RECENT_FROM_YEAR
    cls = (F.when(recent, "recent").when(F.col("focus_decade").isNotNull(), "decade")
           .when(F.col("std_year") < TIGHT_STD, "tight").otherwise("standard"))
    out = stats.withColumn("era_class", cls)
    dist = F.lit(None).cast("int")
    pen = F.lit(None).cast("double")
    for name, (d, p) in ERA_PENALTY.items():
        dist = F.when(F.col("era_class") == name, F.lit(d)).otherwise(dist)
        pen = F.when(F.col("era_class") == name, F.lit(p)).otherwise(pen)
    return out.withColumn("max_dist", dist).withColumn("max_pen", pen)


def era_params(seeds: DataFrame, year: str = "release_year", key: str = "set_id") -> DataFrame:
    return era_class(seed_year_stats(seeds, year, key))


def recency_bonus_expr(year: Column, is_recent: Column, current_year: int = CURRENT_YEAR) -> Column:
    """T4."""
    y0r, capr = RECENT_BONUS
    y0m, capm = MILD_BONUS
    rec = F.when(year.between(y0r, current_year), (year - y0r) / F.lit(float(current_year - y0r)) * capr)
    mild = F.when(year.between(y0m, current_year), (year - y0m) / F.lit(float(current_year - y0m)) * capm)
    return F.coalesce(F.when(is_recent, rec).otherwise(mild), F.lit(0.0))


def adjustment_bin(adj: Column) -> tuple[Column, Column]:
    """(ordinal, label) of the left-closed bin; 40 and above (or NULL) → NULL."""
    label = F.lit(None).cast("string")
    ordinal = F.lit(None).cast("int")
    for i in reversed(range(len(ADJ_LABELS))):
        inside = (adj >= ADJ_EDGES[i]) & (adj < ADJ_EDGES[i + 1])
        label = F.when(inside, F.lit(ADJ_LABELS[i])).otherwise(label)
        ordinal = F.when(inside, F.lit(i)).otherwise(ordinal)
    return ordinal, label


def apply_era(items: DataFrame, params: DataFrame, year: str = "release_year", key: str = "set_id",
              current_year: int = CURRENT_YEAR, with_score: bool = False) -> DataFrame:
    """T1 + T3 + T4 + T5 (+ T6, T7): adds year_distance, year_penalty, recency_bonus,
    year_adjustment, adj_bin_ord, adj_bin (``with_score``: T6 too). A set without a dated seed has no parameters:
    its items keep their scores (adjustment 0)."""
    p = params.select(key, "avg_year", "era_class", "max_dist", "max_pen")
    j = attach(items, p, key, how="left")
    undated = F.col("avg_year").isNull()
    y = F.col(year)
    dist = F.abs(y - F.col("avg_year"))
    pen = clip(dist / F.col("max_dist") * F.col("max_pen"), 0.0, F.col("max_pen"))
    bonus = recency_bonus_expr(y, F.col("era_class") == "recent", current_year)
    j = (j.withColumn("year_distance", dist)
         .withColumn("year_penalty", pen.cast("double"))
         .withColumn("recency_bonus", bonus.cast("double")))
    adj = clip(F.col("year_penalty") - F.col("recency_bonus"), ADJ_MIN, F.col("max_pen"))
    j = j.withColumn("year_adjustment", F.when(undated, F.lit(0.0)).otherwise(adj))
    ordinal, label = adjustment_bin(F.col("year_adjustment"))
    j = j.withColumn("adj_bin_ord", ordinal).withColumn("adj_bin", label)
    keep = [*items.columns, "year_distance", "year_penalty", "recency_bonus", "year_adjustment", "adj_bin_ord", "adj_bin"]
    j = j.select(*keep, "max_pen")
    if with_score:
        j = year_score(j, key)
    return j


def year_score(df: DataFrame, key: str = "set_id") -> DataFrame:
    """100 − dist / max(dist) × 100 per set; 100 when the max is 0."""
    mx = df.groupBy(key).agg(F.max("year_distance").alias("__maxd"))
    j = attach(df, mx, key)
    score = F.when(F.col("__maxd") > 0, 100.0 - F.col("year_distance") / F.col("__maxd") * 100.0).otherwise(F.lit(100.0))
    return j.select(*df.columns, score.cast("double").alias("year_score"))


def apply_adjustment(base: Column, adj: Column) -> Column:
    """T9."""
    return base * (F.lit(1.0) - adj / 100.0)


def user_recency(df: DataFrame, score: str, b: float, year: str = "release_year", key: str = "set_id",
                 this_year: int = CURRENT_YEAR) -> DataFrame:
    """Score × (1 + b·(y − minY) / (max(maxY, this_year) − minY)); no-op at b = 0."""
    if b == 0:
        return df
    mm = df.groupBy(key).agg(F.min(year).alias("__miny"), F.max(year).alias("__maxy"))
    return with_recency(attach(df, mm, key), score, b, year, "__miny", "__maxy", this_year).select(*df.columns)


def with_recency(df: DataFrame, score: str, b: float, year: str, lo: str, hi: str, this_year: int = CURRENT_YEAR) -> DataFrame:
    """T10 where the set's first and last year are columns."""
    last = F.greatest(F.col(hi), F.lit(this_year))
    rng = F.when(last > F.col(lo), last - F.col(lo)).otherwise(F.lit(1))
    adj = F.col(score) * (1 + F.lit(b) * (F.col(year) - F.col(lo)) / rng)
    return df.select(*[adj.alias(c) if c == score else F.col(c) for c in df.columns])


def sample_rows(df: DataFrame, id_col: str, n: int = 5, key: str | None = "set_id") -> DataFrame:
    """T11 sampling: a deterministic pseudo-random n per set (md5 of the id as text), so a retry
    picks the same rows. ``row_number`` with a literal cap → per-task group limit before the
    shuffle."""
    from pyspark.sql import Window
    h = F.md5(F.col(id_col).cast("string"))
    if key is None:
        return df.orderBy(h, F.col(id_col)).limit(n)
    w = Window.partitionBy(key).orderBy(h, F.col(id_col))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")
