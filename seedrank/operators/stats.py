"""Aggregations and summaries (A1–A17). Each is one or two hash aggregates keyed by
``set_id`` (partial aggregation map-side), shares computed against a per-set total joined
back on the key; top-k lists use literal-capped ``row_number`` (group limit per task)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from seedrank.functions.params import attach
from seedrank.operators.select import top_n

# Fixed values that must equal the reference's behaviour.
# Feature level cut points (interactive view): loudness-like in dB, tempo-like in BPM, others 0..1.
LEVELS_DB = (-12.0, -8.0, "Low", "High")        # Low < -12, High > -8
LEVELS_TEMPO = (90.0, 120.0, "Slow", "Fast")    # Slow < 90, Fast > 120
LEVELS_UNIT = (0.4, 0.6, "Low", "High")         # Low < 0.4, High > 0.6
LEVEL_MID = "Medium"


def unpivot(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "feature",
            value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), [F.col(c).cast("double").alias(c) for c in cols], name, value)


def tag_counts(df: DataFrame, tags: str, top: int = 5, key: str = "set_id", split: str = ",") -> DataFrame:
    """A1: split, explode, trim, count; best ``top`` per set (count desc, tag asc)."""
    ex = df.where(F.col(tags).isNotNull()).select(key, F.explode(F.split(F.col(tags), split)).alias("__t"))
    cnt = ex.select(key, F.trim("__t").alias("tag")).groupBy(key, "tag").agg(F.count(F.lit(1)).alias("n"))
    return top_n(cnt, "n", "tag", top, key)


def decade_histogram(df: DataFrame, year: str = "release_year", key: str = "set_id") -> DataFrame:
    """A2: rows per decade and their share of the dated rows of the set."""
    dated = df.where(F.col(year).isNotNull())
    h = dated.groupBy(key, (F.floor(F.col(year) / 10) * 10).cast("int").alias("decade")).agg(F.count(F.lit(1)).alias("n"))
    tot = dated.groupBy(key).agg(F.count(F.lit(1)).alias("__tot"))
    return attach(h, tot, key).select(key, "decade", "n", (F.col("n") / F.col("__tot")).alias("share"))


def feature_means(df: DataFrame, features: Sequence[str], key: str = "set_id") -> DataFrame:
    """A5: per-set mean of each feature, as (set, feature, mean) rows."""
    m = df.groupBy(key).agg(*[F.avg(f).alias(f) for f in features])
    return unpivot(m, [key], features, "feature", "mean")


def level_expr(feature: F.Column, v: F.Column, db_like: Sequence[str] = (), tempo_like: Sequence[str] = ()) -> F.Column:
    """A6 labels: thresholds by feature kind."""
    def rule(cut):
        lo, hi, low_lab, high_lab = cut
        return F.when(v > hi, high_lab).when(v < lo, low_lab).otherwise(LEVEL_MID)
    e = rule(LEVELS_UNIT)
    if tempo_like:
        e = F.when(feature.isin(list(tempo_like)), rule(LEVELS_TEMPO)).otherwise(e)
    if db_like:
        e = F.when(feature.isin(list(db_like)), rule(LEVELS_DB)).otherwise(e)
    return e


def feature_levels(means: DataFrame, db_like: Sequence[str] = (), tempo_like: Sequence[str] = ()) -> DataFrame:
    """Add a level label to feature_means rows."""
    return means.withColumn("level", level_expr(F.col("feature"), F.col("mean"), db_like, tempo_like))


def cluster_distribution(seeds: DataFrame, recs: DataFrame, cluster: str = "cluster", key: str = "set_id") -> DataFrame:
    """Count and share per cluster for seeds and for recommendations, side by side."""
    def dist(df, p):
        c = df.groupBy(key, cluster).agg(F.count(F.lit(1)).alias(f"{p}_count"))
        t = df.groupBy(key).agg(F.count(F.lit(1)).alias("__t"))
        return attach(c, t, key).select(key, cluster, f"{p}_count", (F.col(f"{p}_count") / F.col("__t")).alias(f"{p}_share"))
    a, b = dist(seeds, "seed"), dist(recs, "rec")
    j = a.join(b, [key, cluster], "full")
    return j.select(key, cluster, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in
                                    ("seed_count", "seed_share", "rec_count", "rec_share")])


def adjustment_histogram(df: DataFrame, key: str = "set_id") -> DataFrame:
    """Count and share per adjustment bin, in bin order (rows out of every bin, such as
    the capped 40, count in the total but form no bin)."""
    h = df.where(F.col("adj_bin").isNotNull()).groupBy(key, "adj_bin_ord", "adj_bin").agg(F.count(F.lit(1)).alias("n"))
    tot = df.groupBy(key).agg(F.count(F.lit(1)).alias("__t"))
    return attach(h, tot, key).select(key, "adj_bin_ord", "adj_bin", "n", (F.col("n") / F.col("__t")).alias("share"))


def histogram(df: DataFrame, col: str, bins: int, key: str = "set_id") -> DataFrame:
    """``bins`` equal-width bins over the set's [min, max] (max falls in the last
    bin), with each bin's count and the set's mean."""
    x = F.col(col)
    mm = df.where(x.isNotNull()).groupBy(key).agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"), F.avg(col).alias("mean"))
    j = attach(df.where(x.isNotNull()).select(key, col), mm, key)
    lo, hi = F.col("__lo"), F.col("__hi")
    b = F.when(hi > lo, F.least(F.floor((x - lo) / (hi - lo) * bins), F.lit(bins - 1))).otherwise(F.lit(0)).cast("int")
    h = j.groupBy(key, b.alias("bin"), "__lo", "__hi", "mean").agg(F.count(F.lit(1)).alias("n"))
    width = (hi - lo) / bins
    return h.select(key, "bin", (lo + F.col("bin") * width).alias("bin_lo"),
                    (lo + (F.col("bin") + 1) * width).alias("bin_hi"), "n", "mean")


def score_summary(df: DataFrame, scores: Sequence[str], key: str = "set_id") -> DataFrame:
    """Per (set, score): non-zero count and share, mean and min of the non-zero values,
    max, zero count."""
    long = unpivot(df.select(key, *scores), [key], scores, "score", "v")
    v = F.col("v")
    return long.groupBy(key, "score").agg(
        F.count_if(v > 0).alias("nonzero"),
        (F.count_if(v > 0) / F.count(F.lit(1))).alias("nonzero_share"),
        F.avg(F.when(v > 0, v)).alias("nonzero_mean"),
        F.min(F.when(v > 0, v)).alias("nonzero_min"),
        F.max(v).alias("max"),
        F.count_if(v == 0).alias("zeros"),
    )


def final_summary(df: DataFrame, score: str = "base_score", key: str = "set_id") -> DataFrame:
    """A16."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean"),
                               F.min(score).alias("min"), F.max(score).alias("max"))


def feature_profile(seeds: DataFrame, recs: DataFrame, features: Sequence[str], score: str = "base_score",
                    id_col: str = "item_id", top: int = 5, key: str = "set_id") -> DataFrame:
    """The seed mean of each feature next to the features of the best ``top``
    recommendations, as (set, series, feature, value)."""
    m = feature_means(seeds, features, key).select(key, F.lit("seed mean").alias("series"), "feature",
                                                   F.col("mean").alias("value"))
    best = top_n(recs, score, id_col, top, key)
    b = unpivot(best.select(key, "rank", *features), [key, "rank"], features, "feature", "value")
    b = b.select(key, F.concat(F.lit("rec "), F.col("rank").cast("string")).alias("series"), "feature", "value")
    return m.unionByName(b)


# Fixed values that must equal the reference's behaviour (console summary of the cosine model).
TRENDS_TEMPO = (100.0, 130.0, "slow", "fast", "medium")     # slow < 100, fast >= 130
TRENDS_OTHER = (0.4, 0.6, "low", "high", "neutral")         # low < 0.4, high > 0.6


def feature_trends(means: DataFrame, tempo_like: Sequence[str] = ()) -> DataFrame:
    """The console labels of feature_means rows. Tempo-like features: fast ≥ 130, slow <
    100, else medium; every other feature — loudness included, whose own label the reference
    overwrites with the generic branch — high > 0.6, low < 0.4, else neutral."""
    v = F.col("mean")
    lo, hi, low, high, mid = TRENDS_TEMPO
    tempo = F.when(v >= hi, high).when(v < lo, low).otherwise(mid)
    lo, hi, low, high, mid = TRENDS_OTHER
    other = F.when(v > hi, high).when(v < lo, low).otherwise(mid)
    lab = F.when(F.col("feature").isin(list(tempo_like)), tempo).otherwise(other) if tempo_like else other
    return means.withColumn("trend", lab)


class Counters:
    """Counts that the tables' own writes yield (``DataFrame.observe``), without a job of their own. ``watch`` marks a frame;
    once an action has run it, ``values`` holds its counts as ``<stage>_<count>``."""

    def __init__(self):
        self.seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame, stage: str, **counts: Column) -> DataFrame:
        """``df`` with its rows, and each of ``counts`` (rows for which it holds), counted under the name ``stage``."""
        self.seen[stage] = Observation()
        return df.observe(self.seen[stage], F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in counts.items()])

    def values(self) -> dict[str, int]:
        return {f"{stage}_{n}": v for stage, o in self.seen.items() for n, v in o.get.items()}
