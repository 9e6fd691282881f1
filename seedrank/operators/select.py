"""Blend, rank, select.

Every top-k is ``row_number() over (partition by set[, cluster] order by score desc nulls
last, id)`` filtered by a *literal* cap: Spark then plans a ``WindowGroupLimit`` that keeps
only k rows per group inside each task before the shuffle, so a hot set or cluster never
ships more than k rows to one task. Ties break on the item id (the reference's "first" is
file order, which a distributed table does not have)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seedrank.functions.params import attach

# Fixed values that must equal the reference's behaviour.
# Default blend weights of the model scores (engine defaults).
DEFAULT_WEIGHTS = {"cosine_score": 0.6, "ridge_score": 0.25, "nn_score": 0.05, "glm_score": 0.1}
N_RECOMMENDATIONS = 100
TOP_N = 20


def normalise_weights(columns: Sequence[str], weights: dict[str, float] | None = None) -> dict[str, float]:
    """Keep weights of present score columns and divide by their sum."""
    weights = weights or DEFAULT_WEIGHTS
    present = {k: v for k, v in weights.items() if k in columns}
    total = sum(present.values())
    return {k: v / total for k, v in present.items()} if total else {}


def base_score(df: DataFrame, weights: dict[str, float] | None = None, out: str = "base_score") -> DataFrame:
    """R2: Σ wᵢ·coalesce(scoreᵢ, 0) over the normalised weights."""
    w = normalise_weights(df.columns, weights)
    expr: Column = F.lit(0.0)
    for k, v in w.items():
        expr = expr + F.coalesce(F.col(k), F.lit(0.0)) * F.lit(v)
    return df.withColumn(out, expr)


def _rank_window(partition: Sequence[str], score: str, id_col: str) -> Window:
    return Window.partitionBy(*partition).orderBy(F.col(score).desc_nulls_last(), F.col(id_col).asc())


def top_n(df: DataFrame, score: str, id_col: str, n: int = TOP_N, key: str | Sequence[str] = "set_id",
          rank_col: str = "rank") -> DataFrame:
    """Best ``n`` rows per group with their rank."""
    keys = [key] if isinstance(key, str) else list(key)
    w = _rank_window(keys, score, id_col)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)


def cluster_quota(seeds: DataFrame, cluster: str = "cluster", n: int = N_RECOMMENDATIONS,
                  key: str = "set_id") -> DataFrame:
    """Per (set, cluster) quota = max(1, round-half-even(share·n)); the difference to n
    goes to the cluster with the largest quota (ties: smallest cluster label)."""
    cnt = seeds.groupBy(key, cluster).agg(F.count(F.lit(1)).alias("seed_count"))
    tot = cnt.groupBy(key).agg(F.sum("seed_count").alias("__tot"))
    q = cnt.join(tot, key).withColumn("share", F.col("seed_count") / F.col("__tot"))
    q = q.withColumn("__q", F.greatest(F.lit(1), F.rint(F.col("share") * n).cast("int")))
    w_all = Window.partitionBy(key)
    w_rank = Window.partitionBy(key).orderBy(F.col("__q").desc(), F.col(cluster).asc())
    q = (q.withColumn("__alloc", F.sum("__q").over(w_all))
         .withColumn("__first", F.row_number().over(w_rank) == 1))
    quota = F.when(F.col("__first"), F.col("__q") + (F.lit(n) - F.col("__alloc"))).otherwise(F.col("__q"))
    return q.select(key, cluster, "seed_count", "share", quota.cast("int").alias("quota"))


def select_by_quota(items: DataFrame, quota: DataFrame, score: str = "base_score", id_col: str = "item_id",
                    cluster: str = "cluster", n: int = N_RECOMMENDATIONS, key: str = "set_id") -> DataFrame:
    """R4 + R5 + R6: the best ``quota`` rows of each cluster (clusters with no rows are
    skipped), then, if fewer than n, the best remaining rows up to n; ranked by score.

    Two literal-capped windows (per cluster and per set, each a per-task group limit before
    its shuffle) reduce every set to at most 2·n rows; the backfill only needs the set's
    overall top n, since at most ``got`` of those are already picked. The quotas travel as one
    cluster → quota map per set (a single-key, bounded parameter row)."""
    qmap = quota.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(cluster, "quota"))).alias("__qmap"))
    per_cluster = top_n(items, score, id_col, n, [key, cluster], rank_col="__rn")
    picked = attach(per_cluster, qmap, key).where(
        F.col("__rn") <= F.coalesce(F.element_at("__qmap", F.col(cluster)), F.lit(0))).drop("__rn", "__qmap")
    got = picked.groupBy(key).agg(F.count(F.lit(1)).alias("__got"))
    overall = top_n(items, score, id_col, n, key, rank_col="__all")
    rest = overall.join(picked.select(key, id_col), [key, id_col], "left_anti")
    rest = top_n(rest.drop("__all"), score, id_col, n, key, rank_col="__rr")
    rest = attach(rest, got, key, how="left").where(F.col("__rr") <= F.lit(n) - F.coalesce(F.col("__got"), F.lit(0)))
    chosen = picked.unionByName(rest.drop("__rr", "__got"))
    return top_n(chosen, score, id_col, n, key, rank_col="rank")


def leaderboards(df: DataFrame, scores: Sequence[str], id_col: str = "item_id", n: int = TOP_N,
                 key: str = "set_id", keep: Sequence[str] = ()) -> DataFrame:
    """Top ``n`` per (set, model) over the unpivoted score columns."""
    long = df.select(key, id_col, *keep, F.explode(F.array(*[
        F.struct(F.lit(s).alias("model"), F.col(s).cast("double").alias("score")) for s in scores])).alias("__s"))
    long = long.select(key, id_col, *keep, "__s.model", "__s.score")
    return top_n(long, "score", id_col, n, [key, "model"])


def cluster_representatives(df: DataFrame, cluster: str = "cluster", score: str = "base_score",
                            id_col: str = "item_id", n: int = 5, key: str = "set_id") -> DataFrame:
    """Per (set, cluster) its row count and its best ``n`` rows."""
    cnt = df.groupBy(key, cluster).agg(F.count(F.lit(1)).alias("cluster_size"))
    top = top_n(df, score, id_col, n, [key, cluster])
    return top.join(cnt, [key, cluster])
