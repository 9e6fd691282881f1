"""Registered queries: quota selection and ranked lists (R3–R9) and their summaries (A8,
A16, A17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedrank.operators import select as R
from seedrank.operators import stats as A
from seedrank.plans import sqlgen as S
from seedrank.plans import pipeline as P
from seedrank.plans.q_models import CLUSTER_CTES, _ridge_sql, clusters_frames, seed_scaled_frames
from seedrank.plans.q_stats import era_sql
from seedrank.plans.queries import FEATURES, base_tables, candidates, out, register, score_core

N = R.N_RECOMMENDATIONS


def scored_with_clusters(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(candidates with base_score and cluster, seeds with cluster)."""
    cand, sd = candidates(spark, d)
    sc = score_core(cand, sd)
    ca, sa = clusters_frames(cand, sd)
    return sc.join(ca.select("set_id", "item_id", "cluster"), ["set_id", "item_id"]), sa


def recommendations(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(recommendations, seeds with clusters, scored candidates) from the library pipeline
    (R10) with the cosine score as the model and the per-release-year seed centroids as the
    given clusters."""
    it, sd = base_tables(spark, d)
    _, _, cen = seed_scaled_frames(it, sd)
    r = P.recommend(it, sd, FEATURES, models=("cosine",),
                    weights={"cosine_score": R.DEFAULT_WEIGHTS["cosine_score"]}, centers=cen)
    return r.recs, r.seeds, r.scored


# SQL: candidates with base_score (b) and clusters (ca, sa), then quota and selection.
_SCORED = [
    *S.cosine_score_ctes("cand", "sd", FEATURES, "cos"), *era_sql("cos", "sd", "era"),
    "b AS (SELECT *, (0.0 + coalesce(cosine_score, 0.0) * 1.0) * (1.0 - year_adjustment / 100.0) AS base_score FROM era)",
    *CLUSTER_CTES,
    "sc AS (SELECT b.*, ca.cluster FROM b JOIN ca USING (set_id, item_id))",
]
QUOTA_CTES = [
    "q0 AS (SELECT set_id, cluster, count(*) AS seed_count FROM sa GROUP BY ALL)",
    "q1 AS (SELECT *, seed_count / sum(seed_count) OVER (PARTITION BY set_id) AS share FROM q0)",
    f"q2 AS (SELECT *, greatest(1, CAST(round_even(share * {N}, 0) AS INTEGER)) AS q FROM q1)",
    "q3 AS (SELECT *, sum(q) OVER (PARTITION BY set_id) AS alloc, row_number() OVER (PARTITION BY set_id ORDER BY q DESC, cluster) AS r FROM q2)",
    f"quota AS (SELECT set_id, cluster, seed_count, share, CAST(CASE WHEN r = 1 THEN q + ({N} - alloc) ELSE q END AS INTEGER) AS quota FROM q3)",
]
SELECT_CTES = [
    "rk AS (SELECT *, row_number() OVER (PARTITION BY set_id, cluster ORDER BY base_score DESC NULLS LAST, item_id) AS rn FROM sc)",
    f"picked AS (SELECT rk.* FROM rk JOIN quota USING (set_id, cluster) WHERE rn <= quota AND rn <= {N})",
    "got AS (SELECT set_id, count(*) AS got FROM picked GROUP BY set_id)",
    "rest AS (SELECT * FROM sc WHERE NOT EXISTS (SELECT 1 FROM picked p WHERE p.set_id = sc.set_id AND p.item_id = sc.item_id))",
    "rr AS (SELECT *, row_number() OVER (PARTITION BY set_id ORDER BY base_score DESC NULLS LAST, item_id) AS rn2 FROM rest)",
    f"fill AS (SELECT rr.* FROM rr LEFT JOIN got USING (set_id) WHERE rn2 <= {N} - coalesce(got, 0))",
    "chosen AS (SELECT set_id, item_id, cluster, base_score FROM picked UNION ALL SELECT set_id, item_id, cluster, base_score FROM fill)",
    "fin AS (SELECT *, CAST(row_number() OVER (PARTITION BY set_id ORDER BY base_score DESC NULLS LAST, item_id) AS INTEGER) AS rank FROM chosen)",
    f"rec AS (SELECT * FROM fin WHERE rank <= {N})",
]


# ------------------------------------------------------------------ R3

@register("cluster_quota", S.base(*_SCORED, *QUOTA_CTES) + "SELECT set_id, cluster, seed_count, round(share, 6) AS share, quota FROM quota")
def cluster_quota(spark, d):
    """Per cluster max(1, round-half-even(share·100)); the remainder to the largest."""
    cand, sd = candidates(spark, d)
    _, sa = clusters_frames(cand, sd)
    return out(R.cluster_quota(sa, "cluster", N), ["set_id", "cluster", "seed_count", "share", "quota"])


# ------------------------------------------------------------------ R4 R5 R6 (+ J6)

@register("recommend", S.base(*_SCORED, *QUOTA_CTES, *SELECT_CTES)
          + "SELECT set_id, rank, item_id, cluster, round(base_score, 6) AS base_score FROM rec")
def recommend(spark, d):
    """The full selection: best quota rows per cluster (R4), backfill from the remaining rows
    (J6 / R5), final ranking (R6): 100 recommendations per set."""
    rec, _, _ = recommendations(spark, d)
    return out(rec.withColumn("rank", F.col("rank").cast("int")), ["set_id", "rank", "item_id", "cluster", "base_score"])


# ------------------------------------------------------------------ R8

@register("leaderboards", S.base(
    *S.cosine_score_ctes("cand", "sd", FEATURES, "cos"), *era_sql("cos", "sd", "era"),
    "l AS (SELECT set_id, item_id, 'cosine_score' AS model, cosine_score AS score FROM era UNION ALL "
    "SELECT set_id, item_id, 'year_score' AS model, year_score AS score FROM era)",
    "r AS (SELECT *, CAST(row_number() OVER (PARTITION BY set_id, model ORDER BY score DESC NULLS LAST, item_id) AS INTEGER) AS rank FROM l)")
    + "SELECT set_id, model, rank, item_id, round(score, 6) AS score FROM r WHERE rank <= 20")
def leaderboards(spark, d):
    """The top 20 of each model score per set."""
    sc = score_core(*candidates(spark, d), year_score=True)
    lb = R.leaderboards(sc, ["cosine_score", "year_score"])
    return out(lb.withColumn("rank", F.col("rank").cast("int")), ["set_id", "model", "rank", "item_id", "score"])


# ------------------------------------------------------------------ R9

@register("cluster_representatives", S.base(
    *_SCORED,
    "cs AS (SELECT set_id, cluster, count(*) AS cluster_size FROM sc GROUP BY ALL)",
    "r AS (SELECT *, CAST(row_number() OVER (PARTITION BY set_id, cluster ORDER BY base_score DESC NULLS LAST, item_id) AS INTEGER) AS rank FROM sc)")
    + "SELECT set_id, cluster, rank, item_id, round(base_score, 6) AS base_score, cluster_size FROM r JOIN cs USING (set_id, cluster) WHERE rank <= 5")
def cluster_representatives(spark, d):
    """Size of every cluster and its five best candidates."""
    sc, _ = scored_with_clusters(spark, d)
    r = R.cluster_representatives(sc)
    return out(r.withColumn("rank", F.col("rank").cast("int")),
               ["set_id", "cluster", "rank", "item_id", "base_score", "cluster_size"])


# ------------------------------------------------------------------ A8

@register("cluster_distribution", S.base(
    *_SCORED, *QUOTA_CTES, *SELECT_CTES,
    "a AS (SELECT set_id, cluster, count(*) AS seed_count, count(*) / sum(count(*)) OVER (PARTITION BY set_id) AS seed_share FROM sa GROUP BY set_id, cluster)",
    "bb AS (SELECT set_id, cluster, count(*) AS rec_count, count(*) / sum(count(*)) OVER (PARTITION BY set_id) AS rec_share FROM rec GROUP BY set_id, cluster)")
    + "SELECT coalesce(a.set_id, bb.set_id) AS set_id, coalesce(a.cluster, bb.cluster) AS cluster, coalesce(seed_count, 0) AS seed_count, "
      "round(coalesce(seed_share, 0.0), 6) AS seed_share, coalesce(rec_count, 0) AS rec_count, round(coalesce(rec_share, 0.0), 6) AS rec_share "
      "FROM a FULL OUTER JOIN bb ON a.set_id = bb.set_id AND a.cluster = bb.cluster")
def cluster_distribution(spark, d):
    """Cluster counts and shares of the seeds and of the recommendations, side by side."""
    rec, sa, _ = recommendations(spark, d)
    cd = A.cluster_distribution(sa, rec)
    return out(cd, ["set_id", "cluster", "seed_count", "seed_share", "rec_count", "rec_share"])


# ------------------------------------------------------------------ A16

@register("final_summary", S.base(*_SCORED, *QUOTA_CTES, *SELECT_CTES) + (
    "SELECT set_id, count(*) AS n, round(avg(base_score), 6) AS mean, round(min(base_score), 6) AS min, "
    "round(max(base_score), 6) AS max FROM rec GROUP BY set_id"))
def final_summary(spark, d):
    """Number, mean, min and max base score of each set's recommendations."""
    rec, _, _ = recommendations(spark, d)
    return out(A.final_summary(rec), ["set_id", "n", "mean", "min", "max"])


# ------------------------------------------------------------------ A17

def _profile_sql():
    means = " UNION ALL ".join(f"SELECT set_id, 'seed mean' AS series, '{f}' AS feature, avg({f}) AS value FROM sd GROUP BY set_id"
                               for f in FEATURES)
    tops = " UNION ALL ".join(f"SELECT set_id, 'rec ' || CAST(rank AS VARCHAR) AS series, '{f}' AS feature, CAST({f} AS DOUBLE) AS value "
                              f"FROM top5" for f in FEATURES)
    return S.base(
        *_SCORED, *QUOTA_CTES, *SELECT_CTES,
        "r5 AS (SELECT rec.set_id, rec.rank, rec.item_id FROM rec WHERE rank <= 5)",
        "top5 AS (SELECT r5.set_id, r5.rank, cand.* EXCLUDE (set_id) FROM r5 JOIN cand USING (item_id))",
    ) + f"SELECT set_id, series, feature, round(value, 6) AS value FROM ({means} UNION ALL {tops})"


@register("feature_profile", _profile_sql())
def feature_profile(spark, d):
    """The seed mean of each feature next to the features of the five best
    recommendations."""
    rec, _, _ = recommendations(spark, d)
    cand, sd = candidates(spark, d)
    feats = rec.select("set_id", "item_id", "base_score").join(cand.select("item_id", *FEATURES), "item_id")
    return out(A.feature_profile(sd, feats, FEATURES), ["set_id", "series", "feature", "value"])


# ------------------------------------------------------------------ R10 with several weighted scores

def _blend_ctes() -> list[str]:
    ridge = _ridge_sql(FEATURES)
    ridge = ridge[:ridge.rindex("SELECT set_id, item_id, round(ridge_fitness")]  # its CTEs, unrounded below
    seen = ", ".join(f"CASE WHEN EXISTS (SELECT 1 FROM sd WHERE sd.set_id = cand.set_id AND sd.{c} = cand.{c}) THEN 1 ELSE 0 END AS {c}_in"
                     for c in ("owner", "album", "label"))
    fixed = lambda c: (f"CASE WHEN max({c}) OVER s > 100 OR min({c}) OVER s < 0 OR max({c}) OVER s - min({c}) OVER s < 0.01 THEN "  # noqa: E731
                       f"CASE WHEN max({c}) OVER s > min({c}) OVER s THEN ({c} - min({c}) OVER s) / (max({c}) OVER s - min({c}) OVER s) * 100.0 "
                       f"ELSE 0.0 END ELSE {c} END")
    return [
        *S.cosine_score_ctes("cand", "sd", FEATURES, "cos"), *era_sql("cos", "sd", "era"), *CLUSTER_CTES,
        f"rg AS ({ridge} SELECT set_id, item_id, CASE WHEN hi > lo THEN (ridge_fitness - lo) / (hi - lo) * 100.0 ELSE 50.0 END AS ridge_score "
        "FROM pr JOIN mm USING (set_id))",
        f"mt0 AS (SELECT set_id, item_id, {seen} FROM cand)",
        "mt AS (SELECT set_id, item_id, (0.5 * owner_in + 0.2 * album_in + 0.2 * label_in) / 0.9 AS p FROM mt0)",
        "gl AS (SELECT set_id, item_id, CASE WHEN max(p) OVER s - min(p) OVER s < 0.01 THEN p * 100.0 "
        "ELSE (p - min(p) OVER s) / (max(p) OVER s - min(p) OVER s) * 100.0 END AS glm_score FROM mt WINDOW s AS (PARTITION BY set_id))",
        "al AS (SELECT era.*, ridge_score AS r0, glm_score AS g0 FROM era JOIN rg USING (set_id, item_id) JOIN gl USING (set_id, item_id))",
        f"sco AS (SELECT *, {fixed('r0')} AS ridge_score, {fixed('g0')} AS glm_score FROM al WINDOW s AS (PARTITION BY set_id))",
        "b AS (SELECT *, (coalesce(cosine_score, 0.0) * 0.6 + coalesce(ridge_score, 0.0) * 0.25 + coalesce(glm_score, 0.0) * 0.1) / 0.95 "
        "* (1.0 - year_adjustment / 100.0) AS base_score FROM sco)",
        "sc AS (SELECT b.*, ca.cluster FROM b JOIN ca USING (set_id, item_id))",
    ]


_BLEND_COLS = ["set_id", "rank", "item_id", "cluster", "cosine_score", "ridge_score", "glm_score", "base_score"]


@register("recommend_blend", S.base(*_blend_ctes(), *QUOTA_CTES, *SELECT_CTES)
          + "SELECT rec.set_id, rec.rank, rec.item_id, rec.cluster, round(sc.cosine_score, 6) AS cosine_score, "
            "round(sc.ridge_score, 6) AS ridge_score, round(sc.glm_score, 6) AS glm_score, round(rec.base_score, 6) AS base_score "
            "FROM rec JOIN sc USING (set_id, item_id)")
def recommend_blend(spark, d):
    """R10 with cosine, ridge and metadata match under the default weights renormalised over those three
    (R1, R2), given clusters, era adjustment and quota selection."""
    it, sd = base_tables(spark, d)
    _, _, cen = seed_scaled_frames(it, sd)
    r = P.recommend(it, sd, FEATURES, models=("cosine", "ridge", "match"), centers=cen,
                    match_roles={"owner": "owner", "album": "album", "label": "label"})
    return out(r.recs.withColumn("rank", F.col("rank").cast("int")), _BLEND_COLS)


# ------------------------------------------------------------------ R10 with K-means clusters

@register("recommend_full")
def recommend_full(spark, d):
    """R10 with ridge (M2), cosine (M3), metadata match (M7 in place of the fitted GLM, M4), era
    adjustment, K-means with the elbow rule (M8–M12), default blend weights renormalised over the
    scores present, quota selection of 100 per set. Less than the reference's default flow: without
    ``prepare``, the similarity filter (M1), the GLM, and the network's score (M14, M15)."""
    it, sd = base_tables(spark, d)
    r = P.recommend(it, sd, FEATURES, models=("cosine", "ridge", "match"),
                    match_roles={"owner": "owner", "album": "album", "label": "label"})
    cols = ["set_id", "rank", "item_id", "cluster", "cosine_score", "ridge_score", "glm_score", "cluster_score", "base_score"]
    return out(r.recs.withColumn("rank", F.col("rank").cast("int")), cols)
