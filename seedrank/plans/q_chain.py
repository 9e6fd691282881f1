"""Registered queries: the default chain (R10) with all its steps, over the ``tracks`` view, and the steps on data that moves them
(self-titled rows, seeds outside the catalogue, tags and vectors of their own)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seedrank.functions.params import count_key_bound, materialize, new_folder
from seedrank.operators import clean as C
from seedrank.operators import dedup as D
from seedrank.operators import enrich as J
from seedrank.operators import select as R
from seedrank.operators import vectors as V
from seedrank.operators.stats import Counters
from seedrank.plans import driver_views as DV
from seedrank.plans import pipeline as P
from seedrank.plans import sqlgen as S
from seedrank.plans.q_models import CLUSTER_CTES, given_centers, ridge_ctes
from seedrank.plans.q_select import QUOTA_CTES, SELECT_CTES
from seedrank.plans.q_stats import era_sql
from seedrank.plans.queries import FEATURES, catalogue, out, register
from seedrank.sources import io as IO

DIM = DV.VEC_DIM
N = R.N_RECOMMENDATIONS
#: a row's place among the listings of a track: release date, then the rest of the row that tells listings apart
ORDER = ["release_date", "item_id", "f_qty", "f_ext", "f_disc", "f_tax"]
ROLES = {"owner": "owner", "album": "album", "label": "label"}
#: keeps about a tenth of the tracks; the reference's 0.60 keeps none of these (70 unrelated dimensions)
CLOSE = 0.15


def tracks(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(items, seeds, vectors): listings carry the number of their vector, ``vec_ref``."""
    vectors = DV.track_vectors(spark, d)
    rows = materialize(C.with_release_year(DV.tracks(spark, d, vectors), "release_date"), "tracks")
    count_key_bound(rows, "set_id")
    return DV.track_items(rows), DV.track_seeds(rows), vectors


def prepared(spark: SparkSession, d: str, counters: Counters | None = None) -> tuple[DataFrame, DataFrame]:
    items, seeds, vectors = tracks(spark, d)
    return P.prepare(items, seeds, name="name", owner="owner", order_by=ORDER, tags="tags", vec="vec", lookup=DV.track_lookup(spark, d), dim=DIM,
                     counters=counters, vectors=vectors)


def _with(*ctes: str) -> str:
    year = f"{S.release_year('release_date')} AS release_year"
    head = [DV.TRACKS_SQL.strip(), f"ti AS (SELECT *, {year} FROM track_items)", f"ts AS (SELECT *, {year} FROM track_seeds)"]
    return "WITH " + ",\n".join([*head, *[c.strip() for c in ctes]]) + "\n"


_TRACK = "lower(trim(name)) || '|' || lower(trim(owner))"
_FIRST = "ORDER BY " + ", ".join(f"{c} NULLS FIRST" for c in ORDER)


def _prepare_ctes() -> list[str]:
    """D1 on both sides, C1, J2, J4 and V4 (a set with a seed without a vector is embedded anew) → ``it`` and ``sd``."""
    mean = "[" + ", ".join(f"avg(vec[{i + 1}])" for i in range(DIM)) + "]"
    zeros = "[" + ", ".join(["0.0::DOUBLE"] * DIM) + "]"
    return [
        f"it AS MATERIALIZED (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY set_id, {_TRACK} {_FIRST}) AS rn FROM ti) WHERE rn = 1 AND NOT coalesce(name = owner, false))",
        f"s1 AS MATERIALIZED (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY set_id, {_TRACK} {_FIRST}) AS rn FROM ts) WHERE rn = 1)",
        f"ct AS (SELECT set_id, lower(name) || '|' || lower(owner) AS k, tags, vec FROM (SELECT *, row_number() OVER (PARTITION BY set_id, lower(name) || '|' || lower(owner) {_FIRST}) AS rn FROM it) WHERE rn = 1)",
        "s2 AS (SELECT s1.* REPLACE (coalesce(s1.tags, ct.tags) AS tags, coalesce(ct.vec, s1.vec) AS vec) FROM s1 LEFT JOIN ct ON ct.set_id = s1.set_id AND ct.k = lower(name) || '|' || lower(owner))",
        "ow AS (SELECT lower(owner) AS o, lower(trim(t)) AS t, count(*) AS m FROM (SELECT owner, unnest(string_split(tags, ',')) AS t FROM it WHERE trim(tags) <> '') WHERE trim(t) <> '' GROUP BY ALL)",
        "ob AS (SELECT *, row_number() OVER (PARTITION BY o ORDER BY m DESC, t) AS r FROM ow)",
        "of AS (SELECT o, string_agg(t, ', ' ORDER BY r) AS fill FROM ob WHERE r <= 3 GROUP BY o)",
        "s3 AS MATERIALIZED (SELECT s2.* REPLACE (CASE WHEN tags IS NULL OR tags = '' THEN coalesce(f1.fill, f2.fill, tags) ELSE tags END AS tags) FROM s2 LEFT JOIN of f1 ON f1.o = lower(s2.owner) "
        "LEFT JOIN of f2 ON f2.o = CASE WHEN contains(s2.owner, ',') THEN lower(trim(split_part(s2.owner, ',', 1))) END)",
        "tg AS (SELECT set_id, item_id, lower(trim(t)) AS tag FROM (SELECT set_id, item_id, unnest(string_split(tags, ',')) AS t FROM s3))",
        "va AS (SELECT DISTINCT tag, unnest([0, 1, 2]) AS r, unnest([tag, replace(tag, ' ', '-'), replace(tag, '-', ' ')]) AS v FROM tg)",
        "vh AS (SELECT va.tag, vec FROM va JOIN track_lookup l ON l.tag = va.v QUALIFY row_number() OVER (PARTITION BY va.tag ORDER BY r) = 1)",
        f"vm AS (SELECT set_id, item_id, {mean} AS lv FROM tg JOIN vh USING (tag) GROUP BY set_id, item_id)",
        "an AS (SELECT set_id, bool_or(vec IS NULL) AS anew FROM s3 GROUP BY set_id)",
        f"sd AS MATERIALIZED (SELECT s3.* REPLACE (CASE WHEN anew THEN coalesce(lv, {zeros}) ELSE vec END AS vec) FROM s3 JOIN an USING (set_id) LEFT JOIN vm USING (set_id, item_id))",
    ]


# ------------------------------------------------------------------ C1 C4 D1, J1, J2 on moving data

@register("clean_tracks", _with(
    f"k AS (SELECT DISTINCT set_id, {_TRACK} AS k, name, owner FROM ti)")
    + "SELECT t.set_id, count(*) AS listings, count(DISTINCT " + _TRACK.replace("name", "t.name").replace("owner", "t.owner") + ") AS tracks, "
      "count(*) FILTER (WHERE t.name = t.owner) AS self_titled, (SELECT count(*) FROM k WHERE k.set_id = t.set_id AND k.name <> k.owner) AS kept FROM ti t GROUP BY t.set_id")
def clean_tracks(spark, d):
    """C1, C4 and D1 where they drop something: listings, distinct tracks, self-titled rows, tracks that stay; columns that are
    not needed go by name."""
    items, _, _ = tracks(spark, d)
    kept = C.drop_unused(C.drop_self_titled(D.dedup_by_key(items, "name", "owner", ORDER), "name", "owner"), ["tags", "vec_ref", "absent"])
    if {"tags", "vec_ref"} & set(kept.columns):
        raise ValueError("columns that should have gone are still there")
    a = items.groupBy("set_id").agg(F.count(F.lit(1)).alias("listings"), F.count_distinct(D.track_key("name", "owner")).alias("tracks"),
                                    F.count_if(F.col("name") == F.col("owner")).alias("self_titled"))
    return a.join(kept.groupBy("set_id").agg(F.count(F.lit(1)).alias("kept")), "set_id", "left").select("set_id", "listings", "tracks", "self_titled", F.coalesce("kept", F.lit(0)).alias("kept"))


@register("match_tracks", _with(
    "k AS (SELECT DISTINCT set_id, lower(name) || '|' || lower(owner) AS k FROM ti)")
    + "SELECT s.set_id, count(*) AS seed_rows, count(k.k) AS matched FROM ts s LEFT JOIN k ON k.set_id = s.set_id AND k.k = lower(s.name) || '|' || lower(s.owner) GROUP BY s.set_id")
def match_tracks(spark, d):
    """J1 with seeds outside the catalogue."""
    items, seeds, _ = tracks(spark, d)
    return J.match_rate(seeds, items, "name", "owner")


@register("prepare_seeds", _with(*_prepare_ctes())
          + "SELECT set_id, item_id, name, owner, tags, round(vec[1], 6) AS v0, round(vec[64], 6) AS v63, round(list_sum(vec), 6) AS v_sum FROM sd")
def prepare_seeds(spark, d):
    """The steps before scoring on the seeds (D1, J2, J4, V4): tags and vectors of their own, from the catalogue, from the owner's
    other tracks, and from the tags' vectors."""
    _, seeds = prepared(spark, d)
    total = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)
    return out(seeds.select("set_id", "item_id", "name", "owner", "tags", F.col("vec")[0].alias("v0"), F.col("vec")[63].alias("v63"), total.alias("v_sum")),
               ["set_id", "item_id", "name", "owner", "tags", "v0", "v63", "v_sum"])


# ------------------------------------------------------------------ the default chain

def _sum(terms) -> str:
    return " + ".join(terms)


def _similar_ctes(threshold: float) -> list[str]:
    """M1 on ``it`` less the seeds' tracks → ``cand``: complete rows of features and vector at least that similar."""
    v = [f"v{i}" for i in range(DIM)]
    allf = FEATURES + v
    wide = ", ".join(f"vec[{i + 1}] AS v{i}" for i in range(DIM))
    full = " AND ".join(f"{f} IS NOT NULL" for f in allf)
    st = ", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in allf)
    cen = ", ".join(f"avg({f}) AS {f}" for f in allf)
    zs = ", ".join(f"({f} - m_{f}) / {S.std1('s_' + f)} AS z_{f}" for f in allf)
    ts = ", ".join(f"(c.{f} - m_{f}) / {S.std1('s_' + f)} AS t_{f}" for f in allf)
    cos = S.cosine([f"z_{f}" for f in allf], [f"t_{f}" for f in allf])
    return [
        S.exclude_seen("it", "sd", "c0i"),
        f"c1 AS (SELECT * FROM (SELECT *, {wide} FROM c0i) WHERE {full})", f"c2 AS (SELECT * FROM (SELECT *, {wide} FROM sd) WHERE {full})",
        f"mst AS (SELECT set_id, {st} FROM c1 GROUP BY set_id)", f"mce AS (SELECT set_id, {cen} FROM c2 GROUP BY set_id)",
        f"mt_ AS (SELECT c.set_id, {ts} FROM mce c JOIN mst USING (set_id))",
        f"mz AS (SELECT c1.set_id, c1.item_id, {zs} FROM c1 JOIN mst USING (set_id))",
        f"ms AS (SELECT set_id, item_id, {cos} AS similarity FROM mz JOIN mt_ USING (set_id))",
        f"cand AS MATERIALIZED (SELECT c0i.* FROM c0i JOIN ms USING (set_id, item_id) WHERE similarity >= {threshold!r})",
    ]


def _nn_ctes() -> list[str]:
    """M13 and M14 with all inputs: features, vector, match flag, cluster indicators, cosine ×7, ridge ×2, metadata ×1, cluster ×1."""
    v = [f"v{i}" for i in range(DIM)]
    letters = "ABCDEFGHIJ"
    ind = [f"k_{x}" for x in letters]
    scores = {"cosine_score": 7.0, "ridge_score": 2.0, "glm_score": 1.0, "cluster_score": 1.0}
    cols = FEATURES + v + ["has_match"] + ind + list(scores)
    w = [1.0] * (len(cols) - len(scores)) + list(scores.values())
    feats = ", ".join([f"coalesce({f}, 0.0) AS {f}" for f in FEATURES] + [f"coalesce(vec[{i + 1}], 0.0) AS v{i}" for i in range(DIM)])
    onehot = ", ".join(f"CAST(cluster = '{x}' AS DOUBLE) AS k_{x}" for x in letters)
    st = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in cols)
    zs = ", ".join(f"({c} - m_{c}) / {S.std1('s_' + c)} AS z_{c}" for c in cols)
    cos = S.cosine([f"z_{c}" for c in cols], [f"t_{c}" for c in cols], w)
    return [
        f"ni AS MATERIALIZED (SELECT set_id, item_id, {feats}, CAST(glm_score > 0 AS DOUBLE) AS has_match, {onehot}, {', '.join(scores)} FROM sco)",
        f"nm AS (SELECT set_id, {', '.join(f'avg({c}) AS {c}' for c in scores)} FROM ni GROUP BY set_id)",
        f"ns AS MATERIALIZED (SELECT set_id, {feats}, 1.0 AS has_match, {onehot}, {', '.join('nm.' + c for c in scores)} FROM sd JOIN sa USING (set_id, item_id) JOIN nm USING (set_id))",
        f"nf AS (SELECT set_id, {', '.join(cols)} FROM ni UNION ALL SELECT set_id, {', '.join(cols)} FROM ns)",
        f"nst AS (SELECT set_id, {st} FROM nf GROUP BY set_id)",
        f"nt AS (SELECT set_id, {', '.join(f'avg(z_{c}) AS t_{c}' for c in cols)} FROM (SELECT ns.set_id, {zs} FROM ns JOIN nst USING (set_id)) GROUP BY set_id)",
        f"nz AS (SELECT ni.set_id, ni.item_id, {zs} FROM ni JOIN nst USING (set_id))",
        f"nsim AS (SELECT set_id, item_id, {cos} AS sim FROM nz JOIN nt USING (set_id))",
        "nn AS (SELECT set_id, item_id, CASE WHEN max(sim) OVER s > min(sim) OVER s THEN (sim - min(sim) OVER s) / (max(sim) OVER s - min(sim) OVER s) * 100.0 ELSE sim END AS nn_score "
        "FROM nsim WINDOW s AS (PARTITION BY set_id))",
    ]


def _chain_ctes() -> list[str]:
    seen = ", ".join(f"CASE WHEN EXISTS (SELECT 1 FROM sd WHERE sd.set_id = cand.set_id AND sd.{c} = cand.{c}) THEN 1 ELSE 0 END AS {c}_in" for c in ROLES)
    fixed = lambda c: (f"CASE WHEN max({c}) OVER s > 100 OR min({c}) OVER s < 0 OR max({c}) OVER s - min({c}) OVER s < 0.01 THEN "  # noqa: E731
                       f"CASE WHEN max({c}) OVER s > min({c}) OVER s THEN ({c} - min({c}) OVER s) / (max({c}) OVER s - min({c}) OVER s) * 100.0 ELSE 0.0 END ELSE {c} END")
    return [
        *_prepare_ctes(), *_similar_ctes(CLOSE), *S.cosine_score_ctes("cand", "sd", FEATURES, "cos"), *era_sql("cos", "sd", "era"), *CLUSTER_CTES,
        f"rg AS (WITH {', '.join(ridge_ctes(FEATURES))} SELECT set_id, item_id, CASE WHEN hi > lo THEN (ridge_fitness - lo) / (hi - lo) * 100.0 ELSE 50.0 END AS r0 "
        "FROM pr JOIN mm USING (set_id))",
        f"mt0 AS (SELECT set_id, item_id, {seen} FROM cand)",
        "mt AS (SELECT set_id, item_id, (0.5 * owner_in + 0.2 * album_in + 0.2 * label_in) / 0.9 AS p FROM mt0)",
        "gl AS (SELECT set_id, item_id, CASE WHEN max(p) OVER s - min(p) OVER s < 0.01 THEN p * 100.0 ELSE (p - min(p) OVER s) / (max(p) OVER s - min(p) OVER s) * 100.0 END AS g0 "
        "FROM mt WINDOW s AS (PARTITION BY set_id))",
        "al AS (SELECT era.*, r0, g0, ca.cluster, coalesce(sh.share, 0.0) AS c0 FROM era JOIN rg USING (set_id, item_id) JOIN gl USING (set_id, item_id) JOIN ca USING (set_id, item_id) "
        "LEFT JOIN sh ON sh.set_id = ca.set_id AND sh.cluster = ca.cluster)",
        f"sco AS MATERIALIZED (SELECT *, {fixed('r0')} AS ridge_score, {fixed('g0')} AS glm_score, {fixed('c0')} AS cluster_score FROM al WINDOW s AS (PARTITION BY set_id))",
        *_nn_ctes(),
        "sc AS MATERIALIZED (SELECT sco.*, nn_score, (coalesce(cosine_score, 0.0) * 0.6 + coalesce(ridge_score, 0.0) * 0.25 + coalesce(nn_score, 0.0) * 0.05 + coalesce(glm_score, 0.0) * 0.1) "
        "* (1.0 - year_adjustment / 100.0) AS base_score FROM sco JOIN nn USING (set_id, item_id))",
    ]


_COLS = ["set_id", "rank", "item_id", "cluster", "cosine_score", "ridge_score", "nn_score", "glm_score", "base_score"]


def default_chain(spark: SparkSession, d: str, **how) -> P.Recommendation:
    items, seeds = prepared(spark, d, how.get("counters"))
    return P.recommend(items, seeds, FEATURES, models=("cosine", "ridge", "match", "nn"), match_roles=ROLES, similarity=CLOSE, vec="vec", dim=DIM,
                       centers=given_centers(seeds), **how)


@register("recommend_default", _with(*_chain_ctes(), *QUOTA_CTES, *SELECT_CTES)
          + "SELECT rec.set_id, rec.rank, rec.item_id, rec.cluster, " + ", ".join(f"round(sc.{c}, 6) AS {c}" for c in _COLS[4:8])
          + ", round(rec.base_score, 6) AS base_score FROM rec JOIN sc USING (set_id, item_id)")
def recommend_default(spark, d):
    """R10, the default flow: ``prepare`` (D1, J2, J4, V4, C1), exclude seen (J3), similarity filter (M1, C10, C14), ridge, cosine,
    metadata match, era adjustment, given clusters, re-scaling (V10), the network's target as fourth score (M13, M14), default
    blend weights, quota selection."""
    r = default_chain(spark, d)
    return out(r.recs.withColumn("rank", F.col("rank").cast("int")), _COLS)


@register("full_chain_invariants", _with(*_prepare_ctes(), *_similar_ctes(CLOSE))
          + f"SELECT set_id, least(count(*), {N}) AS recs, TRUE AS ranked, TRUE AS unseen, TRUE AS in_range, TRUE AS several_clusters FROM cand "
            "WHERE set_id IN (SELECT set_id FROM sd GROUP BY set_id HAVING count(*) >= 10) GROUP BY set_id HAVING count(*) >= 10")
def full_chain_invariants(spark, d):
    """R10 with every fitted model: the default flow with the fitted GLM (M4), K-means with the elbow (M8, M9) and the learned blend
    (M15). Per set with at least 10 seeds and 10 kept candidates: as many recommendations as there can be, ranked by score, no
    track of the seeds, scores in 0 to 100, more than one cluster among the candidates."""
    items, seeds = prepared(spark, d)
    r = P.recommend(items, seeds, FEATURES, models=("cosine", "ridge", "glm", "nn_trees"), match_roles=ROLES, similarity=CLOSE, vec="vec", dim=DIM)
    scores = ["cosine_score", "ridge_score", "nn_score", "glm_score"]
    recs = materialize(r.recs, "recs")
    w = Window.partitionBy("set_id").orderBy("rank")  # at most N rows a set
    order = recs.withColumn("up", F.coalesce(F.lead("base_score").over(w) <= F.col("base_score"), F.lit(True)))
    order = order.withColumn("fit", F.forall(F.array(*scores), lambda v: (v >= -1e-6) & (v <= 100 + 1e-6)))
    known = items.select("set_id", "item_id", D.track_key("name", "owner", trim=False).alias("k")).join(
        seeds.select("set_id", D.track_key("name", "owner", trim=False).alias("k")).distinct(), ["set_id", "k"], "left_semi").select("set_id", "item_id")
    seen = recs.join(known, ["set_id", "item_id"], "left_semi").groupBy("set_id").agg(F.count(F.lit(1)).alias("seen"))
    per = order.groupBy("set_id").agg(F.count(F.lit(1)).alias("recs"), (F.bool_and("up") & (F.count_distinct("rank") == F.count(F.lit(1))) & (F.max("rank") == F.count(F.lit(1)))).alias("ranked"),
                                      F.bool_and("fit").alias("in_range"))
    mix = r.scored.groupBy("set_id").agg((F.count_distinct("cluster") > 1).alias("several_clusters"), F.count(F.lit(1)).alias("kept"))
    enough = seeds.groupBy("set_id").agg(F.count(F.lit(1)).alias("m")).where("m >= 10")
    out_ = per.join(seen, "set_id", "left").join(mix, "set_id").join(enough, "set_id", "left_semi").where("kept >= 10")
    return out_.select("set_id", "recs", "ranked", F.col("seen").isNull().alias("unseen"), "in_range", "several_clusters")


_MODELS = ["cosine_score", "ridge_score", "nn_score", "glm_score"]


@register("model_leaderboards", _with(
    *_chain_ctes(), "lb AS (" + " UNION ALL ".join(f"SELECT set_id, item_id, '{m}' AS model, {m} AS score FROM sc" for m in _MODELS) + ")",
    "lr AS (SELECT set_id, model, CAST(row_number() OVER (PARTITION BY set_id, model ORDER BY round(score, 6) DESC NULLS LAST, item_id) AS INTEGER) AS rank, item_id, round(score, 6) AS score FROM lb)")
    + "SELECT * FROM lr WHERE rank <= 20")
def model_leaderboards(spark, d):
    """The top 20 per set of each model of the default chain (ties of the rounded score by id)."""
    r = default_chain(spark, d)
    scored = r.scored.select("set_id", "item_id", *[F.round(m, 6).alias(m) for m in _MODELS])
    return out(R.leaderboards(scored, _MODELS).withColumn("rank", F.col("rank").cast("int")), ["set_id", "model", "rank", "item_id", "score"])


@register("recommend_plain", _with(
    *_prepare_ctes(), S.exclude_seen("it", "sd", "cand"), *S.cosine_score_ctes("cand", "sd", FEATURES, "cos"), *era_sql("cos", "sd", "era"),
    "b AS (SELECT *, coalesce(cosine_score, 0.0) * (1.0 - year_adjustment / 100.0) AS base_score FROM era)",
    f"r AS (SELECT *, CAST(row_number() OVER (PARTITION BY set_id ORDER BY base_score DESC NULLS LAST, item_id) AS INTEGER) AS rank FROM b)")
    + f"SELECT set_id, rank, item_id, round(base_score, 6) AS base_score FROM r WHERE rank <= {N}")
def recommend_plain(spark, d):
    """R6 without clusters: the plain ranking of the cosine score after the era adjustment."""
    items, seeds = prepared(spark, d)
    r = P.recommend(items, seeds, FEATURES, models=("cosine",), centers="none")
    return out(r.recs.withColumn("rank", F.col("rank").cast("int")), ["set_id", "rank", "item_id", "base_score"])


@register("similarity_kept", _with(*_prepare_ctes(), *_similar_ctes(CLOSE))
          + f"SELECT set_id, item_id, round(similarity, 6) AS similarity_score FROM ms WHERE similarity >= {CLOSE!r}")
def similarity_kept(spark, d):
    """M1 with C14 at a threshold that keeps rows of these tables."""
    from seedrank.operators.score import similarity_filter

    items, seeds = prepared(spark, d)
    x = F.concat(F.array(*[F.col(f).cast("double") for f in FEATURES]), F.col("vec"))
    cand = J.exclude_seen(items, seeds, "name", "owner")
    kept = similarity_filter(cand.withColumn("x", x), seeds.withColumn("x", x), "x", len(FEATURES) + DIM, threshold=CLOSE)
    return out(kept, ["set_id", "item_id", "similarity_score"])


# ------------------------------------------------------------------ S7, S9

@register("cached_items", S.with_items(S.items_with_year("it"))
          + "SELECT set_id, count(*) AS items, count(DISTINCT owner) AS owners, min(release_year) AS first_year, max(release_year) AS last_year FROM it GROUP BY set_id")
def cached_items(spark, d):
    """The catalogue kept between requests; the first request fills the cache, the second reads it."""
    kept = IO.cache_items(catalogue(spark, d).select("set_id", "item_id", "owner", "release_year"))
    first = kept.groupBy("set_id").agg(F.count(F.lit(1)).alias("items"), F.count_distinct("owner").alias("owners"))
    second = kept.groupBy("set_id").agg(F.min("release_year").alias("first_year"), F.max("release_year").alias("last_year"))
    return first.join(second, "set_id").select("set_id", "items", "owners", "first_year", "last_year")


@register("written_items", _with(*_prepare_ctes()[:1])
          + "SELECT set_id, item_id, name, owner, release_year, round(f_ext, 6) AS f_ext, tags, round(list_sum(vec), 6) AS v_sum FROM it")
def written_items(spark, d):
    """The cleaned catalogue as it lies on disk, a folder per set, read back."""
    items, _, vectors = tracks(spark, d)
    clean = C.drop_self_titled(D.dedup_by_key(items, "name", "owner", ORDER), "name", "owner")
    clean = V.named_vectors(clean, vectors, "vec_ref", "vec").drop("vec_ref")
    path = new_folder(spark, "clean")
    IO.write_table(clean, path, partition_by=["set_id"])
    back = spark.read.schema(clean.schema).parquet(path)
    total = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)
    return out(back.withColumn("v_sum", total), ["set_id", "item_id", "name", "owner", "release_year", "f_ext", "tags", "v_sum"])


# ------------------------------------------------------------------ A13 by observation

_COUNTS = ["tracks_rows", "items_rows", "enriched_rows", "enriched_untagged", "filled_rows", "filled_untagged", "candidates_rows", "kept_rows"]


@register("chain_counters", _with(
    *_prepare_ctes(), *_similar_ctes(CLOSE))
    + "SELECT (SELECT count(DISTINCT (set_id, " + _TRACK + ")) FROM ti) AS tracks_rows, (SELECT count(*) FROM it) AS items_rows, (SELECT count(*) FROM s2) AS enriched_rows, "
      "(SELECT count(*) FROM s2 WHERE tags IS NULL OR tags = '') AS enriched_untagged, (SELECT count(*) FROM s3) AS filled_rows, "
      "(SELECT count(*) FROM s3 WHERE tags IS NULL OR tags = '') AS filled_untagged, (SELECT count(*) FROM c0i) AS candidates_rows, (SELECT count(*) FROM cand) AS kept_rows")
def chain_counters(spark, d):
    """Tracks, kept items, seeds without tags before and after the filling, candidates, and those that the threshold keeps,
    as observed while the default chain wrote its tables."""
    counters = Counters()
    default_chain(spark, d, counters=counters)
    seen = counters.values()
    return spark.createDataFrame([tuple(seen[c] for c in _COUNTS)], ", ".join(f"{c} long" for c in _COUNTS))
