"""Registered queries: vectors (V*), scoring models (M*) and clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from seedrank.functions import exprs as X
from seedrank.functions.params import attach
from seedrank.operators import cluster as K
from seedrank.operators import score as M
from seedrank.operators import vectors as V
from seedrank.plans import driver_views as DV
from seedrank.plans import sqlgen as S
from seedrank.plans.queries import FEATURES, candidates, out, register

DIM = DV.VEC_DIM
GENRE = [f"genre_dim_{i}" for i in range(DIM)]


def iv_sql(name: str = "iv") -> str:
    dims = ", ".join(f"avg(e.embedding[{i + 1}]) AS genre_dim_{i}" for i in range(DIM))
    return (f"{name} AS (SELECT l.l_orderkey AS item_id, {dims} FROM lineitem l JOIN embeddings e "
            f"ON e.vec_id = l.l_suppkey GROUP BY l.l_orderkey)")


def with_vectors(df: DataFrame, spark: SparkSession, d: str, expand: bool = True) -> DataFrame:
    """Rows with their pooled vector ``vec`` (``candidates`` carries it if asked; pooled here otherwise)."""
    j = df if "vec" in df.columns else df.join(DV.item_vectors(spark, d), "item_id", "left")
    return V.expand_vector(j, "vec", DIM, "genre_dim_") if expand else j


# ------------------------------------------------------------------ V1

def _vec_text_spark() -> F.Column:
    parts = F.transform("embedding", lambda x: F.format_string("%.6f", x.cast("double")))
    return F.when(F.col("label") < 5, F.concat(F.lit("["), F.array_join(parts, ", "), F.lit("]"))).otherwise(
        F.array_join(parts, " "))


_V1 = ["vec_id", "n", "v0", "v_sum"]


@register("parse_vector", "WITH t AS (SELECT vec_id, CASE WHEN label < 5 THEN '[' || array_to_string(list_transform(embedding, "
          "lambda x: printf('%.6f', x::DOUBLE)), ', ') || ']' ELSE array_to_string(list_transform(embedding, lambda x: printf('%.6f', x::DOUBLE)), ' ') "
          "END AS txt FROM embeddings), p AS (SELECT vec_id, list_transform(string_split(trim(regexp_replace(txt, '[\\[\\],\\s]+', ' ', 'g')), ' '), "
          "lambda x: try_cast(x AS DOUBLE)) AS v FROM t) SELECT vec_id, CAST(len(v) AS INTEGER) AS n, round(v[1], 6) AS v0, "
          "round(" + " + ".join(f"v[{i + 1}]" for i in range(DIM)) + ", 6) AS v_sum FROM p")
def parse_vector(spark, d):
    """V1: vectors stored as text ('[a, b, ...]' or 'a b ...') parsed back to doubles."""
    e = DV.table(spark, d, "embeddings").select("vec_id", _vec_text_spark().alias("txt"))
    p = V.parse_vector(e, "txt", DIM, out="v")
    vsum = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    return out(p.select("vec_id", F.size("v").cast("int").alias("n"), F.col("v")[0].alias("v0"), vsum.alias("v_sum")), _V1)


# ------------------------------------------------------------------ V4 V5 V6 V8 (vector form)

def _vec_cos_sql():
    g0 = ", ".join(f"coalesce(iv.genre_dim_{i}, 0.0) AS g{i}" for i in range(DIM))
    cen = ", ".join(f"avg(g{i}) AS c{i}" for i in range(DIM))
    cos = S.cosine([f"g{i}" for i in range(DIM)], [f"c{i}" for i in range(DIM)])
    return S.base(iv_sql(), f"ci AS (SELECT cand.set_id, cand.item_id, {g0} FROM cand LEFT JOIN iv USING (item_id))",
                  f"si AS (SELECT sd.set_id, {g0} FROM sd LEFT JOIN iv USING (item_id))",
                  f"c AS (SELECT set_id, {cen} FROM si GROUP BY set_id)") + \
        f"SELECT set_id, item_id, round({cos}, 6) AS vec_cosine FROM ci JOIN c USING (set_id)"


@register("vector_cosine", _vec_cos_sql())
def vector_cosine(spark, d):
    """V4 missing vector → zeros, V6 seed centroid vector, V8 cosine of each candidate's
    pooled vector to it (array expressions, no per-dimension columns)."""
    cand, sd = candidates(spark, d, vectors=True)
    zero = X.zeros(DIM)
    ci = with_vectors(cand, spark, d, expand=False).withColumn("vec", F.coalesce("vec", zero))
    si = with_vectors(sd, spark, d, expand=False).withColumn("vec", F.coalesce("vec", zero))
    cen = V.mean_pool(si.select("set_id", "vec"), ["set_id"], "vec", DIM, out="cvec")
    res = attach(ci.select("set_id", "item_id", "vec"), cen, "set_id")
    return out(res.select("set_id", "item_id", X.array_cosine("vec", "cvec").alias("vec_cosine")),
               ["set_id", "item_id", "vec_cosine"])


# ------------------------------------------------------------------ M1 (deterministic) + V5 + C10 + C14

ALL_F = FEATURES + GENRE


def _simfilter_sql(threshold: float | None = 0.6):
    full = " AND ".join(f"{f} IS NOT NULL" for f in ALL_F)
    st = ", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in ALL_F)
    cen = ", ".join(f"avg({f}) AS {f}" for f in ALL_F)
    zs = ", ".join(f"({f} - m_{f}) / {S.std1('s_' + f)} AS z_{f}" for f in ALL_F)
    ts = ", ".join(f"(c.{f} - m_{f}) / {S.std1('s_' + f)} AS t_{f}" for f in ALL_F)
    cos = S.cosine([f"z_{f}" for f in ALL_F], [f"t_{f}" for f in ALL_F])
    return S.base(
        iv_sql(),
        f"ci AS (SELECT * FROM (SELECT cand.*, iv.* EXCLUDE (item_id) FROM cand LEFT JOIN iv USING (item_id)) WHERE {full})",
        f"si AS (SELECT * FROM (SELECT sd.*, iv.* EXCLUDE (item_id) FROM sd LEFT JOIN iv USING (item_id)) WHERE {full})",
        f"st AS (SELECT set_id, {st} FROM ci GROUP BY set_id)",
        f"cen AS (SELECT set_id, {cen} FROM si GROUP BY set_id)",
        f"t AS (SELECT c.set_id, {ts} FROM cen c JOIN st USING (set_id))",
        f"z AS (SELECT ci.set_id, ci.item_id, {zs} FROM ci JOIN st USING (set_id))",
        f"s AS (SELECT set_id, item_id, {cos} AS similarity_score FROM z JOIN t USING (set_id))",
    ) + "SELECT set_id, item_id, round(similarity_score, 6) AS similarity_score FROM s" + (
        f" WHERE similarity_score >= {threshold}" if threshold is not None else "")


def sim_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Candidates and seeds with x = [6 features..., 64 pooled vector dims] (NULL vector for
    orders without lines, so such rows are not complete)."""
    cand, sd = candidates(spark, d, vectors=True)

    def x(df):
        j = with_vectors(df, spark, d, expand=False)
        return j.withColumn("x", F.when(F.col("vec").isNotNull(),
                                        F.concat(F.array(*[F.col(f).cast("double") for f in FEATURES]), F.col("vec"))))
    return x(cand), x(sd)


@register("similarity_filter", _simfilter_sql())
def similarity_filter(spark, d):
    """M1 target: complete rows (C10) of 6 features + 64 vector dims (V5), scaler on the
    candidates, cosine to the seed centroid; keep similarity ≥ 0.60 (C14)."""
    ci, si = sim_inputs(spark, d)
    r = M.similarity_filter(ci, si, "x", len(ALL_F), threshold=0.60, filter_on="similarity")
    return out(r, ["set_id", "item_id", "similarity_score"])


@register("similarity_scores", _simfilter_sql(None))
def similarity_scores(spark, d):
    """M1 target before the threshold: the similarity of every complete candidate (V5, C10,
    V6, V7 on the candidates, V8)."""
    ci, si = sim_inputs(spark, d)
    r = M.similarity_filter(ci, si, "x", len(ALL_F), threshold=None)
    return out(r, ["set_id", "item_id", "similarity_score"])


@register("similarity_model")
def similarity_model(spark, d):
    """M1 fitted: a boosted-tree regressor reproduces the similarity; keep fit ≥ 0.60."""
    ci, si = sim_inputs(spark, d)
    r = M.similarity_filter(ci, si, "x", len(ALL_F), threshold=0.60, filter_on="model", keep=["set_id", "item_id"])
    return out(r, ["set_id", "item_id", "similarity_score", "fit_probability"])


# ------------------------------------------------------------------ M2

RIDGE_2F = ["f_price", "f_qty"]


def _ridge2_sql():
    return S.base(
        "mi AS (SELECT set_id, avg(f_price) AS a1, avg(f_qty) AS a2 FROM cand GROUP BY set_id)",
        "ci AS (SELECT set_id, item_id, coalesce(coalesce(f_price, a1), 0.0) AS x1, coalesce(coalesce(f_qty, a2), 0.0) AS x2 "
        "FROM cand JOIN mi USING (set_id))",
        "cs AS (SELECT set_id, coalesce(f_price, 0.0) AS x1, coalesce(f_qty, 0.0) AS x2 FROM sd)",
        "bo AS (SELECT set_id, x1, x2, 0.0 AS y FROM ci UNION ALL SELECT set_id, x1, x2, 1.0 AS y FROM cs)",
        "st AS (SELECT set_id, avg(x1) AS m1, stddev_pop(x1) AS s1, avg(x2) AS m2, stddev_pop(x2) AS s2 FROM bo GROUP BY set_id)",
        f"zb AS (SELECT set_id, (x1 - m1) / {S.std1('s1')} AS z1, (x2 - m2) / {S.std1('s2')} AS z2, y FROM bo JOIN st USING (set_id))",
        "su AS (SELECT set_id, CAST(count(*) AS DOUBLE) AS n, sum(y) AS sy, sum(z1) AS sx1, sum(z2) AS sx2, sum(z1 * y) AS xy1, "
        "sum(z2 * y) AS xy2, sum(z1 * z1) AS g11, sum(z1 * z2) AS g12, sum(z2 * z2) AS g22 FROM zb GROUP BY set_id)",
        "co AS (SELECT set_id, sy / n AS ybar, sx1 / n AS xb1, sx2 / n AS xb2, g11 - n * (sx1 / n) * (sx1 / n) + 1.0 AS a11, "
        "g12 - n * (sx1 / n) * (sx2 / n) AS a12, g22 - n * (sx2 / n) * (sx2 / n) + 1.0 AS a22, xy1 - n * (sx1 / n) * (sy / n) AS b1, "
        "xy2 - n * (sx2 / n) * (sy / n) AS b2 FROM su)",
        "w AS (SELECT set_id, ybar, xb1, xb2, (b1 * a22 - a12 * b2) / (a11 * a22 - a12 * a12) AS w1, "
        "(a11 * b2 - a12 * b1) / (a11 * a22 - a12 * a12) AS w2 FROM co)",
        f"pr AS (SELECT ci.set_id, ci.item_id, (ybar - (xb1 * w1 + xb2 * w2)) + w1 * ((x1 - m1) / {S.std1('s1')}) "
        f"+ w2 * ((x2 - m2) / {S.std1('s2')}) AS ridge_fitness FROM ci JOIN st USING (set_id) JOIN w USING (set_id))",
        "mm AS (SELECT set_id, min(ridge_fitness) AS lo, max(ridge_fitness) AS hi FROM pr GROUP BY set_id)",
    ) + ("SELECT set_id, item_id, round(ridge_fitness, 6) AS ridge_fitness, round(CASE WHEN hi > lo THEN (ridge_fitness - lo) "
         "/ (hi - lo) * 100.0 ELSE 50.0 END, 6) AS ridge_score FROM pr JOIN mm USING (set_id)")


@register("ridge_score_2f", _ridge2_sql())
def ridge_score_2f(spark, d):
    """M2 on two features (closed form in the oracle by Cramer's rule)."""
    cand, sd = candidates(spark, d)
    r = M.ridge_score(cand, sd, RIDGE_2F)
    return out(r, ["set_id", "item_id", "ridge_fitness", "ridge_score"])


def ridge_ctes(features) -> list[str]:
    """M2 for p features: sufficient statistics per set, the centred normal equations, and an
    unrolled Gaussian elimination (the matrix is symmetric positive definite) per set."""
    p = len(features)
    fx = [f"x{i}" for i in range(p)]
    means = ", ".join(f"avg({f}) AS a{i}" for i, f in enumerate(features))
    ci = ", ".join(f"coalesce(coalesce({f}, a{i}), 0.0) AS x{i}" for i, f in enumerate(features))
    cs = ", ".join(f"coalesce({f}, 0.0) AS x{i}" for i, f in enumerate(features))
    xl = ", ".join(fx)
    st = ", ".join(f"avg(x{i}) AS m{i}, stddev_pop(x{i}) AS s{i}" for i in range(p))
    zs = ", ".join(f"(x{i} - m{i}) / {S.std1(f's{i}')} AS z{i}" for i in range(p))
    su = ", ".join(["CAST(count(*) AS DOUBLE) AS n", "sum(y) AS sy"] + [f"sum(z{i}) AS sx{i}" for i in range(p)]
                   + [f"sum(z{i} * y) AS xy{i}" for i in range(p)]
                   + [f"sum(z{i} * z{j}) AS g{i}_{j}" for i in range(p) for j in range(i, p)])
    g = lambda i, j: f"g{min(i, j)}_{max(i, j)}"
    co = ", ".join([f"sy / n AS ybar"] + [f"sx{i} / n AS xb{i}" for i in range(p)]
                   + [f"{g(i, j)} - n * (sx{i} / n) * (sx{j} / n){' + 1.0' if i == j else ''} AS a{i}_{j}"
                      for i in range(p) for j in range(p)]
                   + [f"xy{i} - n * (sx{i} / n) * (sy / n) AS b{i}" for i in range(p)])
    ctes = [
        f"mi AS (SELECT set_id, {means} FROM cand GROUP BY set_id)",
        f"ci AS (SELECT set_id, item_id, {ci} FROM cand JOIN mi USING (set_id))",
        f"cs AS (SELECT set_id, {cs} FROM sd)",
        f"bo AS (SELECT set_id, {xl}, 0.0 AS y FROM ci UNION ALL SELECT set_id, {xl}, 1.0 AS y FROM cs)",
        f"st AS (SELECT set_id, {st} FROM bo GROUP BY set_id)",
        f"zb AS (SELECT set_id, {zs}, y FROM bo JOIN st USING (set_id))",
        f"su AS (SELECT set_id, {su} FROM zb GROUP BY set_id)",
        f"e0 AS (SELECT set_id, {co} FROM su)",
    ]
    keep = ["ybar"] + [f"xb{i}" for i in range(p)]
    for k in range(p - 1):
        cols = list(keep)
        for i in range(p):
            for j in range(p):
                if i > k and j > k:
                    cols.append(f"a{i}_{j} - a{i}_{k} / a{k}_{k} * a{k}_{j} AS a{i}_{j}")
                else:
                    cols.append(f"a{i}_{j}")
        for i in range(p):
            cols.append(f"b{i} - a{i}_{k} / a{k}_{k} * b{k} AS b{i}" if i > k else f"b{i}")
        ctes.append(f"e{k + 1} AS (SELECT set_id, {', '.join(cols)} FROM e{k})")
    last = f"e{p - 1}"
    ws = {}
    for i in reversed(range(p)):
        rest = " - ".join([f"b{i}"] + [f"a{i}_{j} * ({ws[j]})" for j in range(i + 1, p)])
        ws[i] = f"({rest}) / a{i}_{i}"
    wcols = ", ".join(["set_id", "ybar"] + [f"xb{i}" for i in range(p)] + [f"{ws[i]} AS w{i}" for i in range(p)])
    ctes.append(f"w AS (SELECT {wcols} FROM {last})")
    icpt = "ybar - (" + " + ".join(f"xb{i} * w{i}" for i in range(p)) + ")"
    pred = " + ".join([f"({icpt})"] + [f"w{i} * ((x{i} - m{i}) / {S.std1(f's{i}')})" for i in range(p)])
    ctes.append(f"pr AS (SELECT ci.set_id, ci.item_id, {pred} AS ridge_fitness FROM ci JOIN st USING (set_id) JOIN w USING (set_id))")
    ctes.append("mm AS (SELECT set_id, min(ridge_fitness) AS lo, max(ridge_fitness) AS hi FROM pr GROUP BY set_id)")
    return ctes


def _ridge_sql(features):
    return S.base(*ridge_ctes(features)) + ("SELECT set_id, item_id, round(ridge_fitness, 6) AS ridge_fitness, round(CASE WHEN hi > lo "
                                            "THEN (ridge_fitness - lo) / (hi - lo) * 100.0 ELSE 50.0 END, 6) AS ridge_score FROM pr JOIN mm USING (set_id)")


@register("ridge_score", _ridge_sql(FEATURES))
def ridge_score(spark, d):
    """M2 on all six features (oracle: the same normal equations solved by elimination in SQL;
    also checked against a NumPy closed form in the tests)."""
    cand, sd = candidates(spark, d)
    return out(M.ridge_score(cand, sd, FEATURES), ["set_id", "item_id", "ridge_fitness", "ridge_score"])


# ------------------------------------------------------------------ M3

@register("cosine_score", S.base(*S.cosine_score_ctes("cand", "sd", FEATURES, "cos"))
          + "SELECT set_id, item_id, round(cosine_similarity, 6) AS cosine_similarity, round(cosine_score, 6) AS cosine_score FROM cos")
def cosine_score(spark, d):
    """M3: V6 centroid, V7 scaler on items + centroid, V8 cosine, V9 min-max (flat → 50)."""
    cand, sd = candidates(spark, d)
    return out(M.cosine_score(cand, sd, FEATURES), ["set_id", "item_id", "cosine_similarity", "cosine_score"])


# ------------------------------------------------------------------ V10

@register("rescale_scores", S.base(
    *S.cosine_score_ctes("cand", "sd", FEATURES, "cos"),
    "mm AS (SELECT set_id, min(cosine_similarity) AS lo, max(cosine_similarity) AS hi FROM cos GROUP BY set_id)")
    + "SELECT set_id, item_id, round(CASE WHEN hi > 100 OR lo < 0 OR hi - lo < 0.01 THEN (CASE WHEN hi > lo THEN "
      "(cosine_similarity - lo) / (hi - lo) * 100.0 ELSE 0.0 END) ELSE cosine_similarity END, 6) AS rescaled FROM cos JOIN mm USING (set_id)")
def rescale_scores(spark, d):
    """A score outside 0..100 (here the raw cosine, −1..1) is re-scaled per set."""
    cand, sd = candidates(spark, d)
    c = M.cosine_score(cand, sd, FEATURES).select("set_id", "item_id", F.col("cosine_similarity").alias("rescaled"))
    return out(V.rescale_if_needed(c, "rescaled"), ["set_id", "item_id", "rescaled"])


# ------------------------------------------------------------------ M6 M7

ROLES = {"owner": "owner", "album": "album", "label": "label", "date": "year_text"}


#: fixed values, written out for the check: weights of the metadata roles, and copies of each score
_ROLE_WEIGHTS = {"owner": 0.5, "album": 0.2, "label": 0.2, "date": 0.1}
_COPIES = {"cosine_score": 7.0, "match_score": 1.0, "cluster_score": 1.0}


def _match_sql():
    total = sum(_ROLE_WEIGHTS[r] for r in ROLES)
    flags = ", ".join(f"CASE WHEN EXISTS (SELECT 1 FROM s2 WHERE s2.set_id = c2.set_id AND s2.{c} = c2.{c}) THEN 1 ELSE 0 END "
                      f"AS {c}_in_seeds" for c in ROLES.values())
    num = " + ".join(["0.0"] + [f"CAST({_ROLE_WEIGHTS[r]!r} AS DOUBLE) * {c}_in_seeds" for r, c in ROLES.items()])
    return S.base(
        "c2 AS (SELECT *, CAST(release_year AS VARCHAR) AS year_text FROM cand)",
        "s2 AS (SELECT *, CAST(release_year AS VARCHAR) AS year_text FROM sd)",
        f"f AS (SELECT set_id, item_id, {flags} FROM c2)",
    ) + (f"SELECT set_id, item_id, {', '.join(c + '_in_seeds' for c in ROLES.values())}, "
         f"round(({num}) / CAST({total!r} AS DOUBLE), 6) AS match_score FROM f")


@register("metadata_match", _match_sql())
def metadata_match(spark, d):
    """M6 in-seed flags per category, M7 weighted match score."""
    cand, sd = candidates(spark, d)
    c2 = cand.withColumn("year_text", F.col("release_year").cast("string"))
    s2 = sd.withColumn("year_text", F.col("release_year").cast("string"))
    m = M.metadata_match(c2, s2, ROLES)
    return out(m, ["set_id", "item_id", *[f"{c}_in_seeds" for c in ROLES.values()], "match_score"])


@register("metadata_glm")
def metadata_glm(spark, d):
    """M4 logistic GLM on metadata (M5 one-hot, C16 unseen, M6 flags, D6 seed weight 5)."""
    cand, sd = candidates(spark, d)
    g = M.metadata_glm(cand, sd, ["f_price", "f_lines"], ["owner", "album", "label", "release_date"])
    return out(g.select("set_id", "item_id", "glm_score"), ["set_id", "item_id", "glm_score"])


# ------------------------------------------------------------------ M10 M11 M12 (given centroids)

def seed_scaled(spark: SparkSession, d: str):
    return seed_scaled_frames(*candidates(spark, d))


def given_centers(sd: DataFrame) -> DataFrame:
    """(set_id, idx, center): the mean of the seed-scaled features per release year of the seeds."""
    from seedrank.plans.pipeline import seed_scaler, with_zvec

    sz = with_zvec(sd, seed_scaler(sd, FEATURES), FEATURES)
    cen = sz.groupBy("set_id", "release_year").agg(F.array(*[F.avg(F.col("zvec")[i]) for i in range(len(FEATURES))]).alias("center"))
    return cen.select("set_id", (F.dense_rank().over(Window.partitionBy("set_id").orderBy("release_year")) - 1).alias("idx"), "center")


def seed_scaled_frames(cand: DataFrame, sd: DataFrame):
    """Candidates and seeds with the seed-scaled features as ``zvec``, and the per-(set, year) seed centroids."""
    from seedrank.plans.pipeline import seed_scaled as scaled

    return (*scaled(cand, sd, FEATURES), given_centers(sd))


def clusters(spark: SparkSession, d: str):
    return clusters_frames(*candidates(spark, d))


def clusters_frames(cand: DataFrame, sd: DataFrame):
    """(candidates, seeds) each with their nearest given centroid."""
    cz, sz, cen = seed_scaled_frames(cand, sd)
    return K.assign_clusters(cz, cen, "zvec"), K.assign_clusters(sz, cen, "zvec")


def _cluster_sql_ctes():
    f0 = ", ".join(f"coalesce({f}, 0.0) AS {f}" for f in FEATURES)
    st = ", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in FEATURES)
    zs = ", ".join(f"({f} - m_{f}) / {S.std1('s_' + f)} AS z_{f}" for f in FEATURES)
    cen = ", ".join(f"avg(z_{f}) AS c_{f}" for f in FEATURES)
    d2 = " + ".join(f"(z_{f} - c_{f}) * (z_{f} - c_{f})" for f in FEATURES)
    return [
        f"s0 AS (SELECT set_id, item_id, release_year, {f0} FROM sd)",
        f"c0 AS (SELECT set_id, item_id, release_year, {f0} FROM cand)",
        f"st AS (SELECT set_id, {st} FROM s0 GROUP BY set_id)",
        f"sz AS (SELECT s0.set_id, s0.item_id, s0.release_year, {zs} FROM s0 JOIN st USING (set_id))",
        f"cz AS (SELECT c0.set_id, c0.item_id, c0.release_year, {zs} FROM c0 JOIN st USING (set_id))",
        f"cy AS (SELECT set_id, release_year, {cen} FROM sz GROUP BY set_id, release_year)",
        "ce AS (SELECT *, dense_rank() OVER (PARTITION BY set_id ORDER BY release_year) - 1 AS idx FROM cy)",
        f"ds AS (SELECT sz.set_id, sz.item_id, ce.idx, {d2} AS d2 FROM sz JOIN ce USING (set_id))",
        f"dc AS (SELECT cz.set_id, cz.item_id, ce.idx, {d2} AS d2 FROM cz JOIN ce USING (set_id))",
        "sa AS (SELECT set_id, item_id, chr(CAST(65 + idx AS INTEGER)) AS cluster, d2 FROM (SELECT *, row_number() OVER "
        "(PARTITION BY set_id, item_id ORDER BY d2, idx) AS rn FROM ds) WHERE rn = 1)",
        "ca AS (SELECT set_id, item_id, chr(CAST(65 + idx AS INTEGER)) AS cluster, d2 FROM (SELECT *, row_number() OVER "
        "(PARTITION BY set_id, item_id ORDER BY d2, idx) AS rn FROM dc) WHERE rn = 1)",
        "sh AS (SELECT set_id, cluster, count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY set_id) AS share FROM sa GROUP BY set_id, cluster)",
    ]


CLUSTER_CTES = _cluster_sql_ctes()


@register("assign_clusters", S.base(*CLUSTER_CTES) + "SELECT ca.set_id, ca.item_id, ca.cluster, round(ca.d2, 6) AS cluster_d2, "
          "round(coalesce(sh.share, 0.0), 6) AS cluster_score FROM ca LEFT JOIN sh USING (set_id, cluster)")
def assign_clusters(spark, d):
    """M10 nearest of the given centroids (seed means per release year, seed-scaled
    features), M12 cluster score = share of the set's seeds in the item's cluster."""
    ca, sa = clusters(spark, d)
    sc = K.cluster_score(ca, sa)
    return out(sc, ["set_id", "item_id", "cluster", "cluster_d2", "cluster_score"])


@register("cluster_wcss", S.base(*CLUSTER_CTES) + "SELECT set_id, round(sum(d2), 6) AS wcss FROM sa GROUP BY set_id")
def cluster_wcss(spark, d):
    """Within-cluster sum of squares of the seeds."""
    _, sa = clusters(spark, d)
    return out(K.wcss(sa), ["set_id", "wcss"])


@register("elbow_kmeans")
def elbow_kmeans(spark, d):
    """M8 K-means for k = 1..10 on every seed set at once, M9 knee → optimal k."""
    _, sz, _ = seed_scaled(spark, d)
    centers, cost = K.kmeans_multi(sz, "zvec", "item_id", len(FEATURES))
    kn = K.knee(cost)
    return out(cost.join(kn, "set_id"), ["set_id", "k", "wcss", "optimal_k"])


# ------------------------------------------------------------------ M13 M14 M15

def blend_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    cand, sd = candidates(spark, d)
    sc = M.cosine_score(cand, sd, FEATURES)
    sc = M.metadata_match(sc, sd, {"owner": "owner", "album": "album", "label": "label"})
    sc = sc.withColumn("has_match", (F.col("match_score") > 0).cast("double"))
    ca, sa = clusters_frames(cand, sd)
    from seedrank.operators.cluster import cluster_score
    cs = cluster_score(ca.select("set_id", "item_id", "cluster"), sa).select("set_id", "item_id", "cluster_score")
    return sc.join(cs, ["set_id", "item_id"]), sd


def _blend_sql():
    roles = {"owner": "owner", "album": "album", "label": "label"}
    total = sum(_ROLE_WEIGHTS[r] for r in roles)
    flags = ", ".join(f"CASE WHEN EXISTS (SELECT 1 FROM sd WHERE sd.set_id = cos.set_id AND sd.{c} = cos.{c}) THEN 1 ELSE 0 END "
                      f"AS {c}_in_seeds" for c in roles.values())
    num = " + ".join(["0.0"] + [f"CAST({_ROLE_WEIGHTS[r]!r} AS DOUBLE) * {c}_in_seeds" for r, c in roles.items()])
    scores = ["cosine_score", "match_score", "cluster_score"]
    cols = FEATURES + ["has_match"] + scores
    w = [1.0] * (len(FEATURES) + 1) + [_COPIES[x] for x in scores]
    z0 = ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in cols)
    means = ", ".join(f"avg({c}) AS {c}" for c in scores)
    sd0 = ", ".join([f"coalesce(sd.{f}, 0.0) AS {f}" for f in FEATURES] + ["1.0 AS has_match"] + [f"mn.{c} AS {c}" for c in scores])
    st = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in cols)
    zs = ", ".join(f"({c} - m_{c}) / {S.std1('s_' + c)} AS z_{c}" for c in cols)
    tg = ", ".join(f"avg(z_{c}) AS t_{c}" for c in cols)
    cos = S.cosine([f"z_{c}" for c in cols], [f"t_{c}" for c in cols], w)
    return S.base(
        *S.cosine_score_ctes("cand", "sd", FEATURES, "cos"), *CLUSTER_CTES,
        f"mf AS (SELECT cos.*, {flags} FROM cos)",
        f"m AS (SELECT *, ({num}) / CAST({total!r} AS DOUBLE) AS match_score FROM mf)",
        "x AS (SELECT m.*, CAST(m.match_score > 0 AS DOUBLE) AS has_match, coalesce(sh.share, 0.0) AS cluster_score "
        "FROM m JOIN ca USING (set_id, item_id) LEFT JOIN sh ON sh.set_id = ca.set_id AND sh.cluster = ca.cluster)",
        f"it0 AS (SELECT set_id, item_id, {z0} FROM x)",
        f"mn AS (SELECT set_id, {means} FROM it0 GROUP BY set_id)",
        f"sd0 AS (SELECT sd.set_id, {sd0} FROM sd JOIN mn USING (set_id))",
        f"fit AS (SELECT set_id, {', '.join(cols)} FROM it0 UNION ALL SELECT set_id, {', '.join(cols)} FROM sd0)",
        f"bst AS (SELECT set_id, {st} FROM fit GROUP BY set_id)",
        f"zsd AS (SELECT sd0.set_id, {zs} FROM sd0 JOIN bst USING (set_id))",
        f"tgt AS (SELECT set_id, {tg} FROM zsd GROUP BY set_id)",
        f"zi AS (SELECT it0.set_id, it0.item_id, {zs} FROM it0 JOIN bst USING (set_id))",
    ) + f"SELECT set_id, item_id, round({cos}, 6) AS blend_similarity FROM zi JOIN tgt USING (set_id)"


@register("blended_similarity", _blend_sql())
def blended_similarity(spark, d):
    """M13 emphasised inputs (cosine ×7, match ×1, cluster ×1, metadata flag), M14 cosine to
    the mean scaled seed vector (the learned blend's target)."""
    sc, sd = blend_inputs(spark, d)
    b = M.blended_similarity(sc, sd, FEATURES, ["cosine_score", "match_score", "cluster_score"], flag="has_match")
    return out(b, ["set_id", "item_id", "blend_similarity"])


@register("learned_blend")
def learned_blend(spark, d):
    """Boosted trees learn the blended similarity; prediction scaled per set = nn_score."""
    sc, sd = blend_inputs(spark, d)
    b = M.blended_similarity(sc, sd, FEATURES, ["cosine_score", "match_score", "cluster_score"], flag="has_match")
    nn = M.learned_blend(b, FEATURES + ["has_match", "cosine_score", "match_score", "cluster_score"])
    return out(nn, ["set_id", "item_id", "blend_similarity", "nn_score"])


# ------------------------------------------------------------------ M1, M15, M8: what a fit must satisfy

@register("boosted_invariants", _simfilter_sql(None).replace(
    "SELECT set_id, item_id, round(similarity_score, 6) AS similarity_score FROM s", "SELECT set_id, count(*) AS rows, TRUE AS follows FROM s GROUP BY set_id"))
def boosted_invariants(spark, d):
    """M1 fitted: a prediction for every complete candidate of every set, correlated 0.9 or more with the similarity."""
    ci, si = sim_inputs(spark, d)
    r = M.similarity_filter(ci, si, "x", len(ALL_F), threshold=None, filter_on="model", keep=["set_id", "item_id"])
    return r.groupBy("set_id").agg(F.count("fit_probability").alias("rows"), (F.corr("similarity_score", "fit_probability") >= 0.9).alias("follows"))


@register("blend_invariants", S.base("n AS (SELECT set_id, count(*) AS rows FROM cand GROUP BY set_id)") + "SELECT set_id, rows, TRUE AS follows, 0.0::DOUBLE AS lo, 100.0::DOUBLE AS hi FROM n")
def blend_invariants(spark, d):
    """A score for every candidate, correlated 0.9 or more with the blended similarity, from 0 to 100 in every set."""
    nn = learned_blend(spark, d)
    return nn.groupBy("set_id").agg(F.count("nn_score").alias("rows"), (F.corr("blend_similarity", "nn_score") >= 0.9).alias("follows"),
                                    F.round(F.min("nn_score"), 6).alias("lo"), F.round(F.max("nn_score"), 6).alias("hi"))


@register("kmeans_invariants", S.base(
    *CLUSTER_CTES[:4], "p AS (SELECT set_id, count(DISTINCT (" + ", ".join(f"z_{f}" for f in FEATURES) + ")) AS points FROM sz GROUP BY set_id)",
    "t AS (SELECT set_id, " + " + ".join(f"var_pop(z_{f}) * count(*)" for f in FEATURES) + " AS tss FROM sz GROUP BY set_id)")
    + "SELECT set_id, CAST(10 AS BIGINT) AS fits, round(tss, 4) AS wcss_1, TRUE AS settled, TRUE AS lower, least(points, 10) AS most_centers FROM t JOIN p USING (set_id)")
def kmeans_invariants(spark, d):
    """M8: ten fits a set, all settled; one cluster costs the total sum of squares, no fit costs more; as many centres as asked where
    there are points for them."""
    _, sz, _ = seed_scaled(spark, d)
    centers, cost = K.kmeans_multi(sz, "zvec", "item_id", len(FEATURES))
    most = centers.where(F.col("k") == 10).groupBy("set_id").agg(F.count(F.lit(1)).alias("most_centers"))
    one = F.max(F.when(F.col("k") == 1, F.col("wcss")))
    c = cost.groupBy("set_id").agg(F.count(F.lit(1)).alias("fits"), F.round(one, 4).alias("wcss_1"), F.bool_and("converged").alias("settled"),
                                   (F.max("wcss") <= one + 1e-9).alias("lower"))
    return c.join(most, "set_id").select("set_id", "fits", "wcss_1", "settled", "lower", "most_centers")


# ------------------------------------------------------------------ V11

def _pca_sql(source: str, features, min_rows: int) -> str:
    """Two components per set: the covariance matrix squared again and again turns to its leading direction, which is then
    taken out; signs by the entry of largest size."""
    p, n = len(features), range(len(features))
    g = lambda m, i, j: f"{m}{min(i, j)}_{max(i, j)}"
    pairs = [(i, j) for i in n for j in range(i, p)]
    full = " AND ".join(f"{f} IS NOT NULL" for f in features)
    ctes = [f"r AS MATERIALIZED (SELECT set_id, item_id, {', '.join(f'CAST({f} AS DOUBLE) AS x{i}' for i, f in enumerate(features))} FROM {source} WHERE {full})",
            f"c AS MATERIALIZED (SELECT set_id, {', '.join(f'avg(x{i}) AS mu{i}' for i in n)}, {', '.join(f'covar_pop(x{i}, x{j}) AS a{i}_{j}' for i, j in pairs)} "
            f"FROM r GROUP BY set_id HAVING count(*) > {min_rows})"]

    def leading(name, src, m):
        """Direction of the largest eigenvalue of ``m`` in ``src``, as ``v{name}{i}`` with its value ``l{name}``."""
        at = f"q{name}0"
        trace = " + ".join(g(m, i, i) for i in n)
        ctes.append(f"{at} AS MATERIALIZED (SELECT set_id, {', '.join(f'{g(m, i, j)} / ({trace}) AS b{i}_{j}' for i, j in pairs)} FROM {src})")
        for k in range(1, 13):
            square = {(i, j): " + ".join(f"{g('b', i, t)} * {g('b', t, j)}" for t in n) for i, j in pairs}
            tr = " + ".join(f"({square[i, i]})" for i in n)
            ctes.append(f"q{name}{k} AS MATERIALIZED (SELECT set_id, {', '.join(f'({square[i, j]}) / ({tr}) AS b{i}_{j}' for i, j in pairs)} FROM q{name}{k - 1})")
        # a rank-one matrix: its longest column, of unit length, its largest entry positive
        size = ", ".join(f"b{i}_{i}" for i in n)
        pick = lambda i: "CASE " + " ".join(f"WHEN b{t}_{t} = greatest({size}) THEN {g('b', i, t)} / sqrt(b{t}_{t})" for t in n) + " END"
        ctes.append(f"d{name} AS MATERIALIZED (SELECT set_id, {', '.join(f'{pick(i)} AS u{i}' for i in n)} FROM q{name}12)")
        norm = "sqrt(" + " + ".join(f"u{i} * u{i}" for i in n) + ")"
        ctes.append(f"e{name} AS MATERIALIZED (SELECT set_id, {', '.join(f'u{i} / {norm} AS v{name}{i}' for i in n)} FROM d{name})")

    leading("1", "c", "a")
    lam = lambda s: " + ".join(f"v{s}{i} * v{s}{j} * {g('a', i, j)}" for i in n for j in n)
    ctes.append(f"c2 AS MATERIALIZED (SELECT c.set_id, {', '.join(f'a{i}_{j} - v1{i} * v1{j} * ({lam(1)}) AS h{i}_{j}' for i, j in pairs)} FROM c JOIN e1 USING (set_id))")
    leading("2", "c2", "h")
    on = lambda s: " + ".join(f"(x{i} - mu{i}) * v{s}{i}" for i in n)
    trace = " + ".join(g("a", i, i) for i in n)
    return S.base(*ctes) + (f"SELECT set_id, item_id, round({on(1)}, 1) AS pc1, round({on(2)}, 1) AS pc2, round(({lam(1)}) / ({trace}), 6) AS explained1, "
                            f"round(({lam(2)}) / ({trace}), 6) AS explained2 FROM r JOIN c USING (set_id) JOIN e1 USING (set_id) JOIN e2 USING (set_id)")


_PCA = ["set_id", "item_id", "pc1", "pc2", "explained1", "explained2"]


@register("pca_2d", _pca_sql("cand", FEATURES, 10))
def pca_2d(spark, d):
    """V11, catalogue view: every set's complete candidates on its own two principal components, and their shares of the variance."""
    cand, _ = candidates(spark, d)
    p = V.pca_2d(cand, FEATURES, ["set_id", "item_id"])
    return out(p.withColumns({c: F.round(c, 1) for c in ("pc1", "pc2")}), _PCA)


@register("pca_seeds", _pca_sql("sd", FEATURES[:4], 5))
def pca_seeds(spark, d):
    """V11, seed view: fewer features, sets of more than 5 seeds."""
    _, sd = candidates(spark, d)
    p = V.pca_2d(sd, FEATURES[:4], ["set_id", "item_id"], min_rows=5)
    return out(p.withColumns({c: F.round(c, 1) for c in ("pc1", "pc2")}), _PCA)
