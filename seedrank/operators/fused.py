"""Fused statistics of the scoring chain (R10): the models' parameters from few passes over the candidates.

Ridge (M2), cosine (M3), metadata match (M7), clusters (M12), re-scaling (V10) and the blended similarity (M13, M14)
need means, deviations, cross products and ranges of the same columns, under two rules for missing
values. Three grouped aggregates serve them all:

1. ``item_sums``: sums of the cross products of (1, x - c, missing) over the features, where c is the set's seed
   mean (a shift known beforehand keeps the sums small), sums and squares of the vector's entries, and ranges. What each
   model imputes is linear in these columns, so every model's moments follow from the one matrix. ``first_fit`` derives them:
   one small system per set.
2. ``score_sums``: ranges and moments of the scores that are not linear in the features, per (set, cluster).
   ``second_fit`` derives the affine re-scalings and the blend's scaler.
3. the range of the blended similarity, per set.

The scores are column expressions over those parameters (``raw_scores``, ``blend``), one row per set each, in columns whose names begin with two
underscores, so that a table's own names do not meet them."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedrank.functions import exprs as X
from seedrank.functions.params import attach
from seedrank.operators import vectors as V

D = "array<double>"
#: per set: seed means and deviations, and what ``first_fit`` derives
FIRST = ("__n double, __n_seeds double, __fill array<double>, __ridge_b double, __ridge_w array<double>, __ridge_mu array<double>, "
         "__cos_mu array<double>, __cos_sd array<double>, __cos_t array<double>, __nn_mu array<double>, __nn_sd array<double>, __nn_t array<double>, "
         "__vec_mu array<double>, __vec_sd array<double>, __vec_t array<double>, __p_lo double, __p_hi double")
#: per set: re-scalings as (multiplier, offset), and the blend's scaler
SECOND = ("__cosine_a double, __cosine_b double, __ridge_a double, __ridge_b2 double, __share map<string,double>, __cluster_num map<string,double>, "
          "__cluster_sq map<string,double>, __match_mu double, __match_sd double, __match_t double, __score_mu array<double>, __score_sd array<double>, __t_norm double")


def seed_sums(seeds: DataFrame, features: Sequence[str], key: str, vec: str | None, dim: int) -> DataFrame:
    """(key, __n_seeds, __c, __s, __vec_c, __vec_s): seed means and sums of squared deviations (cross products for the features)."""
    p, x = len(features), [F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]
    n = F.count(F.lit(1)).cast("double")
    aggs = [n.alias("__n_seeds"), F.array(*[F.avg(v) for v in x]).alias("__c"),
            F.array(*[F.covar_pop(x[i], x[j]) * n for i in range(p) for j in range(i, p)]).alias("__s")]
    out = seeds.groupBy(key).agg(*aggs)
    if not vec:
        return out.withColumns({"__vec_c": F.array().cast(D), "__vec_s": F.array().cast(D)})
    v = F.coalesce(F.col(vec), X.zeros(dim))
    sq = V.array_sums(seeds.select(key, F.concat(v, F.transform(v, lambda e: e * e)).alias("__v")), [key], "__v", 2 * dim, "__t")
    n, s1, s2 = F.col("__n_seeds"), F.slice("__t", 1, dim), F.slice("__t", dim + 1, dim)
    return out.join(sq, key).select(key, "__n_seeds", "__c", "__s", F.transform(s1, lambda e: e / n).alias("__vec_c"),
                                    F.zip_with(s1, s2, lambda a, b: b - a * a / n).alias("__vec_s"))


def item_sums(items: DataFrame, seeds: DataFrame, features: Sequence[str], key: str, vec: str | None, dim: int, year: str) -> DataFrame:
    """``seeds`` (``seed_sums``) joined by (__u, __p_lo, __p_hi, __year_lo, __year_hi): ``__u`` holds the upper triangle of the cross
    products, then the vector's sums and squares. ``__p``: the match probability, a column of ``items``."""
    j = attach(items, seeds.select(key, "__c"), key)
    one = [F.lit(1.0)]
    u = one + [F.coalesce(F.col(f).cast("double") - F.col("__c")[i], F.lit(0.0)) for i, f in enumerate(features)]
    u += [F.col(f).isNull().cast("double") for f in features]
    parts = F.array(*[u[a] * u[b] for a in range(len(u)) for b in range(a, len(u))])
    size = len(u) * (len(u) + 1) // 2
    if vec:
        v = F.coalesce(F.col(vec), X.zeros(dim))
        parts, size = F.concat(parts, v, F.transform(v, lambda e: e * e)), size + 2 * dim
    j = j.select(key, parts.alias("__u"), F.col("__p"), F.col(year).cast("double").alias("__y"))
    ranges = {"__p_lo": F.min("__p"), "__p_hi": F.max("__p"), "__year_lo": F.min("__y"), "__year_hi": F.max("__y")}
    return V.array_sums(j, [key], "__u", size, "__u", ranges).join(seeds, key)


def _sd(square: np.ndarray, n: float) -> np.ndarray:
    s = np.sqrt(np.maximum(square, 0.0) / n)
    return np.where(s == 0, 1.0, s)


def _upper(flat: np.ndarray, q: int) -> np.ndarray:
    m = np.zeros((q, q))
    m[np.triu_indices(q)] = flat
    return m + np.triu(m, 1).T


def first_fit(sums: DataFrame, p: int, dim: int, key: str, alpha: float) -> DataFrame:
    """The parameters of ``FIRST``, a set at a time from its one row of sums."""
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        c, flat, ns = np.array(r["__c"], float), np.array(r["__u"], float), float(r["__n_seeds"])
        q = 2 * p + 1
        u = _upper(flat[: q * (q + 1) // 2], q)
        v1, v2 = flat[q * (q + 1) // 2:][:dim], flat[q * (q + 1) // 2:][dim:]
        seed_sq = _upper(np.array(r["__s"], float), p)
        n = u[0, 0]
        total = n + ns
        absent = u[0, p + 1:]
        here = n - absent
        mean = np.where(here > 0, c + u[0, 1:p + 1] / np.maximum(here, 1), 0.0)  # of the values there are

        def moments(fill):
            """Mean less c and sums of squared deviations of the items with missing values filled in."""
            b = np.zeros((p, q))
            b[np.arange(p), 1 + np.arange(p)] = 1.0
            b[np.arange(p), 1 + p + np.arange(p)] = fill - c
            shift = b @ u[:, 0] / n
            return shift, b @ u @ b.T - n * np.outer(shift, shift)

        zero, zero_sq = moments(np.zeros(p))
        filled, filled_sq = moments(mean)
        # ridge: items filled with their means, seeds with 0; both standardised; intercept not penalised
        square = filled_sq + seed_sq + n * ns / total * np.outer(filled, filled)
        sd, mu = _sd(np.diag(square), total), c + n * filled / total
        w = np.linalg.solve(square / np.outer(sd, sd) + alpha * np.eye(p), ns * (c - mu) / sd)
        cos_mu = c + n * zero / (n + 1)  # the centroid is one row more
        cos_sd = _sd(np.diag(zero_sq) + n / (n + 1) * zero ** 2, n + 1)
        nn_mu = c + n * zero / total
        nn_sd = _sd(np.diag(zero_sq) + np.diag(seed_sq) + n * ns / total * zero ** 2, total)
        vc, vs = np.array(r["__vec_c"], float), np.array(r["__vec_s"], float)
        shift = v1 / n - vc
        vec_mu, vec_sd = vc + n * shift / total, _sd(v2 - v1 * v1 / n + vs + n * ns / total * shift ** 2, total)
        return pd.DataFrame({key: pdf[key].iloc[:1], "__n": [n], "__n_seeds": [ns], "__fill": [mean], "__ridge_b": [ns / total], "__ridge_w": [w / sd], "__ridge_mu": [mu],
                             "__cos_mu": [cos_mu], "__cos_sd": [cos_sd], "__cos_t": [(c - cos_mu) / cos_sd], "__nn_mu": [nn_mu], "__nn_sd": [nn_sd], "__nn_t": [(c - nn_mu) / nn_sd],
                             "__vec_mu": [vec_mu], "__vec_sd": [vec_sd], "__vec_t": [(vc - vec_mu) / vec_sd], "__p_lo": [r["__p_lo"]], "__p_hi": [r["__p_hi"]]})

    kind = dict(sums.dtypes)[key]
    return sums.groupBy(key).applyInPandas(fit, f"{key} {kind}, {FIRST}")


def raw_scores(items: DataFrame, first: DataFrame, features: Sequence[str], key: str) -> DataFrame:
    """``items`` with ``cosine_raw``, ``ridge_raw`` and ``glm_score`` (M7 or M4's probability ``__p`` to 0..100, then V10)."""
    j = attach(items, first, key)
    x0 = [F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]
    z = [(x - F.col("__cos_mu")[i]) / F.col("__cos_sd")[i] for i, x in enumerate(x0)]
    ridge = F.col("__ridge_b")
    for i, f in enumerate(features):
        ridge = ridge + F.col("__ridge_w")[i] * (F.coalesce(F.col(f).cast("double"), F.col("__fill")[i]) - F.col("__ridge_mu")[i])
    lo, hi, p = F.col("__p_lo"), F.col("__p_hi"), F.col("__p")
    flat = F.when((hi - lo) * 100 < 0.01, F.when(hi > lo, (p - lo) / (hi - lo) * 100.0).otherwise(F.lit(0.0))).otherwise(p * 100.0)
    glm = F.when(hi - lo < 0.01, flat).otherwise((p - lo) / (hi - lo) * 100.0)
    return j.select(*items.columns, *[F.col(c) for c in first.columns if c != key and c not in items.columns],
                    X.cosine(z, [F.col("__cos_t")[i] for i in range(len(features))]).alias("cosine_raw"), ridge.alias("ridge_raw"),
                    F.coalesce(glm, F.lit(0.0)).alias("glm_score"))


def score_sums(scored: DataFrame, key: str) -> DataFrame:
    """Ranges and moments of the raw scores per (set, cluster)."""
    aggs = [F.count(F.lit(1)).cast("double").alias("m"), F.count_if(F.col("glm_score") > 0).cast("double").alias("m_match")]
    for c in ("cosine_raw", "ridge_raw", "glm_score"):
        aggs += [F.avg(c).alias(f"a_{c}"), F.var_pop(c).alias(f"v_{c}")]
    for c in ("cosine_raw", "ridge_raw"):
        aggs += [F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}")]
    return scored.groupBy(key, "cluster").agg(*aggs)


def second_fit(sums: DataFrame, seed_clusters: DataFrame, first: DataFrame, key: str) -> DataFrame:
    """The parameters of ``SECOND`` from a set's clusters (a row each) and the seeds per cluster (``m_seeds``)."""
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        m, seeds = pdf["m"].fillna(0.0).to_numpy(float), pdf["m_seeds"].fillna(0.0).to_numpy(float)
        n, ns = m.sum(), seeds.sum()
        total, here = n + ns, m > 0
        out = {key: pdf[key].iloc[:1]}

        def moments(c):
            a, v = pdf[f"a_{c}"].to_numpy(float)[here], pdf[f"v_{c}"].to_numpy(float)[here]
            mean = float((m[here] * a).sum() / n)
            return mean, float((m[here] * (v + (a - mean) ** 2)).sum())

        affine = []
        for c, name in (("cosine_raw", "cosine"), ("ridge_raw", "ridge")):
            lo, hi = pdf[f"lo_{c}"].min(), pdf[f"hi_{c}"].max()
            flat = 50.0 if name == "cosine" else 0.0  # V10 takes a flat ridge score of 50 to 0
            affine.append((100.0 / (hi - lo), -lo * 100.0 / (hi - lo)) if hi > lo else (0.0, flat))
        out |= {"__cosine_a": [affine[0][0]], "__cosine_b": [affine[0][1]], "__ridge_a": [affine[1][0]], "__ridge_b2": [affine[1][1]]}
        share = seeds / ns * 100.0
        lo, hi = share[here].min(), share[here].max()
        if hi > 100 or lo < 0 or hi - lo < 0.01:
            share = (share - lo) / (hi - lo) * 100.0 if hi > lo else np.zeros(len(share))
        labels = pdf["cluster"].tolist()
        out["__share"] = [dict(zip(labels, share))]
        # the blend's scaler over items and seeds; seeds carry the items' mean of every score, so their target is 0 there
        mus, sds = [], []
        for c, (a, b) in (("cosine_raw", affine[0]), ("ridge_raw", affine[1]), ("glm_score", (1.0, 0.0))):
            mean, square = moments(c)
            mus.append(a * mean + b)
            sds.append(float(_sd(np.array(a * a * square), total)))
        mean = (m * share).sum() / n
        mus.append(mean)
        sds.append(float(_sd((m * (share - mean) ** 2).sum(), total)))
        out |= {"__score_mu": [mus], "__score_sd": [sds]}
        matched = (pdf["m_match"].fillna(0.0).sum() + ns) / total
        match_sd = float(_sd(np.array(matched * (1 - matched)), 1.0))
        match_t = (1.0 - matched) / match_sd
        part = (m + seeds) / total
        sd = _sd(part * (1 - part), 1.0)
        t = (seeds / ns - part) / sd
        off = -part / sd  # an item outside the cluster
        num = (off * t).sum() + t / sd
        square = (off ** 2).sum() - off ** 2 + ((1 - part) / sd) ** 2
        out |= {"__cluster_num": [dict(zip(labels, num))], "__cluster_sq": [dict(zip(labels, square))], "__match_mu": [matched], "__match_sd": [match_sd],
                "__match_t": [match_t], "__t_norm": [float((t ** 2).sum() + match_t ** 2 + pdf["t_rest"].iloc[0])]}
        return pd.DataFrame(out)

    square = lambda a: F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v * v)
    j = sums.join(seed_clusters, [key, "cluster"], "full").join(first.select(key, (square("__nn_t") + square("__vec_t")).alias("t_rest")), key)
    kind = dict(sums.dtypes)[key]
    return j.groupBy(key).applyInPandas(fit, f"{key} {kind}, {SECOND}")


def blend(scored: DataFrame, second: DataFrame, features: Sequence[str], key: str, vec: str | None, dim: int,
          emphasis: dict[str, int], keep: Sequence[str]) -> DataFrame:
    """``keep`` with the finished scores and ``blend_similarity`` (M13 with all its inputs, M14)."""
    j = attach(scored, second, key)
    cosine = F.col("cosine_raw") * F.col("__cosine_a") + F.col("__cosine_b")
    ridge = F.col("ridge_raw") * F.col("__ridge_a") + F.col("__ridge_b2")
    share = F.coalesce(F.element_at("__share", F.col("cluster")), F.lit(0.0))
    j = j.select("*", cosine.alias("cosine_score"), ridge.alias("ridge_score"), share.alias("cluster_score"))
    num, square = F.element_at("__cluster_num", F.col("cluster")), F.element_at("__cluster_sq", F.col("cluster"))
    for i, f in enumerate(features):
        z = (F.coalesce(F.col(f).cast("double"), F.lit(0.0)) - F.col("__nn_mu")[i]) / F.col("__nn_sd")[i]
        num, square = num + z * F.col("__nn_t")[i], square + z * z
    match = ((F.col("glm_score") > 0).cast("double") - F.col("__match_mu")) / F.col("__match_sd")
    num, square = num + match * F.col("__match_t"), square + match * match
    for i, s in enumerate(("cosine_score", "ridge_score", "glm_score", "cluster_score")):
        z = (F.col(s) - F.col("__score_mu")[i]) / F.col("__score_sd")[i]
        square = square + z * z * F.lit(float(emphasis.get(s, 1)))
    if vec:
        z = F.zip_with(F.zip_with(F.coalesce(F.col(vec), X.zeros(dim)), "__vec_mu", lambda v, m: v - m), "__vec_sd", lambda v, s: v / s)
        num = num + F.aggregate(F.zip_with(z, "__vec_t", lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
        square = square + F.aggregate(z, F.lit(0.0), lambda acc, v: acc + v * v)
    zero = (square <= 0) | (F.col("__t_norm") <= 0)
    sim = F.when(zero, F.lit(0.0)).otherwise(num / (F.sqrt(square) * F.sqrt("__t_norm")))
    return j.select(*keep, "cosine_score", "ridge_score", "glm_score", "cluster_score", sim.alias("blend_similarity"))
