"""Scoring models.

Deterministic models are column expressions over per-set parameters. The ridge model is
solved from per-set sufficient statistics (means, Gram matrix, Xᵀy: one aggregate over the
items) with one tiny p×p solve per set in ``applyInPandas`` over the statistics frame (one
row per set) — never over the items. The logistic GLM (``logistic``) and the boosted trees (``boost``)
are fitted per set, all sets at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedrank.functions import exprs as X
from seedrank.functions.params import attach, materialize
from seedrank.operators import vectors as V
from seedrank.operators.boost import TARGET, Shape, binned, boosted_predictions, fitted_predictions, standardized_array
from seedrank.operators.clean import impute_mean, impute_zero, with_seen_flags
from seedrank.operators.logistic import MAX_ENTRIES, logistic_probabilities

# Fixed values that must equal the reference's behaviour.
# Metadata-match weights per categorical role (owner, album, label, release date).
MATCH_WEIGHTS = {"owner": 0.5, "album": 0.2, "label": 0.2, "date": 0.1}
RIDGE_ALPHA = 1.0
GLM_RIDGE = 0.01
SEED_UPSAMPLE = 5
# Our own bound on Newton rounds.
GLM_MAX_ROUNDS = 50
# Emphasis of each score in the blended similarity (number of copies in the reference).
EMPHASIS = {"cosine_score": 7, "ridge_score": 2, "glm_score": 1, "cluster_score": 1}


# ---------------------------------------------------------------- M3 cosine

def cosine_score(items: DataFrame, seeds: DataFrame, features: Sequence[str], key: str = "set_id",
                 out: str = "cosine_score", raw: str = "cosine_similarity") -> DataFrame:
    """M3: NULL → 0; scaler fitted on the items plus the seed centroid; cosine of each scaled
    item to the scaled centroid; per-set min-max to 0..100 (flat → 50)."""
    it = impute_zero(items, features)
    sd = impute_zero(seeds.select(key, *features), features)
    cen = V.centroid(sd, features, key, prefix="")
    fit = it.select(key, *features).unionByName(cen.select(key, *features))
    stats = V.scaler_stats(fit, features, key)
    tgt = attach(cen, stats, key).select(
        key, *[X.standardized(F.col(f), F.col(f"m_{f}"), F.col(f"s_{f}")).alias(f"t_{f}") for f in features])
    z = V.standardize(it, stats, features, key)
    cos = V.cosine_to(z, tgt, features, key, out=raw)
    cos = cos.drop(*[f"z_{f}" for f in features])
    return V.minmax_100(cos, raw, out, flat="fifty", key=key)


# ---------------------------------------------------------------- M2 ridge

def _ridge_solver(features: Sequence[str], alpha: float, key: str):
    p = len(features)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        # one group = one set = one row of sufficient statistics
        n = float(pdf["n"].iloc[0])
        sx = np.array([float(pdf[f"sx_{i}"].iloc[0]) for i in range(p)])
        g = np.zeros((p, p))
        for i in range(p):
            for j in range(i, p):
                g[i, j] = g[j, i] = float(pdf[f"g_{i}_{j}"].iloc[0])
        xty = np.array([float(pdf[f"xy_{i}"].iloc[0]) for i in range(p)])
        ybar = float(pdf["sy"].iloc[0]) / n
        xbar = sx / n
        # centred normal equations; the intercept is not penalised
        w = np.linalg.solve(g - n * np.outer(xbar, xbar) + alpha * np.eye(p), xty - n * xbar * ybar)
        out = {key: pdf[key].iloc[:1].to_numpy(), "intercept": [ybar - float(xbar @ w)]}
        out.update({f"w_{i}": [float(w[i])] for i in range(p)})
        return pd.DataFrame(out)

    return solve


def ridge_score(items: DataFrame, seeds: DataFrame, features: Sequence[str], key: str = "set_id",
                alpha: float = RIDGE_ALPHA, out: str = "ridge_score", raw: str = "ridge_fitness") -> DataFrame:
    """M2: item NULLs → item mean, seed NULLs → 0; label 1 for seeds, 0 for items; features
    standardised on both; ridge (α, unpenalised intercept); predict the items; min-max to
    0..100 per set (flat → 50)."""
    p = len(features)
    it = impute_zero(impute_mean(items, features, key), features)
    sd = impute_zero(seeds.select(key, *features), features)
    both = it.select(key, *features, F.lit(0.0).alias("__y")).unionByName(sd.select(key, *features, F.lit(1.0).alias("__y")))
    stats = V.scaler_stats(both, features, key)
    zb = V.standardize(both, stats, features, key)
    z = [F.col(f"z_{f}") for f in features]
    aggs = [F.count(F.lit(1)).cast("double").alias("n"), F.sum("__y").alias("sy")]
    aggs += [F.sum(z[i]).alias(f"sx_{i}") for i in range(p)]
    aggs += [F.sum(z[i] * F.col("__y")).alias(f"xy_{i}") for i in range(p)]
    aggs += [F.sum(z[i] * z[j]).alias(f"g_{i}_{j}") for i in range(p) for j in range(i, p)]
    suff = zb.groupBy(key).agg(*aggs)
    key_type = dict(suff.dtypes)[key]
    schema = f"{key} {key_type}, intercept double, " + ", ".join(f"w_{i} double" for i in range(p))
    coef = suff.groupBy(key).applyInPandas(_ridge_solver(features, alpha, key), schema=schema)
    zi = V.standardize(it, stats, features, key)
    j = attach(zi, coef, key)
    pred = F.col("intercept")
    for i, f in enumerate(features):
        pred = pred + F.col(f"w_{i}") * F.col(f"z_{f}")
    scored = j.select(*it.columns, pred.alias(raw))
    return V.minmax_100(scored, raw, out, flat="fifty", key=key)


# ---------------------------------------------------------------- M6 / M7 metadata match

def in_seed_flags(items: DataFrame, seeds: DataFrame, cols: Sequence[str], key: str = "set_id",
                  suffix: str = "_in_seeds") -> DataFrame:
    """M6: ``<col>_in_seeds`` = 1 when the item's value occurs among its set's seeds; one join for all columns."""
    return with_seen_flags(items, seeds, cols, key, suffix)


def metadata_match(items: DataFrame, seeds: DataFrame, roles: dict[str, str], key: str = "set_id",
                   out: str = "match_score") -> DataFrame:
    """M7: Σ weight(role)·[value seen in the set's seeds] / Σ weight over the roles present.
    ``roles`` maps a role of ``MATCH_WEIGHTS`` to a column name."""
    present = {r: c for r, c in roles.items() if c in items.columns and c in seeds.columns}
    flagged = in_seed_flags(items, seeds, list(present.values()), key)
    total = sum(MATCH_WEIGHTS[r] for r in present)
    num = F.lit(0.0)
    for r, c in present.items():
        num = num + F.lit(MATCH_WEIGHTS[r]) * F.col(f"{c}_in_seeds")
    score = num / F.lit(total) if total > 0 else F.lit(0.0)
    return flagged.withColumn(out, score)


# ---------------------------------------------------------------- M13 / M14 blended similarity

def blended_similarity(items: DataFrame, seeds: DataFrame, features: Sequence[str], scores: Sequence[str],
                       key: str = "set_id", out: str = "blend_similarity", flag: str | None = None,
                       emphasis: dict[str, int] | None = None) -> DataFrame:
    """M13 + M14: features (NULL → 0) plus the model scores, each score weighted by its
    emphasis (k copies of a standardised column = weight k in dots and norms); seed rows
    carry the item mean of every score and ``flag`` = 1. Scaler fitted on items ∪ seeds;
    cosine of each item to the mean scaled seed vector."""
    emphasis = emphasis or EMPHASIS
    cols = list(features) + ([flag] if flag else []) + list(scores)
    weights = [1.0] * (len(features) + (1 if flag else 0)) + [float(emphasis.get(s, 1)) for s in scores]
    it = impute_zero(items, cols)
    means = it.groupBy(key).agg(*[F.avg(s).alias(s) for s in scores])
    sd = impute_zero(seeds.select(key, *features), features)
    if flag:
        sd = sd.withColumn(flag, F.lit(1.0))
    sd = attach(sd, means, key).select(key, *cols)
    fit = it.select(key, *cols).unionByName(sd)
    stats = V.scaler_stats(fit, cols, key)
    zs = V.standardize(sd, stats, cols, key)
    tgt = zs.groupBy(key).agg(*[F.avg(f"z_{c}").alias(f"t_{c}") for c in cols])
    zi = V.standardize(it, stats, cols, key)
    res = V.cosine_to(zi, tgt, cols, key, out=out, weights=weights)
    return res.drop(*[f"z_{c}" for c in cols])


# ---------------------------------------------------------------- M1 similarity filter

def similarity_filter(items: DataFrame, seeds: DataFrame, x: str, dim: int, key: str = "set_id",
                      threshold: float | None = 0.60, filter_on: str = "similarity", seed: int = 42, id_col: str = "item_id",
                      shape: Shape | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """M1 + C10 + C14 over ``x``, an array<double> of ``dim`` features (audio features and
    tag-vector dimensions side by side): complete rows only; scaler fitted on the items;
    cosine of each scaled item to the scaled seed centroid = ``similarity_score``.
    ``filter_on='similarity'`` keeps similarity ≥ threshold (deterministic); ``'model'`` fits boosted trees
    to the similarity, a model per set (100 trees, depth 5, rate 0.05, row and feature sampling 0.8;
    ``boost``), and keeps ``fit_probability`` ≥ threshold, for which ``id_col`` must be unique in a set.
    ``threshold=None`` returns every complete row with its scores. The statistics are one buffer a set. ``keep``: the items' columns
    that a fitted result has beside ``key`` and ``id_col`` (by default all, ``x`` too); they are written with the rows' bins."""
    complete = ~F.exists(F.col(x), lambda v: v.isNull()) & F.col(x).isNotNull()
    it = items.where(complete)
    sd = seeds.select(key, x).where(complete)
    st = materialize(V.array_stats(it, [key], x, dim), "filter_stats")  # read by the target and by the rows
    cen = V.array_stats(sd, [key], x, dim).select(key, F.col("__mean").alias("__c"))

    def z(col):
        return F.transform(F.arrays_zip(col.alias("v"), F.col("__mean").alias("m"), F.col("__sd").alias("s")), lambda e: X.standardized(e["v"], e["m"], e["s"]))

    tgt = attach(cen, st, key).select(key, z(F.col("__c")).alias("__t"))
    j = attach(attach(it, st, key), tgt, key)
    if filter_on != "model":
        sim = j.select(*it.columns, X.array_cosine(z(F.col(x)), F.col("__t")).alias("similarity_score"))
        return sim if threshold is None else sim.where(F.col("similarity_score") >= threshold)
    kept = [c for c in (it.columns if keep is None else keep) if c not in (key, id_col)]
    scaled = j.select(key, id_col, *kept, z(F.col(x)).alias("__z"), F.col("__t"))
    sim = scaled.select(key, id_col, *kept, "__z", X.array_cosine(F.col("__z"), F.col("__t")).alias("similarity_score"))
    table = binned(sim, key, id_col, "__z", "similarity_score", kept)
    pred = fitted_predictions(table, key, id_col, "fit_probability", shape or Shape(seed=seed))
    if threshold is not None:
        pred = pred.where(F.col("fit_probability") >= threshold)
    return table.select(key, id_col, *kept, F.col(TARGET).alias("similarity_score")).join(pred, [key, id_col])


# ---------------------------------------------------------------- M4 / M5 metadata GLM

def metadata_glm(items: DataFrame, seeds: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                 key: str = "set_id", id_col: str = "item_id", out: str = "glm_score",
                 reg: float = GLM_RIDGE, upsample: int = SEED_UPSAMPLE, max_rounds: int = GLM_MAX_ROUNDS,
                 max_entries: int = MAX_ENTRIES) -> DataFrame:
    """M4: binomial GLM (ridge ``reg``, unpenalised intercept) of seed-vs-item on scaled numeric
    columns, one-hot categories (unseen → '????', M5/C16) and an in-seeds flag per category
    (M6); seeds weigh ``upsample`` (D6 as a weight). Every set has its own fit (``logistic``),
    so a set's scores do not depend on the other sets. A minimum frequency of 2 for a category
    needs no rule: a seed's value weighs 5, and all others are one category. Predicted
    probability → per-set 0..100 (range < 0.01 → p·100), NULL → 0."""
    scored = glm_probability(items, seeds, numeric, categorical, key, id_col, reg, upsample, max_rounds, max_entries)
    scored = V.minmax_100(materialize(scored, "glm_scores"), "glm_probability", out, flat="glm", key=key)
    scored = scored.withColumn(out, F.coalesce(F.col(out), F.lit(0.0)))
    return items.join(scored, [key, id_col], "left")


def glm_probability(items: DataFrame, seeds: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                    key: str = "set_id", id_col: str = "item_id", reg: float = GLM_RIDGE, upsample: int = SEED_UPSAMPLE,
                    max_rounds: int = GLM_MAX_ROUNDS, max_entries: int = MAX_ENTRIES) -> DataFrame:
    """(key, id, glm_probability) of every item."""
    from seedrank.operators.clean import UNSEEN, coerce_numeric, exact_medians, impute_unknown

    cols = [key, id_col, *numeric, *categorical]
    both = (items.select(*cols, F.lit(0.0).alias("__y"), F.lit(1.0).alias("__w"))
            .unionByName(seeds.select(*cols, F.lit(1.0).alias("__y"), F.lit(float(upsample)).alias("__w"))))
    # read by the medians, the scaler and the fit
    both = materialize(impute_unknown(coerce_numeric(both, numeric), categorical), "glm_input")
    seen = both.where(F.col("__y") == 1.0)
    # one median over items and seeds serves both; filling in a median does not move it
    filled = attach(both, exact_medians(both, numeric, key), key, how="left") if numeric else both
    filled = filled.select(*[F.coalesce(F.col(c), F.col(f"__med_{c}")).alias(c) if c in numeric else F.col(c) for c in both.columns])
    scaled = V.standardize(filled, V.scaler_stats(filled, numeric, key), numeric, key) if numeric else filled
    flags = in_seed_flags(scaled, seen, categorical, key)
    entry = lambda name, v: F.struct(name.alias("name"), v.cast("double").alias("v"))
    known = lambda c: F.when(F.col(f"{c}_in_seeds") == 1, F.col(c)).otherwise(F.lit(UNSEEN))
    inputs = F.array(
        *[entry(F.lit(f"z:{c}"), F.coalesce(F.col(f"z_{c}"), F.lit(0.0))) for c in numeric],
        *[entry(F.concat(F.lit(f"{c}="), known(c)), F.lit(1.0)) for c in categorical],
        *[entry(F.lit(f"seen:{c}"), F.col(f"{c}_in_seeds")) for c in categorical])
    rows = flags.select(key, id_col, "__y", "__w", F.filter(inputs, lambda e: e["v"] != 0).alias("__f"))
    return logistic_probabilities(rows, key, id_col, reg, max_rounds, max_entries)


# ---------------------------------------------------------------- M15 learned blend

def learned_blend(df: DataFrame, features: Sequence[str], target: str = "blend_similarity", key: str = "set_id",
                  out: str = "nn_score", seed: int = 42, id_col: str = "item_id", shape: Shape | None = None) -> DataFrame:
    """M15 (re-aimed): boosted trees learn the blended similarity from the inputs, a model per set (``boost``; in place of the
    reference's network, whose 200 passes end early: 100 trees at rate 0.1); the prediction, min-max scaled
    per set (flat → unchanged), is ``nn_score``. ``id_col`` must be unique in a set."""
    x = materialize(impute_zero(df, features), "blend_train")
    arr = x.select(key, id_col, target, F.array(*[F.col(f).cast("double") for f in features]).alias("__x"))
    z = standardized_array(arr, "__x", len(features), key, "__z", [key, id_col, target])
    pred = materialize(boosted_predictions(z, "__z", target, key, id_col, "__pred", shape or Shape(rate=0.1, seed=seed)), "blend_fit")
    return V.minmax_100(x.join(pred, [key, id_col]), "__pred", out, flat="keep", key=key).drop("__pred")
