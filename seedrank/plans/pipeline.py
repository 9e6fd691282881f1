"""The whole recommendation chain as one composition of the library's operators, for any
item table and any number of seed sets (one per ``set_id``).

    result = recommend(items, seeds, features=[...], n=100)
    result.recs      # n rows per set: set_id, rank, item id, cluster, scores, base_score
    result.seeds     # seeds with their cluster
    result.scored    # every candidate with every score (written once, see below)

Order (as the reference runs it): ``prepare`` (D1, J2, J4, V4, C1), then exclude seen (J3) → similarity
filter (M1, C10, C14) → ridge (M2) → cosine (M3) → metadata match (M7, or the GLM M4) → era adjustment (T1–T7) → clusters (given
centroids, or K-means with the elbow, M8–M12) → re-scaling (V10) → blended similarity (M13, M14) → blend (R1, R2) → era
factor (T9) → user recency (T10) → quota selection (R3–R6). Every step is keyed by ``set_id``; per-set
parameters meet the items on that key. The models' statistics are fused (``operators.fused``): the candidates are written
once after the filter, three aggregates serve all models, and the final scores are written once, so the selection windows do
not re-run the scoring.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedrank.functions import exprs as X
from seedrank.functions.params import attach, bound_scope, count_key_bound, key_bound, materialize
from seedrank.operators import cluster as K
from seedrank.operators import era as E
from seedrank.operators import fused as Z
from seedrank.operators import score as M
from seedrank.operators import select as R
from seedrank.operators import vectors as V
from seedrank.operators.clean import drop_self_titled, impute_zero
from seedrank.operators.dedup import dedup_by_key
from seedrank.operators.enrich import enrich_from_items, exclude_seen, fill_tags
from seedrank.operators.stats import Counters


@dataclass
class Recommendation:
    recs: DataFrame
    seeds: DataFrame
    scored: DataFrame


def seed_scaler(seeds: DataFrame, features: Sequence[str], key: str = "set_id") -> DataFrame:
    """V7 fitted on the zero-filled seeds alone, as the clustering step does."""
    return V.scaler_stats(impute_zero(seeds.select(key, *features), features), features, key)


def with_zvec(df: DataFrame, scaler: DataFrame, features: Sequence[str], key: str = "set_id") -> DataFrame:
    """``df`` with its zero-filled, scaled features packed in ``zvec``; the features stay as they are."""
    z = [X.standardized(F.coalesce(F.col(f).cast("double"), F.lit(0.0)), F.col(f"m_{f}"), F.col(f"s_{f}")) for f in features]
    return attach(df, scaler, key).select(*df.columns, F.array(*z).alias("zvec"))


def seed_scaled(cand: DataFrame, seeds: DataFrame, features: Sequence[str], key: str = "set_id"):
    """(candidates, seeds) with ``zvec``."""
    scaler = seed_scaler(seeds, features, key)
    return with_zvec(cand, scaler, features, key), with_zvec(seeds, scaler, features, key)


def elbow_centers(sz: DataFrame, id_col: str, dim: int, key: str = "set_id") -> DataFrame:
    """M8 + M9: K-means for k = 1..10 on every set, the knee picks k; its centres."""
    centers, cost = K.kmeans_multi(sz, "zvec", id_col, dim, key=key)
    best = K.knee(cost.where("converged"), key)  # a fit that never settled has no cost to compare
    best = centers.select(key).distinct().join(best, key, "left").select(key, F.coalesce("optimal_k", F.lit(K.DEFAULT_K)).alias("optimal_k"))
    chosen = centers.join(best, key).where(F.col("k") == F.col("optimal_k")).select(key, "idx", "center")
    # ≤ 10 rows per set, read by several later passes: written once so the fit never re-runs
    return materialize(chosen, "centers")


def prepare(items: DataFrame, seeds: DataFrame, *, name: str, owner: str, order_by: Sequence[str], tags: str | None = None,
            vec: str | None = None, lookup: DataFrame | None = None, dim: int = 0, id_col: str = "item_id",
            key: str = "set_id", reference: DataFrame | None = None, counters: Counters | None = None,
            vectors: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The steps before scoring: one row per track on both sides (D1), seeds take the catalogue's tags and
    vectors (J2), missing tags come from ``reference`` (the same track's) or the owner's other items (J4), seeds without a vector get one
    from their tags (V4), self-titled items go (C1). Both results are written once; ``counters`` gets the rows of every step and
    the seeds without tags before and after they are filled (A13). With ``vectors`` (``<vec>_ref``, ``vec``; refs in the order of the
    vectors) both sides hold ``<vec>_ref`` in place of ``vec``, and only single tracks meet their vectors."""
    watch = counters.watch if counters else lambda df, stage, **counts: df
    link = vec if vectors is None else f"{vec}_ref"
    named = (lambda df: df) if vectors is None else lambda df: V.named_vectors(df, vectors, link, vec)
    items = dedup_by_key(items, name, owner, order_by, key)
    items = materialize(named(watch(drop_self_titled(watch(items, "tracks"), name, owner), "items")), "items")
    seeds = dedup_by_key(seeds, name, owner, order_by, key)
    cols = [c for c in (tags, link) if c and c in items.columns]
    if cols:
        seeds = enrich_from_items(seeds, items, name, owner, tags if tags in cols else None, link if link in cols else None,
                                  order_by, key)
    if tags and tags in items.columns:
        untagged = F.col(tags).isNull() | (F.col(tags) == "")
        # written on the way: the filling joins read it more than once, and its counts are those of one reading
        seeds = fill_tags(materialize(watch(seeds, "enriched", untagged=untagged), "enriched"), items, owner, tags, name, reference)
        seeds = materialize(watch(seeds, "filled", untagged=untagged), "filled")
    if vec:
        seeds = V.embed_seeds(materialize(named(seeds), "seeds_enriched"), [key, id_col], tags, vec, lookup, dim, recompute="all", key=key)
    if vectors is not None:
        items, seeds = items.drop(link), seeds.drop(link)
    return items, materialize(seeds, "seeds")


def recommend(items: DataFrame, seeds: DataFrame, features: Sequence[str], *, key: str = "set_id",
              id_col: str = "item_id", name: str = "name", owner: str = "owner", year: str = "release_year",
              n: int = R.N_RECOMMENDATIONS, weights: dict[str, float] | None = None,
              models: Sequence[str] = ("cosine", "ridge", "match"), match_roles: dict[str, str] | None = None,
              centers: DataFrame | None = None, recency: float = 0.0, similarity: float | None = None,
              vec: str | None = None, dim: int = 0, keep: Sequence[str] = (), counters: Counters | None = None) -> Recommendation:
    """The full chain. ``similarity`` (None: no filter) keeps the complete candidates at least that close
    to the seeds (M1, C10, C14), over ``features`` and, if given, the ``dim`` values of ``vec``, before
    anything else is fitted. ``centers`` (key, idx, center over the seed-scaled ``features``) gives
    the clusters; without it they come from K-means with the elbow rule, and ``centers="none"`` runs the chain without
    clusters (no cluster score, plain ranking). ``models`` picks the scores: 'cosine' (left out by itself under three
    ``features``, C11), 'ridge', 'match' (M7) or 'glm' (M4), 'nn' (the network's target: the blended similarity of all
    inputs, M13 and M14) or 'nn_trees' (its learned form, M15); ``weights`` the blend (defaults renormalised over the scores present). ``counters`` gets the candidates
    before and after the filter (A13)."""
    with bound_scope():
        if key_bound(key) is None:
            count_key_bound(items.select(key).unionByName(seeds.select(key)), key)
        return _recommend(items, seeds, list(features), key, id_col, name, owner, year, n, weights, models, match_roles,
                          centers, recency, similarity, vec, dim, keep, counters)


def _candidates(items, seeds, features, key, id_col, name, owner, year, roles, similarity, vec, dim, keep, models, counters) -> DataFrame:
    """The candidates after the filter with the columns that the models read, and ``__p``, the metadata probability
    (M7, or M4's fit); written once."""
    watch = counters.watch if counters else lambda df, stage: df
    cand = exclude_seen(items, seeds, name, owner, key)
    used = list(dict.fromkeys([key, id_col, *features, year, *roles.values(), *keep, *([vec] if vec else [])]))
    if similarity is not None:
        x = F.array(*[F.col(f).cast("double") for f in features])
        x = F.concat(x, F.col(vec)) if vec else x
        cand = materialize(watch(cand.select(*used), "candidates"), "candidates")  # read by the filter's scaler and by the filter
        cand = M.similarity_filter(cand.withColumn("__x", x), seeds.withColumn("__x", x), "__x", len(features) + (dim if vec else 0), key, similarity)
    cand = watch(cand.select(*used), "kept")
    if "glm" in models:
        cand = materialize(cand, "candidates")
        p = M.glm_probability(cand, seeds, features, list(roles.values()), key, id_col)
        return materialize(cand.join(p.withColumnRenamed("glm_probability", "__p"), [key, id_col], "left"), "candidates")
    if "match" in models:
        m = M.metadata_match(cand, seeds, roles, key, out="__p")
        return materialize(m.select(*used, "__p"), "candidates")
    return materialize(cand.withColumn("__p", F.lit(0.0)), "candidates")


def _recommend(items, seeds, features, key, id_col, name, owner, year, n, weights, models, match_roles, centers, recency,
               similarity, vec, dim, keep, counters) -> Recommendation:
    """Passes over the candidates: the filter's scaler, the filter with the one write, the cross products (``item_sums``), the raw
    scores' ranges (``score_sums``), with 'nn' the blend's range, and the final scores with their write."""
    roles = match_roles or {"owner": owner}
    models = [m for m in models if m != "cosine" or len(features) >= 3]
    blended = bool({"nn", "nn_trees"} & set(models))
    if blended and not ({"cosine", "ridge"} <= set(models) and {"glm", "match"} & set(models) and not isinstance(centers, str)):
        raise ValueError("the blended similarity takes the cosine, ridge and metadata scores and the clusters: name them in models")
    sc = _candidates(items, seeds, features, key, id_col, name, owner, year, roles, similarity, vec, dim, keep, models, counters)
    blend_vec = vec if blended else None

    per_seed = Z.seed_sums(seeds, features, key, blend_vec, dim)
    sums = materialize(Z.item_sums(sc, per_seed, features, key, blend_vec, dim, year), "item_sums")
    first = materialize(Z.first_fit(sums, len(features), dim if blend_vec else 0, key, M.RIDGE_ALPHA), "first_fit")
    raw = Z.raw_scores(sc, first, features, key)
    if isinstance(centers, str):
        raw, seed_clusters, labels = raw.withColumn("cluster", F.lit("A")), seeds.select(key, id_col, F.lit("A").alias("cluster")), False
    else:
        scaler = seed_scaler(seeds, features, key)
        sz = with_zvec(seeds, scaler, features, key)
        if centers is None:
            centers = elbow_centers(sz, id_col, len(features), key)
        raw = K.assign_clusters(with_zvec(raw, scaler, features, key), centers, "zvec", key).drop("zvec", "cluster_d2")
        seed_clusters, labels = K.assign_clusters(sz, centers, "zvec", key).select(key, id_col, "cluster"), True
    seed_clusters = materialize(seed_clusters, "seed_clusters")
    counts = seed_clusters.groupBy(key, "cluster").agg(F.count(F.lit(1)).cast("double").alias("m_seeds"))
    second = materialize(Z.second_fit(Z.score_sums(raw, key), counts, first, key), "second_fit")

    years = sums.select(key, "__year_lo", "__year_hi")
    base = [key, id_col, "cluster", year, *keep]
    done = Z.blend(raw, second, features, key, blend_vec, dim, M.EMPHASIS, list(dict.fromkeys([*base, *(features if "nn_trees" in models else [])])))
    if "nn_trees" in models:
        done = M.learned_blend(done, [*features, "cosine_score", "ridge_score", "glm_score", "cluster_score"], key=key, id_col=id_col)
    elif blended:
        done = V.minmax_100(done, "blend_similarity", "nn_score", flat="keep", key=key)
    names = {"cosine": "cosine_score", "ridge": "ridge_score", "nn": "nn_score", "nn_trees": "nn_score", "glm": "glm_score", "match": "glm_score"}
    scores = [s for s in R.DEFAULT_WEIGHTS if s in {names[m] for m in models}] + (["cluster_score"] if labels else [])
    done = E.apply_era(done, E.era_params(seeds, year, key), year, key)
    done = R.base_score(done.select(*dict.fromkeys(base), *scores, "year_adjustment"), weights or R.DEFAULT_WEIGHTS)
    done = done.withColumn("base_score", E.apply_adjustment(F.col("base_score"), F.col("year_adjustment")))
    if recency:
        done = E.with_recency(attach(done, years, key), "base_score", recency, year, "__year_lo", "__year_hi")
    scored = materialize(done.select(key, id_col, "cluster", *scores, "year_adjustment", "base_score", *keep), "scored")
    if not labels:  # R6 without clusters: the plain ranking
        return Recommendation(R.top_n(scored, "base_score", id_col, n, key), seed_clusters, scored)
    quota = R.cluster_quota(seed_clusters, "cluster", n, key)
    recs = R.select_by_quota(scored, quota, "base_score", id_col, "cluster", n, key)
    return Recommendation(recs, seed_clusters, scored)


def insights(result: Recommendation, items: DataFrame, seeds: DataFrame, features: Sequence[str], *,
             key: str = "set_id", id_col: str = "item_id", year: str = "release_year", tags: str | None = None,
             db_like: Sequence[str] = (), tempo_like: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The interactive view's frames for a result (charts are not built, only their data):
    seed feature means with levels (A5, A6), cluster mix of seeds vs recommendations (A8),
    2-D projection of the catalogue (V11), release years of the recommendations with the seed
    mean (A10), seed means next to the best five (A17) and the seeds' top tags (A1)."""
    from seedrank.operators import stats as A
    recs = result.recs.join(items.select(key, id_col, year, *features), [key, id_col])
    out = {
        "feature_levels": A.feature_levels(A.feature_means(seeds, features, key), db_like, tempo_like),
        "cluster_distribution": A.cluster_distribution(result.seeds, result.recs, "cluster", key),
        "pca": V.pca_2d(items, features, [key, id_col]),
        "year_histogram": A.histogram(recs, year, 30, key).join(
            seeds.groupBy(key).agg(F.avg(year).alias("seed_mean_year")), key, "left"),
        "feature_profile": A.feature_profile(seeds, recs, features, "base_score", id_col, 5, key),
    }
    if tags and tags in seeds.columns:
        out["tag_counts"] = A.tag_counts(seeds, tags, 10, key)
    return out
