import numpy as np
from pyspark.sql import functions as F

from seedrank.operators import score as M
from seedrank.operators import vectors as V
from seedrank.operators.enrich import exclude_seen
from seedrank.plans import pipeline as P

RNG = np.random.default_rng(11)


def test_embed_seeds_missing_and_all(spark):
    lk = spark.createDataFrame([("pop", [1.0, 0.0]), ("rock", [0.0, 1.0])], "tag string, vec array<double>")
    seeds = spark.createDataFrame([(1, "Pop, rock", [5.0, 5.0]), (2, "rock", None), (3, None, None)],
                                  "id int, g string, vec array<double>")
    miss = {r.id: r.vec for r in V.embed_seeds(seeds, ["id"], "g", "vec", lk, 2).collect()}
    assert miss == {1: [5.0, 5.0], 2: [0.0, 1.0], 3: [0.0, 0.0]}
    allr = {r.id: r.vec for r in V.embed_seeds(seeds, ["id"], "g", "vec", lk, 2, recompute="all").collect()}
    assert allr[1] == [0.5, 0.5]  # recomputed because another row lacked a vector
    none = {r.id: r.vec for r in V.embed_seeds(seeds.drop("vec"), ["id"], None, "vec", None, 2).collect()}
    assert none == {1: [0.0, 0.0], 2: [0.0, 0.0], 3: [0.0, 0.0]}


def test_recommend_pipeline_with_elbow_clusters(spark):
    rows, seeds = [], []
    blobs = np.array([[0, 0], [8, 8], [0, 8]], float)
    for s in (0, 1):
        for i in range(300):
            x = blobs[i % 3] + RNG.normal(scale=0.5, size=2)
            rows.append((s, s * 10000 + i, f"t{i}", f"o{i % 7}", 1990 + i % 20, float(x[0]), float(x[1])))
    items = spark.createDataFrame(rows, "set_id int, item_id long, name string, owner string, release_year int, a double, b double")
    seeds = items.where(F.col("item_id") % 10 == 0)  # test fixture: every tenth row is a seed
    r = P.recommend(items, seeds, ["a", "b"], n=20, match_roles={"owner": "owner"})
    recs = r.recs.collect()
    assert len(recs) == 40
    per_set = {}
    for x in recs:
        per_set.setdefault(x.set_id, []).append(x)
    for s, xs in per_set.items():
        assert sorted(x["rank"] for x in xs) == list(range(1, 21))
        scores = [x.base_score for x in sorted(xs, key=lambda x: x["rank"])]
        assert scores == sorted(scores, reverse=True)
    seed_ids = {x.item_id for x in seeds.collect()}
    assert not seed_ids & {x.item_id for x in recs}
    assert r.seeds.select("cluster").distinct().count() >= 2


def test_insights_frames(spark):
    rows = [(0, i, f"t{i}", f"o{i % 5}", 1990 + i % 15, float(i % 7), float(i % 11), "pop,rock" if i % 2 else "jazz")
            for i in range(120)]
    items = spark.createDataFrame(rows, "set_id int, item_id long, name string, owner string, release_year int, a double, b double, g string")
    seeds = items.where(F.col("item_id") < 12)  # test fixture: the first twelve rows are the seeds
    cen = spark.createDataFrame([(0, 0, [-1.0, -1.0]), (0, 1, [1.0, 1.0])], "set_id int, idx int, center array<double>")
    r = P.recommend(items, seeds, ["a", "b"], n=10, models=("cosine",), weights={"cosine_score": 1.0}, centers=cen)
    ins = P.insights(r, items, seeds, ["a", "b"], tags="g")
    assert set(ins) == {"feature_levels", "cluster_distribution", "pca", "year_histogram", "feature_profile", "tag_counts"}
    assert ins["feature_levels"].count() == 2 and ins["pca"].count() == 120
    assert ins["feature_profile"].where("series = 'seed mean'").count() == 2
    assert {r.tag for r in ins["tag_counts"].collect()} == {"pop", "rock", "jazz"}


def test_chain_on_text_ids_with_missing_values_and_filter(spark):
    rng = np.random.default_rng(5)
    rows = []
    for s in ("mix a", "mix b"):
        for i in range(120):
            a, b = (float(v) for v in rng.normal(size=2))
            rows.append((s, f"{s}:{i}", f"t{i}", f"o{i % 9}", 1990 + i % 20, a, None if i % 17 == 3 else b))
    items = spark.createDataFrame(rows, "set_id string, item_id string, name string, owner string, release_year int, a double, b double")
    seeds = items.where(F.substring_index("item_id", ":", -1).cast("int") % 10 == 0)  # test fixture
    r = P.recommend(items, seeds, ["a", "b"], n=10)
    assert r.recs.count() == 20
    # ridge inside the chain is ridge alone: no other model's filling reaches it
    alone = M.ridge_score(exclude_seen(items, seeds, "name", "owner"), seeds, ["a", "b"])
    want = {x.item_id: x.ridge_score for x in V.rescale_if_needed(alone, "ridge_score").collect()}
    got = {x.item_id: x.ridge_score for x in r.scored.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - v) < 1e-6 for k, v in want.items())
    close = P.recommend(items, seeds, ["a", "b"], n=10, similarity=0.6, models=("cosine", "glm"))
    kept = {x.item_id for x in close.scored.collect()}
    assert 0 < len(kept) < len(want) and not kept & {x.item_id for x in items.where("b IS NULL").collect()}


def test_prepare_joins_and_embeds(spark):
    items = spark.createDataFrame([("s", "1", "a", "x", "pop, rock", [1.0, 1.0]), ("s", "2", "A ", "x", "jazz", [9.0, 9.0]),
                                   ("s", "3", "y", "y", "jazz", [2.0, 2.0]), ("s", "4", "c", "z", "rock", [3.0, 3.0])],
                                  "set_id string, item_id string, name string, owner string, g string, v array<double>")
    seeds = spark.createDataFrame([("s", "p", "a", "X", None, None), ("s", "q", "new", "z", None, None)], items.schema)
    lk = spark.createDataFrame([("pop", [1.0, 0.0]), ("rock", [0.0, 1.0])], "tag string, vec array<double>")
    it, sd = P.prepare(items, seeds, name="name", owner="owner", order_by=["item_id"], tags="g", vec="v", lookup=lk, dim=2)
    assert {r.item_id for r in it.collect()} == {"1", "4"}  # a second "a" and the self-titled "y" go
    got = {r.item_id: (r.g, r.v) for r in sd.collect()}
    # one seed has no catalogue vector, so the whole set is embedded from its tags
    assert got == {"p": ("pop, rock", [0.5, 0.5]), "q": ("rock", [0.0, 1.0])}


def test_fused_chain_equals_its_operators(spark):
    """Every score of the fused chain against the operator that computes it alone, with missing values and vectors."""
    from seedrank.operators import cluster as K

    rng = np.random.default_rng(21)
    feats, rows = ["a", "b", "c"], []
    for s in ("p", "q"):
        for i in range(90):
            x = [None if rng.random() < 0.15 else float(v) for v in rng.normal(size=3) * [1, 40, 0.01] + [0, 900, 2]]
            vec = None if i % 13 == 5 else [float(v) for v in rng.normal(size=2)]
            rows.append((s, f"{s}{i}", f"t{i}", f"o{int(rng.integers(8))}", f"l{i % 3}", None if i % 19 == 2 else 1980 + i % 30, *x, vec))
    items = spark.createDataFrame(rows, "set_id string, item_id string, name string, owner string, label string, release_year int, a double, b double, c double, vec array<double>")
    seeds = items.where(F.substring("item_id", 2, 5).cast("int") % 9 == 0)  # test fixture: every ninth row
    cen = spark.createDataFrame([(s, i, c) for s in ("p", "q") for i, c in enumerate([[-1.0, 0.0, 0.0], [1.0, 1.0, 0.0], [0.0, -1.0, 1.0]])], "set_id string, idx int, center array<double>")
    roles = {"owner": "owner", "label": "label"}
    r = P.recommend(items, seeds, feats, n=12, models=("cosine", "ridge", "match", "nn"), match_roles=roles, centers=cen, vec="vec", dim=2, recency=0.3)
    got = {x.item_id: x for x in r.scored.collect()}

    cand = exclude_seen(items, seeds, "name", "owner")
    one = M.cosine_score(cand, seeds, feats).select("set_id", "item_id", "cosine_score")
    ridge = V.rescale_if_needed(M.ridge_score(cand, seeds, feats), "ridge_score").select("set_id", "item_id", "ridge_score")
    match = V.minmax_100(M.metadata_match(cand, seeds, roles, out="p"), "p", "glm_score", flat="glm")
    match = V.rescale_if_needed(match, "glm_score").select("set_id", "item_id", "glm_score")
    cz, sz = P.seed_scaled(cand, seeds, feats)
    ca, sa = K.assign_clusters(cz, cen, "zvec"), K.assign_clusters(sz, cen, "zvec")
    ca = V.rescale_if_needed(K.cluster_score(ca, sa), "cluster_score")
    wide = lambda df: df.withColumns({**{f"v{i}": F.col("vec")[i] for i in (0, 1)}, **{f"k{c}": (F.col("cluster") == c).cast("double") for c in "ABC"}})
    full = wide(ca).join(one, ["set_id", "item_id"]).join(ridge, ["set_id", "item_id"]).join(match, ["set_id", "item_id"])
    full = full.withColumn("has_match", (F.col("glm_score") > 0).cast("double"))
    inputs = [*feats, "v0", "v1", "kA", "kB", "kC"]
    scores = ["cosine_score", "ridge_score", "glm_score", "cluster_score"]
    alone = V.minmax_100(M.blended_similarity(full, wide(sa), inputs, scores, flag="has_match"), "blend_similarity", "nn_score", flat="keep").collect()
    assert len(alone) == len(got) == cand.count()
    for x in alone:
        y = got[x.item_id]
        assert y.cluster == x.cluster
        for s in ("cosine_score", "ridge_score", "glm_score", "cluster_score", "nn_score"):
            assert abs(x[s] - y[s]) < 1e-7, (s, x.item_id, x[s], y[s])
    recs = r.recs.collect()
    assert len(recs) == 24 and all(x.nn_score is not None for x in recs)


def test_chain_without_clusters_and_with_few_features(spark):
    rows = [(0, i, f"t{i}", "o", 1990 + i, float(i % 7), float(i % 5)) for i in range(60)]
    items = spark.createDataFrame(rows, "set_id int, item_id int, name string, owner string, release_year int, a double, b double")
    seeds = items.where("item_id < 6")  # test fixture: the first rows
    r = P.recommend(items, seeds, ["a", "b"], n=10, centers="none", models=("cosine", "ridge"))
    assert "cosine_score" not in r.scored.columns  # under three features the cosine is left out
    got = r.recs.orderBy("rank").collect()
    want = sorted(r.scored.collect(), key=lambda x: (-x.base_score, x.item_id))[:10]
    assert [x.item_id for x in got] == [x.item_id for x in want] and "cluster_score" not in r.scored.columns
    try:
        P.recommend(items, seeds, ["a", "b"], models=("ridge", "nn"))
        raise AssertionError("the blend must not run without its scores")
    except ValueError:
        pass
