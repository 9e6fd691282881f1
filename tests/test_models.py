import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from seedrank.operators import boost as B
from seedrank.operators import clean as C
from seedrank.operators import cluster as K
from seedrank.operators import logistic as L
from seedrank.operators import score as M
from seedrank.operators import select as R
from seedrank.operators import vectors as V

RNG = np.random.default_rng(7)


def frames(spark, n=60, m=8, p=4):
    X = RNG.normal(size=(n, p)) * [1, 5, 0.1, 2] + [0, 10, 1, -3]
    S = RNG.normal(size=(m, p)) * [1, 5, 0.1, 2] + [1, 12, 1, -2]
    cols = [f"f{i}" for i in range(p)]
    items = spark.createDataFrame([(0, i, *map(float, x)) for i, x in enumerate(X)], "set_id int, id int, " + ", ".join(f"{c} double" for c in cols))
    seeds = spark.createDataFrame([(0, 1000 + i, *map(float, x)) for i, x in enumerate(S)], "set_id int, id int, " + ", ".join(f"{c} double" for c in cols))
    return items, seeds, X, S, cols


def test_cosine_score_matches_numpy(spark):
    items, seeds, X, S, cols = frames(spark)
    got = np.array([r.cosine_similarity for r in M.cosine_score(items, seeds, cols).orderBy("id").collect()])
    c = S.mean(0)
    fit = np.vstack([X, c])
    mu, sd = fit.mean(0), fit.std(0)
    Z, t = (X - mu) / sd, (c - mu) / sd
    want = Z @ t / (np.linalg.norm(Z, axis=1) * np.linalg.norm(t))
    assert np.allclose(got, want, atol=1e-9)


def test_ridge_matches_numpy_closed_form(spark):
    items, seeds, X, S, cols = frames(spark)
    got = np.array([r.ridge_fitness for r in M.ridge_score(items, seeds, cols).orderBy("id").collect()])
    A = np.vstack([S, X])
    y = np.r_[np.ones(len(S)), np.zeros(len(X))]
    mu, sd = A.mean(0), A.std(0)
    Z = (A - mu) / sd
    Zc, yc = Z - Z.mean(0), y - y.mean()
    w = np.linalg.solve(Zc.T @ Zc + np.eye(Z.shape[1]), Zc.T @ yc)
    b = y.mean() - Z.mean(0) @ w
    want = b + ((X - mu) / sd) @ w
    assert np.allclose(got, want, atol=1e-9)


def test_metadata_match_weights(spark):
    items = spark.createDataFrame([(0, 1, "a", "x", "l"), (0, 2, "b", "x", "m")], "set_id int, id int, owner string, album string, label string")
    seeds = spark.createDataFrame([(0, "a", "y", "l")], "set_id int, owner string, album string, label string")
    got = {r.id: r.match_score for r in M.metadata_match(items, seeds, {"owner": "owner", "album": "album", "label": "label"}).collect()}
    assert abs(got[1] - 0.7 / 0.9) < 1e-12 and got[2] == 0.0


def test_blend_weights_equal_repeated_columns(spark):
    items, seeds, X, S, cols = frames(spark, p=4)
    items = items.withColumn("sc", F.col("f0") * 2 + 1)
    got = np.array([r.blend_similarity for r in M.blended_similarity(items, seeds, cols[:3], ["sc"], emphasis={"sc": 3}).orderBy("id").collect()])
    sc = X[:, 0] * 2 + 1
    Xi = np.c_[X[:, :3], sc, sc, sc]
    Si = np.c_[S[:, :3], np.full((len(S), 3), sc.mean())]
    A = np.vstack([Xi, Si])
    mu, sd = A.mean(0), A.std(0)
    Z, t = (Xi - mu) / sd, ((Si - mu) / sd).mean(0)
    want = Z @ t / (np.linalg.norm(Z, axis=1) * np.linalg.norm(t))
    assert np.allclose(got, want, atol=1e-9)


def test_knee_on_hand_curves(spark):
    curves = {"bend": [100, 30, 12, 10, 9, 8, 7, 6, 5, 4], "line": list(range(100, 0, -10)), "flat": [5] * 10, "two": [3, 1]}
    rows = [(s, k, float(v)) for s, ys in curves.items() for k, v in enumerate(ys, 1)]
    got = {r.set_id: r.optimal_k for r in K.knee(spark.createDataFrame(rows, "set_id string, k int, wcss double")).collect()}
    # a straight line has at most rounding bumps, a flat or two-point curve no knee: the default
    assert got["bend"] == 3 and got["flat"] == got["two"] == K.DEFAULT_K


def test_kmeans_multi_planted_blobs(spark):
    centers = np.array([[0, 0], [10, 0], [0, 10]], float)
    pts = np.vstack([c + RNG.normal(scale=0.3, size=(30, 2)) for c in centers])
    df = spark.createDataFrame([(0, i, [float(a), float(b)]) for i, (a, b) in enumerate(pts)], "set_id int, id int, x array<double>")
    cen, cost = K.kmeans_multi(df, "x", "id", 2)
    w = sorted((r.k, r.wcss) for r in cost.collect())
    assert all(w[i][1] >= w[i + 1][1] - 1e-6 for i in range(2)) and w[0][1] > 10 * w[2][1]
    assert K.knee(cost).first().optimal_k == 3


def test_kmeans_text_ids_and_convergence(spark):
    pts = RNG.normal(size=(120, 2))
    rows = [(f"s{i % 2}", f"track-{i}", [float(a), float(b)]) for i, (a, b) in enumerate(pts)]
    df = spark.createDataFrame(rows, "set_id string, id string, x array<double>")
    cen, cost = K.kmeans_multi(df, "x", "id", 2, ks=(1, 3, 5))
    assert cost.where("NOT converged").count() == 0 and cost.count() == 6
    for k in (3, 5):  # a settled fit: each centre is the mean of its points
        for s in ("s0", "s1"):
            c = np.array([r.center for r in cen.where((cen.k == k) & (cen.set_id == s)).orderBy("idx").collect()])
            x = np.array([r[2] for r in rows if r[0] == s])
            near = ((x[:, None] - c[None]) ** 2).sum(-1).argmin(1)
            assert np.allclose(c, [x[near == j].mean(0) for j in range(len(c))], atol=1e-5)


def test_kmeans_of_a_task_equals_the_fit_by_rounds(spark, monkeypatch):
    rng = np.random.default_rng(9)
    pts = np.vstack([rng.normal(size=(90, 2)), rng.integers(0, 3, size=(60, 2)), [[5.0, 5.0]] * 4])
    rows = [(i % 2, f"t{i}", [float(a), float(b)]) for i, (a, b) in enumerate(pts)] + [(2, "one", [1.0, 2.0]), (None, "none", [0.0, 0.0])]
    df = spark.createDataFrame(rows, "set_id int, id string, x array<double>")

    def fits(**how):
        cen, cost = K.kmeans_multi(df, "x", "id", 2, ks=(1, 4), **how)
        return ({(r.set_id, r.k, r.idx): r.center for r in cen.collect()}, {(r.set_id, r.k): (r.wcss, r.converged) for r in cost.collect()})
    by_rounds = fits(max_entries=0)
    with monkeypatch.context() as m:
        m.setattr(K, "_lloyd_round", None)  # sets that a task holds need no round of jobs
        by_task = fits()
    for a, b in zip(by_task, by_rounds):
        assert a.keys() == b.keys() and all(np.allclose(np.array(a[x], float), np.array(b[x], float), atol=1e-9) for x in a)
    assert set(by_task[1]) == {(s, k) for s in (0, 1, 2) for k in (1, 4)}


def test_assign_clusters_and_score(spark):
    cen = spark.createDataFrame([(0, 0, [0.0, 0.0]), (0, 1, [10.0, 0.0])], "set_id int, idx int, center array<double>")
    items = spark.createDataFrame([(0, 1, [1.0, 0.0]), (0, 2, [9.0, 1.0]), (0, 3, [5.0, 0.0])], "set_id int, id int, x array<double>")
    a = {r.id: r.cluster for r in K.assign_clusters(items, cen, "x").collect()}
    assert a == {1: "A", 2: "B", 3: "A"}  # tie → smaller index
    seeds = spark.createDataFrame([(0, "A"), (0, "A"), (0, "B"), (0, "B")], "set_id int, cluster string")
    s = {r.id: r.cluster_score for r in K.cluster_score(K.assign_clusters(items, cen, "x"), seeds).collect()}
    assert s == {1: 50.0, 2: 50.0, 3: 50.0}


def test_quota_half_even_and_remainder(spark):
    seeds = spark.createDataFrame([(0, "A")] * 5 + [(0, "B")] * 3 + [(0, "C")] * 0 + [(0, "D")], "set_id int, cluster string")
    q = {r.cluster: r.quota for r in R.cluster_quota(seeds, "cluster", 100).collect()}
    # shares 5/9, 3/9, 1/9 → 56, 33, 11 (sum 100)
    assert q == {"A": 56, "B": 33, "D": 11}
    seeds2 = spark.createDataFrame([(0, "A")] * 1 + [(0, "B")] * 7, "set_id int, cluster string")
    q2 = {r.cluster: r.quota for r in R.cluster_quota(seeds2, "cluster", 4).collect()}
    # 0.5 → 0 (half-even) → max(1, 0) = 1; 3.5 → 4; sum 5 → largest gives back 1
    assert q2 == {"A": 1, "B": 3}


def test_select_by_quota_backfills(spark):
    items = spark.createDataFrame([(0, i, "A" if i < 3 else "B", float(i)) for i in range(6)], "set_id int, item_id int, cluster string, base_score double")
    quota = spark.createDataFrame([(0, "A", 3), (0, "B", 1), (0, "C", 2)], "set_id int, cluster string, quota int")
    got = [(r.item_id, r.rank) for r in R.select_by_quota(items, quota, n=6).orderBy("rank").collect()]
    # B gives its best (5); A gives 2, 1, 0; C has no rows; backfill 4, 3 → all six, by score
    assert [g[0] for g in got] == [5, 4, 3, 2, 1, 0]


def _glm_frames(spark, sets, rng):
    rows = []
    for s in sets:
        for i in range(150):
            rows.append((s, f"{s}-{i}", f"o{rng.integers(0, 12)}", "pop" if rng.random() < 0.4 else "rock", float(rng.normal()), i % 10 == 0))
    df = spark.createDataFrame(rows, "set_id string, item_id string, owner string, label string, a double, seed boolean")
    return df.where("NOT seed").drop("seed"), df.where("seed").drop("seed")


def test_metadata_glm_is_fitted_per_set(spark):
    rng = np.random.default_rng(3)
    a_items, a_seeds = _glm_frames(spark, ["A"], rng)
    b_items, b_seeds = _glm_frames(spark, ["B"], rng)
    score = lambda i, s: {r.item_id: r.glm_score for r in M.metadata_glm(i, s, ["a"], ["owner", "label"]).collect()}
    alone = score(a_items, a_seeds)
    both = score(a_items.union(b_items), a_seeds.union(b_seeds))
    assert all(abs(both[k] - v) < 1e-6 for k, v in alone.items()) and len(both) == 270

    # a dense fit of set A: gradient of the same objective, Newton steps
    it, sd = a_items.toPandas(), a_seeds.toPandas()
    n = len(it)
    for c in ("owner", "label"):
        it.loc[~it[c].isin(sd[c]), c] = "????"
    num = np.r_[it.a, sd.a]
    x = [np.ones(n + len(sd)), (num - num.mean()) / num.std()]
    for c in ("owner", "label"):
        v = np.r_[it[c], sd[c]]
        x += [(v == u).astype(float) for u in sorted(set(v))] + [np.isin(v, list(sd[c])).astype(float)]
    x, y = np.array(x).T, np.r_[np.zeros(n), np.ones(len(sd))]
    w = np.where(y == 1, M.SEED_UPSAMPLE, 1.0) / (n + M.SEED_UPSAMPLE * len(sd))
    beta, pen = np.zeros(x.shape[1]), np.r_[0.0, np.full(x.shape[1] - 1, M.GLM_RIDGE)]
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        beta -= np.linalg.solve((x.T * (w * p * (1 - p))) @ x + np.diag(pen), x.T @ (w * (p - y)) + pen * beta)
    p = 1 / (1 + np.exp(-x[:n] @ beta))
    want = (p - p.min()) / (p.max() - p.min()) * 100
    assert np.allclose([alone[k] for k in it.item_id], want, atol=1e-5)


def test_metadata_glm_of_wide_sets_equals_the_dense_fit(spark):
    items, seeds = _glm_frames(spark, ["A", "B"], np.random.default_rng(4))
    score = lambda **how: {r.item_id: r.glm_score for r in M.metadata_glm(items, seeds, ["a"], ["label"], **how).collect()}
    whole, wide = score(), score(max_entries=2)  # 2: no set is gathered
    assert whole.keys() == wide.keys() and max(abs(wide[k] - v) for k, v in whole.items()) < 1e-4


def test_logistic_fit_of_many_inputs_settles():
    rng, n, wide = np.random.default_rng(6), 120_000, 50_000
    at = np.concatenate([np.zeros(n, np.int64), 1 + rng.integers(0, wide - 1, n), 1 + rng.integers(0, 50, n)])
    row = np.tile(np.arange(n), 3)
    x = L.Rows(row, at, np.ones(3 * n), n)
    y = (rng.random(n) < 0.2).astype(float)
    b = L.fit_rows(x, y, np.ones(n), wide, 0.01, 50)
    p = 1 / (1 + np.exp(-x.times(b)))
    gradient = x.back(p - y, wide) / n + np.r_[0.0, np.full(wide - 1, 0.01)] * b
    assert np.abs(gradient).max() < 1e-9 and np.abs(b).max() > 0


def test_inputs_are_numbered_in_buckets(spark):
    rows = spark.createDataFrame([(s, [(f"n{i}", 1.0) for i in range(s * 40)]) for s in (1, 2)], "s int, __f array<struct<name:string,v:double>>")
    got = L.numbered_inputs(rows, "s").collect()
    for s in (1, 2):
        own = {r.name: r.i for r in got if r.s == s}
        assert len(own) == s * 40 and sorted(own.values()) == list(range(1, s * 40 + 1))


def test_conjugate_gradient_solves_a_sparse_system():
    rng, n = np.random.default_rng(5), 500
    rows = [np.r_[0, 1 + rng.integers(0, 400), 401 + rng.integers(0, 99)] for _ in range(3000)]
    h = np.diag(np.r_[0.0, np.full(n - 1, 0.01)])
    for r in rows:
        h[np.ix_(r, r)] += rng.random() / len(rows)
    rhs = rng.normal(size=n)
    got = L.conjugate_gradient(lambda d: h @ d, np.diag(h).copy(), rhs)
    assert np.allclose(got, np.linalg.solve(h, rhs), rtol=0, atol=1e-8)


# ---------------------------------------------------------------- boosted trees per set

def _boost_frame(spark, sets, n=160, p=5):
    rows = []
    for s in sets:
        rng = np.random.default_rng(ord(s))
        x = rng.normal(size=(n, p))
        y = x[:, 0] + np.sin(2 * x[:, 1]) + 0.5 * x[:, 0] * x[:, 2]
        rows += [(s, f"{s}{i}", [float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "set_id string, item_id string, z array<double>, y double").repartition(5)


def test_boosted_trees_are_fitted_per_set_and_follow_the_target(spark):
    fit = lambda df, **how: {r.item_id: r.prediction for r in B.boosted_predictions(df, "z", "y", **how).collect()}
    alone, both = fit(_boost_frame(spark, "A")), fit(_boost_frame(spark, "AB"))
    assert len(both) == 320 and all(abs(both[k] - v) < 1e-12 for k, v in alone.items())
    rows = {r.item_id: r.y for r in _boost_frame(spark, "AB").collect()}
    for s in "AB":
        k = [i for i in rows if i[0] == s]
        rank = lambda v: np.argsort(np.argsort(v))
        assert np.corrcoef(rank([rows[i] for i in k]), rank([both[i] for i in k]))[0, 1] >= 0.9


def test_sets_that_no_task_holds_get_the_same_trees(spark):
    shape = B.Shape(trees=3, depth=2, rate=0.3)
    df = _boost_frame(spark, "ABC", n=60, p=3)
    fit = lambda **how: {r.item_id: r.prediction for r in B.boosted_predictions(df, "z", "y", shape=shape, **how).collect()}
    whole, wide = fit(), fit(max_rows=10)
    assert whole.keys() == wide.keys() and len(wide) == 180 and max(abs(wide[k] - v) for k, v in whole.items()) < 1e-9


# ---------------------------------------------------------------- dictionaries, principal components

def test_seen_flags_packed_and_joined_alike(spark):
    items = spark.createDataFrame([(s, i, f"o{i % 7}", None if i % 5 == 0 else f"a{i % 11}", i % 4) for s in (0, 1, 2) for i in range(60)],
                                  "set_id int, id int, owner string, album string, n int")
    seeds = spark.createDataFrame([(0, "o1", "a3", 2), (0, None, "o2", 3), (1, "o6", None, None)], "set_id int, owner string, album string, n int")
    cols = ["owner", "album", "n"]
    got = [C.with_seen_flags(items, seeds, cols, wide=w).select("set_id", "id", *[f"{c}_in_seeds" for c in cols]).collect() for w in (100, 0)]
    assert sorted(map(tuple, got[0])) == sorted(map(tuple, got[1])) and len(got[0]) == 180
    want = {(s, i): (int((s, i % 7) in {(0, 1), (1, 6)}), int(s == 0 and i % 5 != 0 and i % 11 == 3), int(s == 0 and i % 4 in (2, 3))) for s in (0, 1, 2) for i in range(60)}
    assert {(r[0], r[1]): tuple(r[2:]) for r in got[0]} == want


def test_exact_medians_of_several_columns(spark):
    rng = np.random.default_rng(8)
    rows = [(s, *(None if rng.random() < 0.2 else float(rng.integers(0, 9)) for _ in range(3))) for s in (0, 1) for _ in range(41 + s)] + [(2, None, 1.0, 4.0), (2, None, 2.0, None)]
    df = spark.createDataFrame(rows, "set_id int, a double, b double, c double")
    for accuracy in (100_000, 4):
        got = {r.set_id: [r["__med_a"], r["__med_b"], r["__med_c"]] for r in C.exact_medians(df, ["a", "b", "c"], accuracy=accuracy).collect()}
        for s in (0, 1, 2):
            for j in range(3):
                v = [r[1 + j] for r in rows if r[0] == s and r[1 + j] is not None]
                assert (got[s][j] is None and not v) or got[s][j] == np.median(v)


def test_pca_is_per_set_and_equals_svd(spark):
    rng = np.random.default_rng(9)
    data = {s: rng.normal(size=(30, 3)) * [5, 2, 1] + s for s in (0, 1)}
    rows = [(s, i, *map(float, x)) for s, m in data.items() for i, x in enumerate(m)] + [(2, i, 1.0, 2.0, 3.0) for i in range(5)] + [(0, 99, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "set_id int, id int, a double, b double, c double")
    got = V.pca_2d(df, ["a", "b", "c"], ["set_id", "id"]).collect()
    assert {r.set_id for r in got} == {0, 1} and len(got) == 60  # too few rows: no view
    for s, m in data.items():
        _, sv, vt = np.linalg.svd(m - m.mean(0), full_matrices=False)
        load = vt[:2] * np.where(vt[np.arange(2), np.abs(vt[:2]).argmax(axis=1)] < 0, -1, 1)[:, None]
        own = sorted((r for r in got if r.set_id == s), key=lambda r: r.id)
        assert np.allclose([[r.pc1, r.pc2] for r in own], (m - m.mean(0)) @ load.T) and np.allclose([own[0].explained1, own[0].explained2], (sv ** 2 / (sv ** 2).sum())[:2])
    one = V.pca_2d(df.where("set_id = 1").drop("set_id"), ["a", "b", "c"], ["id"]).collect()
    assert np.allclose(sorted(r.pc1 for r in one), sorted(r.pc1 for r in got if r.set_id == 1))


def test_boosted_sets_are_gathered_by_bytes_not_rows(spark, monkeypatch):
    monkeypatch.setattr(B, "_wide_predictions", lambda *a: pytest.fail("a set of few bytes was fitted in passes"))
    n = 200_100
    df = spark.range(n).select(F.lit(1).alias("set_id"), F.col("id").alias("item_id"), F.array((F.col("id") % 7).cast("double") - 3).alias("z"), (F.col("id") % 7 > 3).cast("double").alias("y"))
    got = B.boosted_predictions(df, "z", "y", shape=B.Shape(trees=1, depth=1, rate=1.0, features=1.0)).groupBy(F.col("item_id") % 7 > 3).agg(F.count("*"), F.avg("prediction")).collect()
    assert sum(r[1] for r in got) == n and all(abs(r[2] - float(r[0])) < 0.01 for r in got)


def test_bins_are_read_from_buffers_and_histograms_add_up():
    rows = [bytes([i % 32, (3 * i) % 32]) for i in range(50)]
    column = pa.chunked_array([pa.array(rows[:20], pa.binary()), pa.array(rows, pa.binary()).slice(20)])
    x = B._matrix(column)
    assert x.tolist() == [list(r) for r in rows]
    g, node = np.arange(50.0), np.arange(50) % 2
    h = B.histogram(x, g, node, 2, np.array([1]))
    assert h.shape == (2, 2, 1, 32) and h[1].sum() == 50 and h[0, 1, 0, 9] == sum(i for i in range(50) if i % 2 and 3 * i % 32 == 9)


def test_logistic_inputs_are_numbered_chunk_by_chunk():
    kind = pa.list_(pa.struct([("name", pa.string()), ("v", pa.float64())]))
    rows = [[("b", 1.0), ("a", 2.0)], [], [("c", 3.0)], [("a", 4.0), ("c", 5.0)]]
    lists = [[{"name": k, "v": v} for k, v in r] for r in rows]
    x, inputs = L._numbered_rows(pa.chunked_array([pa.array(lists[:2], kind), pa.array(lists, kind).slice(2)]), 4)
    assert inputs == 4 and x.row.tolist() == [0, 1, 2, 3, 0, 0, 2, 3, 3]
    assert x.at.tolist() == [0, 0, 0, 0, 2, 1, 3, 1, 3] and x.v.tolist() == [1, 1, 1, 1, 1, 2, 3, 4, 5]


def test_a_fitted_filter_writes_bins_not_vectors(spark, monkeypatch):
    written, real = {}, B.materialize
    for module in (B, M):
        monkeypatch.setattr(module, "materialize", lambda df, name: written.setdefault(name, dict(df.dtypes)) and real(df, name))
    rng = np.random.default_rng(8)
    rows = [(s, f"{s}{i}", f"n{i}", [float(v) for v in rng.normal(size=4)]) for s in "AB" for i in range(40)]
    items = spark.createDataFrame(rows, "set_id string, item_id string, name string, x array<double>")
    seeds = items.where("item_id LIKE '%7'")
    fit = lambda **how: M.similarity_filter(items, seeds, "x", 4, threshold=None, filter_on="model", shape=B.Shape(trees=5), **how)
    few = fit(keep=["set_id", "item_id", "name"])
    assert written["boost_rows"][B.BINNED] == "binary" and not any(t.startswith("array") for n, kinds in written.items() for t in kinds.values() if n != "filter_stats")
    every = fit()
    assert few.columns == ["set_id", "item_id", "name", "similarity_score", "fit_probability"] and every.columns == [*items.columns, "similarity_score", "fit_probability"]
    found = lambda df: {r.item_id: (r.name, r.similarity_score, r.fit_probability) for r in df.collect()}
    a, b = found(few), found(every)
    assert len(a) == 80 and a.keys() == b.keys() and all(a[k][0] == b[k][0] and np.allclose(a[k][1:], b[k][1:], atol=1e-9) for k in a)


def test_a_set_is_fitted_in_the_bytes_that_are_counted_for_it():
    import tracemalloc

    rng = np.random.default_rng(9)
    n, p = 20_000, 70
    x, y, h = np.asfortranarray(rng.integers(0, 32, (n, p)).astype(np.uint8)), rng.normal(size=n), rng.integers(0, 1 << 62, n).astype(np.uint64)
    tracemalloc.start()
    B.fit_one(x, y, h, B.Shape(trees=2))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < n * B.ROW_BYTES and B.MAX_BYTES / (2 * p + B.ROW_BYTES) > 2_200_000  # no copies of the bins
    chunks = pa.table({B.BINNED: pa.chunked_array([pa.array([r.tobytes() for r in x[:300]], pa.binary()), pa.array([r.tobytes() for r in x[300:500]], pa.binary())])})
    place = rng.permutation(500)
    got = B._by_feature(chunks, place)
    assert got.flags.f_contiguous and (got[place] == x[:500]).all()


def test_sets_of_many_rows_are_fitted_from_hashes_of_their_names(spark, monkeypatch):
    assert L.MAX_ENTRIES > 24_000_000  # a set of 2.2 million rows of ten entries
    kind, valued = pa.list_(pa.int64()), pa.list_(pa.struct([("i", pa.int64()), ("v", pa.float64())]))
    rng, n = np.random.default_rng(3), 400
    cat, z, flag = rng.integers(0, 9, n), rng.normal(size=n), rng.random(n) < 0.5
    ones = [[1000 - c * 7, *([55] if f else [])] for c, f in zip(cat.tolist(), flag)]
    rest = [[{"i": -4, "v": float(v)}] if v > -1 else [] for v in z]
    chunked = lambda rows, t: pa.chunked_array([pa.array(rows[:150], t), pa.array(rows, t).slice(150)])
    y, w = (rng.random(n) < 0.3).astype(float), np.where(rng.random(n) < 0.2, 5.0, 1.0)
    monkeypatch.setattr(L, "BLOCK_ENTRIES", 70)
    x = L.Blocks(chunked(ones, kind), chunked(rest, valued), n)
    names = sorted({1000 - c * 7 for c in cat.tolist()} | {55, -4})
    dense = np.zeros((n, len(names) + 1))
    dense[:, 0] = 1
    for i in range(n):
        for h in ones[i]:
            dense[i, 1 + names.index(h)] = 1
        for e in rest[i]:
            dense[i, 1 + names.index(e["i"])] = e["v"]
    b = rng.normal(size=x.inputs)
    assert len(x.parts) > 10 and np.allclose(x.times(b), dense @ b) and np.allclose(x.back(y), dense.T @ y) and np.allclose(x.square(w), (dense ** 2).T @ w)
    found = x.fit(y, w, 0.01, 50)
    p = 1 / (1 + np.exp(-dense @ found))
    assert np.abs(dense.T @ (w * (p - y)) / w.sum() + 0.01 * np.r_[0.0, found[1:]]).max() < 1e-9

    items, seeds = _glm_frames(spark, ["A", "B"], np.random.default_rng(4))
    score = lambda: {r.item_id: r.glm_score for r in M.metadata_glm(items, seeds, ["a"], ["owner", "label"]).collect()}
    with monkeypatch.context() as m:
        m.setattr(L, "_numbered_rows", lambda *a: pytest.fail("names were gathered"))
        hashed = score()
    with monkeypatch.context() as m:
        m.setattr(L.F, "xxhash64", lambda *c: F.lit(1).cast("long"))  # all names share a hash: they are gathered as texts
        m.setattr(L, "Blocks", lambda *a: pytest.fail("unlike names were taken for one"))
        named = score()
    assert hashed.keys() == named.keys() and max(abs(named[k] - v) for k, v in hashed.items()) < 1e-6
