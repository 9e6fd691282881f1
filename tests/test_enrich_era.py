from pyspark.sql import functions as F

from seedrank.operators import enrich as J
from seedrank.operators import era as E


def test_exclude_seen_null_safe(spark):
    items = spark.createDataFrame([(0, "a", "x"), (0, None, "x"), (0, "b", "y"), (1, "a", "x")], "set_id int, name string, owner string")
    seeds = spark.createDataFrame([(0, "A", "X"), (0, None, "z")], "set_id int, name string, owner string")
    got = sorted((r.set_id, str(r.name)) for r in J.exclude_seen(items, seeds, "name", "owner").collect())
    # key of a NULL name is NULL on both sides: null-safe equality removes it (isin semantics)
    assert got == [(0, "b"), (1, "a")]


def test_fill_tags_by_owner_with_fallback(spark):
    cat = spark.createDataFrame([("Ann", "pop, Rock"), ("ann", "rock,jazz"), ("Bob", "metal"), ("Ann", None)], "owner string, tags string")
    tg = spark.createDataFrame([(1, "ANN", None), (2, "Bob, Carl", ""), (3, "Zed", None), (4, "Ann", "kept")], "id int, owner string, tags string")
    got = {r.id: r.tags for r in J.fill_tags_by_owner(tg, cat, "owner", "tags").collect()}
    assert got == {1: "rock, jazz, pop", 2: "metal", 3: None, 4: "kept"}


def test_lookup_vectors_variants_and_repeats(spark):
    lk = spark.createDataFrame([("indie-pop", [1.0, 0.0]), ("hip hop", [0.0, 2.0]), ("indie pop", [9.0, 9.0])], "tag string, vec array<double>")
    rows = spark.createDataFrame([(1, ["indie pop", "hip-hop", "hip-hop"]), (2, ["nothing"]), (3, [])], "id int, tags array<string>")
    got = {r.id: r.vec for r in J.lookup_vectors(rows, ["id"], "tags", lk, 2).collect()}
    # 'indie pop' is found as is (first variant) → [9, 9]; 'hip-hop' via dashes→blanks, twice
    assert got[1] == [3.0, 13.0 / 3.0]
    assert got[2] == [0.0, 0.0] and got[3] == [0.0, 0.0]


def test_enrich_from_items(spark):
    items = spark.createDataFrame([(0, "s", "a", 2, "pop", [1.0]), (0, "s", "a", 1, "rock", None)], "set_id int, name string, owner string, id int, tags string, vec array<double>")
    seeds = spark.createDataFrame([(0, "S", "A", None, [5.0]), (0, "t", "a", "jazz", None)], "set_id int, name string, owner string, tags string, vec array<double>")
    got = {r.name: (r.tags, r.vec) for r in J.enrich_from_items(seeds, items, "name", "owner", "tags", "vec", ["id"]).collect()}
    assert got == {"S": ("rock", [5.0]), "t": ("jazz", None)}  # first match (id 1) has no vector → keep own


def _era(spark, seed_years, item_years):
    seeds = spark.createDataFrame([(0, y) for y in seed_years], "set_id int, release_year int")
    items = spark.createDataFrame([(0, i, y) for i, y in enumerate(item_years)], "set_id int, id int, release_year int")
    p = E.era_params(seeds)
    return p.first(), {r.id: r for r in E.apply_era(items, p).collect()}


def test_era_classes_and_penalties(spark):
    p, rows = _era(spark, [2020, 2021, 2022], [2021, 2024, 1990])
    assert p.era_class == "recent" and p.avg_year == 2021
    assert rows[1].recency_bonus == (2024 - 2019) / 6 * 15 and abs(rows[1].year_adjustment - (3 / 20 * 25 - 12.5)) < 1e-12
    assert rows[2].year_penalty == 25.0 and rows[2].year_adjustment == 25.0
    p, rows = _era(spark, [1981, 1983, 1985, 1987, 1999], [1986, 1997, None])
    assert p.era_class == "decade" and p.focus_decade == 1980
    assert rows[1].year_penalty == 40.0 and rows[1].adj_bin is None  # exactly 40: no bin
    assert rows[2].year_penalty is None and rows[2].year_adjustment is None
    p, _ = _era(spark, [1990, 1992, 1995, 2000, 2001], [1995])
    assert p.era_class == "tight"
    p, _ = _era(spark, [1960, 1980, 2000, 2010], [1995])
    assert p.era_class == "standard"
    p, _ = _era(spark, [1975], [1975])
    assert p.era_class == "decade"  # one dated seed: 100 % in its decade


def test_adjustment_bins_labels(spark):
    df = spark.createDataFrame([(v,) for v in [-10.0, -5.0, 0.0, 4.9, 5.0, 19.0, 39.9, 40.0]], "a double")
    o, lab = E.adjustment_bin(F.col("a"))
    got = [tuple(r) for r in df.select(o, lab).collect()]
    assert got == [(0, "Bonus 5-10%"), (1, "Bonus 0-5%"), (2, "No adj."), (2, "No adj."), (3, "0-5%"), (4, "5-10%"), (6, "20-30%"), (None, None)]


def test_user_recency(spark):
    df = spark.createDataFrame([(0, 2000, 10.0), (0, 2025, 10.0)], "set_id int, release_year int, s double")
    got = [r.s for r in E.user_recency(df, "s", 0.5).orderBy("release_year").collect()]
    assert got == [10.0, 15.0]


def test_t8_lists_show_the_extreme_rows_by_rank(spark, monkeypatch):
    import seedrank.plans.queries  # noqa: F401  registers the modules in their order
    from seedrank.plans import q_stats

    seeds = spark.createDataFrame([(1, 1, 2024), (2, 1, 2024)], "item_id long, set_id int, release_year int")
    years = {i: 1950 + i for i in range(1, 9)} | {i: 2014 + i for i in range(9, 12)}
    cat = spark.createDataFrame([(i, 1, y) for i, y in years.items()], "item_id long, set_id int, release_year int")
    monkeypatch.setattr(q_stats, "recent_tables", lambda s, d: (cat, seeds))
    far = sorted((r["rank"], r["item_id"], r["year_distance"], r["n_max_penalty"]) for r in q_stats.extreme_penalty(spark, "").collect())
    assert far == [(k, k, 2024 - years[k], 8) for k in range(1, 6)]
    high = sorted((r["rank"], r["item_id"], r["n_high_bonus"]) for r in q_stats.high_bonus(spark, "").collect())
    assert high == [(1, 11, 3), (2, 10, 3), (3, 9, 3)]


def test_mark_seen_flags_what_exclude_seen_drops(spark):
    items = spark.createDataFrame([(1, 1, "A", "x"), (2, 1, "b", "y"), (3, 1, None, "z"), (4, None, "a", "x"), (5, 2, "a", "x")], "item_id int, set_id int, name string, owner string")
    seeds = spark.createDataFrame([(1, "a", "X"), (1, "a", "X"), (1, None, "q"), (None, "a", "x")], "set_id int, name string, owner string")
    marked = J.mark_seen(items, seeds, "name", "owner")
    kept = {r.item_id for r in J.exclude_seen(items, seeds, "name", "owner").collect()}
    assert {r.item_id for r in marked.where("NOT seen").collect()} == kept == {2, 4, 5} and marked.count() == 5


def test_order_vectors_are_pooled_where_the_lines_lie(spark, tmp_path):
    from seedrank.plans import driver_views as DV

    lines = [(o, s) for o in range(40) for s in ((o % 5, 1, 1) if o % 4 else (9, None))]
    spark.createDataFrame(lines, "l_orderkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    vecs = {0: [1.0, 2.0], 1: [3.0, 5.0], 2: [0.5, 0.0], 3: [2.0, 2.0], 4: [7.0, 1.0]}
    for extra, name in (([], "plain"), ([(1, [None, 4.0])], "null entry")):
        spark.createDataFrame([*vecs.items(), *extra], "vec_id long, embedding array<float>").write.mode("overwrite").parquet(f"{tmp_path}/embeddings.parquet")
        df = DV.item_vectors(spark, str(tmp_path), 2)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan  # thin lines, never half-pooled vectors
        got = {r.item_id: r.vec for r in df.collect()}
        for o in range(40):
            own = [v for t, s in lines if t == o for k, v in [*vecs.items(), *extra] if k == s]
            want = [[v[i] for v in own if v[i] is not None] for i in (0, 1)]
            assert (o in got) == bool(own) and (not own or all(abs(got[o][i] - sum(want[i]) / len(want[i])) < 1e-9 for i in (0, 1)))


def test_looked_up_vectors_are_pooled_where_the_tags_lie(spark):
    pairs = spark.createDataFrame([(i, j, t) for i in range(6) for j, t in enumerate(("a b", "c", "none")[: i % 4])], "id int, pos int, tag string")
    lookup = spark.createDataFrame([("a-b", [1.0, 2.0]), ("c", [3.0, 6.0])], "tag string, vec array<double>")
    df = J.lookup_vector_pairs(pairs, ["id"], "pos", "tag", lookup, 2)
    assert df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(id") == 1  # texts, no half-pooled vectors
    assert {r.id: r.vec for r in df.collect()} == {1: [1.0, 2.0], 2: [2.0, 4.0], 3: [2.0, 4.0], 5: [1.0, 2.0]}


def test_looked_up_vectors_that_are_not_broadcast_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(J, "bounded_broadcast", lambda df: df)  # as for more vectors than a broadcast holds
    lookup = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, None]), ("c", [5.0, 9.0]), ("none", None)], "tag string, vec array<float>")
    ids = [(x, i) for x in ("p", None, "q") for i in range(5)]
    pairs = spark.createDataFrame([(x, i, j, t) for x, i in ids for j, t in enumerate((["a"], ["a", "b", "b"], ["none"], ["missing"], ["c", "none", "a"] * 9)[i])],
                                  "x string, i int, pos int, tag string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")  # an id's rows come in several batches
    try:
        df = J.lookup_vector_pairs(pairs, ["x", "i"], "pos", "tag", lookup, 2)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "__vec" not in plan
        got = {(r.x, r.i): r.vec for r in df.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = [[1.0, 2.0], [7.0 / 3, 2.0 / 3], [None, None], None, [3.0, 5.5]]
    assert got == {(x, i): want[i] for x, i in ids if want[i] is not None}


def test_vectors_are_broadcast_by_their_measured_bytes(spark):
    from seedrank.functions import params

    df = spark.range(50).select("id", F.array(*[F.lit(0.5).cast("float")] * 8).alias("v"))
    assert params.row_bytes(df.schema) > 2_000 > 100 > params.measured_row_bytes(df)
    hinted = lambda most: "strategy=broadcast" in params.bounded_broadcast(df, most)._jdf.queryExecution().analyzed().toString()
    assert hinted(50 * 100) and not hinted(50 * 50)


def test_the_catalogue_pools_vectors_only_for_queries_that_read_them(spark, tmp_path, monkeypatch):
    from seedrank.plans import driver_views as DV
    from seedrank.plans import queries as Q

    rows = {"orders": ([(o, 1, 10.0, "1-URGENT" if o < 3 else "5-LOW", "F") for o in range(6)], "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string, o_orderstatus string"),
            "customer": ([(1, "c", 7)], "c_custkey long, c_name string, c_nationkey int"), "nation": ([(7, "N")], "n_nationkey int, n_name string"),
            "lineitem": ([(o, o % 2, 1.0, 2.0, 0.1, 0.1) for o in range(6)], "l_orderkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double"),
            "embeddings": ([(0, [1.0, 2.0])], "vec_id long, embedding array<float>")}
    for name, (data, schema) in rows.items():
        df = spark.createDataFrame(data, schema)
        df = df.withColumn("o_orderdate", F.to_timestamp(F.lit("2020-01-01"))) if name == "orders" else df
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    with monkeypatch.context() as m:
        m.setattr(DV, "item_vectors", lambda *a: (_ for _ in ()).throw(AssertionError("vectors were pooled")))
        cand, seeds = Q.candidates(spark, str(tmp_path))
        assert "vec" not in cand.columns + seeds.columns and (cand.count(), seeds.count()) == (3, 3)
    pooled = DV.item_vectors
    monkeypatch.setattr(DV, "item_vectors", lambda s, d: pooled(s, d, 2))
    cand, seeds = Q.candidates(spark, str(tmp_path), vectors=True)
    assert {r.item_id: r.vec for r in cand.unionByName(seeds).collect()} == {o: [1.0, 2.0] if o % 2 == 0 else None for o in range(6)}


def _order_tables(spark, folder):
    """Orders 0 to 11 of two sets, lines of suppliers 0 to 3 (supplier 3 has no vector, order 11 no line, order 9 two lines of one supplier)."""
    lines = [(o, s, 1.0 + o, 2.0, 0.1 * s, 0.1) for o in range(11) for s in ([o % 4, (o + 1) % 4] if o != 9 else [2, 2])]
    rows = {"orders": ([(o, o % 2, 10.0 * o, "1-URGENT" if o % 5 < 2 else "5-LOW", "F") for o in range(12)], "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string, o_orderstatus string"),
            "customer": ([(i, f"c{i}", 7 + i) for i in (0, 1)], "c_custkey long, c_name string, c_nationkey int"), "nation": ([(7, "N"), (8, "O")], "n_nationkey int, n_name string"),
            "lineitem": (lines, "l_orderkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double"),
            "embeddings": ([(s, [float((s + 1) * (i + 1) % 7) for i in range(64)]) for s in range(3)], "vec_id long, embedding array<float>")}
    for name, (data, schema) in rows.items():
        df = spark.createDataFrame(data, schema)
        (df.withColumn("o_orderdate", F.to_timestamp(F.lit("2020-01-01"))) if name == "orders" else df).write.parquet(f"{folder}/{name}.parquet")


def test_pooled_vectors_are_not_written_and_equal_written_ones(spark, tmp_path, monkeypatch):
    from seedrank.operators import vectors as V
    from seedrank.plans import queries as Q

    got = {}
    for name in ("shared", "written"):
        (tmp_path / name).mkdir()
        _order_tables(spark, tmp_path / name)
        if name == "written":
            monkeypatch.setattr(V, "MAX_SHARED_BYTES", 10)  # as for more vectors than a worker holds
        rows = Q.QUERIES["vector_cosine"](spark, str(tmp_path / name)).collect()
        table = spark.read.parquet(Q._with_vectors(spark, str(tmp_path / name))["vector_items"])
        assert ("vec" in table.columns, "refs" in table.columns) == (name == "written", name == "shared")
        got[name] = {(r.set_id, r.item_id): r.vec_cosine for r in rows}
    assert len(got["shared"]) == 6 and got["shared"].keys() == got["written"].keys()
    assert all(abs(got["written"][k] - v) < 2e-6 for k, v in got["shared"].items()) and len(set(got["shared"].values())) > 3


def test_similarity_scores_shuffle_and_write_no_vectors(spark, tmp_path, monkeypatch):
    from seedrank.plans import driver_views as DV
    from seedrank.plans import queries as Q

    _order_tables(spark, tmp_path)
    monkeypatch.setattr(DV, "bounded_broadcast", lambda df: df)  # as for more vectors than a broadcast holds
    df = Q.QUERIES["similarity_scores"](spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "embedding" not in plan and plan.count("MapInArrow") == 2  # the candidates' pass and the seeds'; the scaler's is done
    assert {r.item_id for r in df.collect()} == {2, 3, 4, 7, 8, 9}  # complete, and no seeds


def test_prepare_by_reference_gives_the_rows_of_prepare_by_vector(spark):
    from seedrank.plans import pipeline as P

    vec = {0: [0.0, 1.0], 1: [0.5, 0.0], 2: [2.0, 2.0]}
    cols = "item_id long, set_id int, name string, owner string, tags string, {}"
    item = [(1, 1, "a", "x", "t", 2), (1, 1, "A ", "x", "t", 1), (2, 1, "b", "x", None, None), (3, 1, "c", "c", "u", 0), (4, 2, "a", "x", "v", 0)]
    seed = [(9, 1, "a", "x", None, None), (9, 1, "a", "x", None, 0), (8, 2, "z", "x", None, 1), (7, 2, "a", "x", "t", None)]
    vectors = spark.createDataFrame([*vec.items(), (None, [9.0, 9.0])], "vec_ref long, vec array<double>")
    lookup = spark.createDataFrame([("t", [1.0, 1.0])], "tag string, vec array<double>")
    by_ref = [spark.createDataFrame(r, cols.format("vec_ref long")) for r in (item, seed)]
    by_vec = [spark.createDataFrame([(*r[:5], vec.get(r[5])) for r in rows], cols.format("vec array<double>")) for rows in (item, seed)]
    how = dict(name="name", owner="owner", order_by=["item_id"], tags="tags", vec="vec", lookup=lookup, dim=2)
    rows = lambda df: sorted(map(repr, df.collect()))
    for got, want in zip(P.prepare(*by_ref, **how, vectors=vectors), P.prepare(*by_vec, **how)):
        assert got.columns == want.columns and rows(got) == rows(want)
