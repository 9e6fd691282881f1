import json
import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from seedrank.operators import graph as G
from seedrank.sources import io as IO


def test_proximity_edges_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    pts = rng.uniform(0, 1000, size=(300, 2))
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "id int, x double, y double")
    got = {(r.src, r.dst) for r in G.proximity_edges(df).collect()}
    want = {(i, j) for i in range(300) for j in range(i + 1, 300) if np.hypot(*(pts[i] - pts[j])) < G.EDGE_RADIUS}
    assert got == want and len(want) > 100


def test_no_table_of_points_or_nodes_is_broadcast(spark):
    from seedrank.functions.params import materialize

    points = materialize(spark.range(2000).select(F.col("id"), (F.col("id") % 7 * 100.0).alias("x"), (F.col("id") * 5.0).alias("y")), "test")
    edges = materialize(G.proximity_edges(points), "test")
    walks = G.random_walks(G.connected_nodes(edges), edges)
    for df in (G.proximity_edges(points), walks, G.walk_embeddings(materialize(walks, "test"), dim=2, rounds=1)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_embedding_invariants_meet_vectors_by_key(spark, tmp_path):
    from seedrank.plans.queries import QUERIES

    spark.range(400).select(F.col("id").alias("p_partkey"), (F.col("id") % 7 + 1).cast("int").alias("p_size")).write.parquet(str(tmp_path / "part.parquet"))
    df = QUERIES["embedding_invariants"](spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 2  # both ends of an edge; only single rows are broadcast
    assert [tuple(r) for r in df.collect()] == [(400, G.EMBED_DIM, True)]


def test_dense_cells_are_quartered_and_dealt(spark):
    rng = np.random.default_rng(4)
    pts = np.vstack([rng.uniform(0, 140, size=(180, 2)), np.full((40, 2), 75.0), rng.uniform(-300, 600, size=(120, 2))])
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "id int, x double, y double")
    d = np.hypot(*(pts[:, None] - pts[None]).transpose(2, 0, 1))
    want = {(i, j) for i in range(len(pts)) for j in range(i + 1, len(pts)) if d[i, j] < G.EDGE_RADIUS}
    for most, depth in ((25, 3), (25, 1), (60, 4)):
        got = [(r.src, r.dst) for r in G.proximity_edges(df, most=most, depth=depth).collect()]
        assert len(got) == len(want) and set(got) == want
    levels = G.dense_cells(df, "x", "y", G.EDGE_RADIUS, 25, 3)
    assert len(levels) == 4 and levels[3].agg(F.max("n")).first()[0] >= 40  # points in one place stay together: dealt by hash


def test_walk_vectors_keep_neighbours_close(spark):
    rng = np.random.default_rng(5)
    rows = []
    for block in (0, 1, 2):  # three groups of nodes, few edges between them
        ids = np.arange(20) + 20 * block
        rows += [(int(a), int(b), 1.0) for a in ids for b in ids if a < b and rng.random() < 0.4]
    rows += [(0, 20, 1.0), (20, 40, 1.0)]
    edges = spark.createDataFrame(rows, "src int, dst int, weight double")
    emb = {int(r.node): np.array(r.vec) for r in G.walk_embeddings(G.random_walks(G.connected_nodes(edges), edges), dim=4).collect()}
    unit = {k: v / max(np.linalg.norm(v), 1e-12) for k, v in emb.items()}
    same = np.mean([unit[a] @ unit[b] for a in unit for b in unit if a < b and a // 20 == b // 20])
    other = np.mean([unit[a] @ unit[b] for a in unit for b in unit if a // 20 != b // 20])
    assert same > other + 0.5


def test_walk_vectors_of_few_columns_a_pass_are_the_same_and_leave_no_tables(spark, monkeypatch):
    from seedrank.functions import params

    edges = spark.createDataFrame([(i, (i * 7 + k) % 30, 1.0 + k) for i in range(30) for k in (1, 2) if i < (i * 7 + k) % 30], "src long, dst long, weight double")
    walks = params.materialize(G.random_walks(G.connected_nodes(edges), edges), "test")
    left = lambda: params._WRITTEN[spark.sparkContext.applicationId]
    before = set(left())
    whole = {r.node: r.vec for r in G.walk_embeddings(walks, dim=5, rounds=3).collect()}
    assert sorted(p.split("seedrank-")[-1].split("-")[0] for p in set(left()) - before) == ["last", "nodes"]
    monkeypatch.setattr(G, "PASS_BYTES", 8 * 2 * G.cooccurrences(walks).count())  # two columns a pass
    parts = {r.node: r.vec for r in G.walk_embeddings(walks, dim=5, rounds=3).collect()}
    assert whole.keys() == parts.keys() and all(isinstance(k, str) and np.allclose(parts[k], v, atol=1e-9) for k, v in whole.items())


def test_cooccurrences_count_both_ways(spark):
    paths = [[1, 2, 1, 3, 1], [2], [4, 4, 5]]
    walks = spark.createDataFrame([(p,) for p in paths], "path array<long>")
    want = {}
    for p in paths:
        for i, a in enumerate(p):
            for j, b in enumerate(p):
                if i != j and abs(i - j) <= 2:
                    want[a, b] = want.get((a, b), 0) + 1
    assert {(r.src, r.dst): r.n for r in G.cooccurrences(walks, 2).collect()} == want


def test_embedding_invariants_leave_no_pairs_or_rounds_on_the_disk(spark, tmp_path):
    from seedrank.functions import params
    from seedrank.plans.queries import QUERIES

    spark.range(300).select(F.col("id").alias("p_partkey"), (F.col("id") % 7 + 1).cast("int").alias("p_size")).write.parquet(str(tmp_path / "part.parquet"))
    before = set(params._WRITTEN.get(spark.sparkContext.applicationId, []))
    assert [tuple(r) for r in QUERIES["embedding_invariants"](spark, str(tmp_path)).collect()] == [(300, G.EMBED_DIM, True)]
    names = sorted(p.split("seedrank-")[-1].split("-")[0] for p in set(params._WRITTEN[spark.sparkContext.applicationId]) - before if "bounded" not in p)
    assert names == ["edges", "last", "nodes", "units"]  # no pairs and no round's factor stay on the disk


def test_random_walks_follow_edges_and_repeat(spark):
    nodes = spark.createDataFrame([(i,) for i in range(6)], "id int")
    edges = spark.createDataFrame([(0, 1, 1.0), (1, 2, 0.5), (2, 3, 2.0), (3, 4, 1.0), (0, 4, 0.1)], "src int, dst int, weight double")
    w1 = sorted((r.start, r.walk, tuple(r.path)) for r in G.random_walks(nodes, edges).collect())
    w2 = sorted((r.start, r.walk, tuple(r.path)) for r in G.random_walks(nodes, edges).collect())
    assert w1 == w2 and len(w1) == 6 * G.WALKS_PER_NODE
    und = {(a, b) for a, b, _ in edges.collect()} | {(b, a) for a, b, _ in edges.collect()}
    for start, _, path in w1:
        assert path[0] == start and len(path) <= G.WALK_LENGTH
        assert all((a, b) in und for a, b in zip(path, path[1:]))
        if start == 5:
            assert path == (5,)  # isolated node: the walk stops at once


def test_walk_embeddings_dim(spark):
    nodes = spark.createDataFrame([(i,) for i in range(8)], "id int")
    edges = spark.createDataFrame([(i, i + 1, 1.0) for i in range(7)], "src int, dst int, weight double")
    emb = G.walk_embeddings(G.random_walks(nodes, edges), dim=4)
    rows = emb.collect()
    assert len(rows) == 8 and all(len(r.vec) == 4 for r in rows)


def test_extract_positions_and_links(spark):
    html = ('<div class="genre" style="color: #a; top: 20px; left: 10px; font-size: 100%">x</div>'
            '<div class="genre" style="color: #b; left: 5.5px; top: -3px; font-size: 100%" id="i">indie pop<a class="n" href="/p/indie">»</a></div>'
            '<a href="/a">A</a>')
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    pos = [tuple(r) for r in G.extract_positions(pages).select("name", "link", "left", "top").collect()]
    assert pos == [("indie pop", "/p/indie", 5.5, -3.0)]
    links = [tuple(r) for r in G.extract_links(pages).select("href", "text").collect()]
    assert links == [("/a", "A")]


def _write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_read_items_multiline_bom_quotes(spark):
    d = tempfile.mkdtemp(prefix="seedrank-csv-")
    _write(os.path.join(d, "a.csv"), '﻿Track Name,Artist Name(s),genre_embedding\n'
           '"Hello, World","A ""B""","0.1 0.2\n 0.3"\nNA,,""\n')
    rows = IO.read_items(spark, os.path.join(d, "a.csv")).collect()
    assert rows[0]["Track Name"] == "Hello, World" and rows[0]["Artist Name(s)"] == 'A "B"'
    assert "\n" in rows[0]["genre_embedding"]
    assert rows[1]["Track Name"] == "NA" and rows[1]["Artist Name(s)"] is None
    seeds = IO.read_seeds(spark, os.path.join(d, "a.csv")).select("set_id").distinct().collect()
    assert [r.set_id for r in seeds] == ["a"]


def test_merge_sources_skips_tab_header_and_counts(spark):
    d = tempfile.mkdtemp(prefix="seedrank-merge-")
    _write(os.path.join(d, "x.csv"), "name,owner\na,b\nc,d\n")
    _write(os.path.join(d, "y.csv"), "owner,name,extra\ne,f,g\n")
    _write(os.path.join(d, "z.csv"), "name\towner\n")
    files = [os.path.join(d, f) for f in ("x.csv", "y.csv", "z.csv")]
    m = IO.merge_sources(spark, files)
    counts = {r.source_file: r.rows for r in IO.source_counts(m).collect()}
    assert counts == {"x.csv": 2, "y.csv": 1}
    assert m.where(F.col("name") == "f").first().owner == "e"
    assert m.distinct().count() == 3


def test_vector_lookup_round_trip(spark):
    d = tempfile.mkdtemp(prefix="seedrank-json-")
    _write(os.path.join(d, "lk.json"), json.dumps({" Indie Pop ": [0.5, 1.0], "rock": [1.0, 0.0]}))
    lk = {r.tag: r.vec for r in IO.read_vector_lookup(spark, os.path.join(d, "lk.json")).collect()}
    assert lk == {"indie pop": [0.5, 1.0], "rock": [1.0, 0.0]}
    _write(os.path.join(d, "g.json"), json.dumps({"genres": ["pop", "rock"]}))
    assert [r.tag for r in IO.read_seed_genres(spark, os.path.join(d, "g.json")).collect()] == ["pop", "rock"]


def test_writers_round_trip(spark):
    d = tempfile.mkdtemp(prefix="seedrank-write-")
    df = spark.createDataFrame([("a", 1, 0.5), ("b", 2, 0.25)], "set_id string, item_id int, base_score double")
    IO.write_table(df, os.path.join(d, "recs"), partition_by=["set_id"])
    back = spark.read.parquet(os.path.join(d, "recs"))
    assert sorted((r.set_id, r.item_id) for r in back.collect()) == [("a", 1), ("b", 2)]
    IO.write_table(df, os.path.join(d, "recs_csv"), fmt="csv")
    assert spark.read.option("header", "true").csv(os.path.join(d, "recs_csv")).count() == 2
    lk = spark.createDataFrame([("pop", [1.0, 2.0])], "tag string, vec array<double>")
    IO.write_vector_lookup(lk, os.path.join(d, "lk"))
    assert [tuple(r) for r in spark.read.json(os.path.join(d, "lk")).select("tag", "vec").collect()] == [("pop", [1.0, 2.0])]


def test_positions_take_any_element_form(spark):
    html = ("<div class='x genre big' style='top: 5px; color:red; left: 7.5px' id=a>one<a href=/a>&raquo;</a></div>"
            '<div style="left: 1px; top: 2px" class="genre">two<a class="n" href="/b"></a></div>'
            '<div class="genres" style="left: 1px; top: 2px">no<a href="/c"></a></div>'
            '<div id=3 class=genre style="top:9px;left:8px">three <a href=\'/d\'></a></div>')
    pages = spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")
    got = [tuple(r) for r in G.extract_positions(pages).orderBy("pos").collect()]
    assert got == [(1, 0, "one", "/a", 7.5, 5.0), (1, 1, "two", "/b", 1.0, 2.0), (1, 2, "three", "/d", 8.0, 9.0)]


def test_tab_separated_rows_are_merged(spark, tmp_path):
    (tmp_path / "a.csv").write_text('n,v\nx,"1,5"\n')
    (tmp_path / "b.csv").write_text("n\tv\ny\t2\nz\t3\n")
    m = IO.merge_sources(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert sorted((r.n, r.v) for r in m.collect()) == [("x", "1,5"), ("y", "2"), ("z", "3")]


def test_undated_set_keeps_its_items(spark):
    from seedrank.operators import era as E
    items = spark.createDataFrame([(1, 10, 2000), (2, 20, 2001)], "set_id long, item_id long, release_year int")
    params = E.era_params(spark.createDataFrame([(1, 1999), (2, None)], "set_id long, release_year int"))
    got = {r.item_id: r.year_adjustment for r in E.apply_era(items, params).collect()}
    assert got[20] == 0.0 and set(got) == {10, 20}
