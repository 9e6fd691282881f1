"""Registered queries: tag-graph build (G1–G5, J7) and source merging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedrank.functions.params import by_key, materialize
from seedrank.operators import graph as G
from seedrank.plans import driver_views as DV
from seedrank.plans.queries import out, register
from seedrank.sources import io as IO

# ------------------------------------------------------------------ G1

_LINK_SQL = G.LINK_PATTERN.replace("'", "''")


@register("page_links", "WITH x AS (SELECT page_id, regexp_extract_all(html, '" + _LINK_SQL + "', 1) AS h, "
          "regexp_extract_all(html, '" + _LINK_SQL + "', 2) AS t FROM pages), "
          "y AS (SELECT page_id, h, t, unnest(generate_series(1, len(h))) AS i FROM x) "
          "SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, h[i] AS href, t[i] AS text FROM y")
def page_links(spark, d):
    """G1 over stored pages: every link (target, text) with its position on the page."""
    return G.extract_links(DV.table(spark, d, "pages")).select("page_id", F.col("pos").cast("int").alias("pos"), "href", "text")


# ------------------------------------------------------------------ J7 / G2 / G3

def part_points(spark: SparkSession, d: str) -> DataFrame:
    """Parts as points on a 2-D map: x = size·100, y = part key·5 (a strip that grows
    with the table, so a point's neighbours stay as many at every size)."""
    p = DV.table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("id"), (F.col("p_size") * 100.0).alias("x"),
                    (F.col("p_partkey") * 5.0).alias("y"))


_POINTS_SQL = "pts AS (SELECT p_partkey AS id, p_size * 100.0 AS x, p_partkey * 5.0 AS y FROM part)"
_EDGES_SQL = ("e AS (SELECT a.id AS src, b.id AS dst, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS distance "
              f"FROM pts a JOIN pts b ON a.id < b.id WHERE sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) < {G.EDGE_RADIUS})")


@register("proximity_edges", f"WITH {_POINTS_SQL}, {_EDGES_SQL} SELECT src, dst, round(distance, 6) AS distance, "
          "round(1.0 / (distance + 1.0), 6) AS weight FROM e")
def proximity_edges(spark, d):
    """Pairs closer than the radius (grid-bucketed range join; the oracle is the
    brute-force self-join), weight 1 / (distance + 1)."""
    return out(G.proximity_edges(part_points(spark, d)), ["src", "dst", "distance", "weight"])


@register("graph_summary", f"WITH {_POINTS_SQL}, {_EDGES_SQL} SELECT (SELECT count(*) FROM (SELECT src FROM e UNION SELECT dst FROM e)) AS nodes, "
          "(SELECT count(*) FROM e) AS edges")
def graph_summary(spark, d):
    """Node and edge counts of the proximity graph."""
    pts = part_points(spark, d)
    return G.graph_summary(G.proximity_edges(pts))


# ------------------------------------------------------------------ G4 G5

def _walks(spark: SparkSession, d: str) -> DataFrame:
    edges = materialize(G.proximity_edges(part_points(spark, d)), "edges")  # read by the nodes and every step
    return G.random_walks(G.connected_nodes(edges), edges)


@register("random_walks")
def random_walks(spark, d):
    """20 weight-proportional walks of 5 nodes from every node of the proximity graph."""
    w = _walks(spark, d)
    return w.select("start", "walk", F.size("path").alias("length"), F.array_join(F.transform("path", lambda v: v.cast("string")), " ").alias("path"))


@register("walk_embeddings")
def walk_embeddings(spark, d):
    """16-d vectors of the walked nodes (S10 writes them as a lookup)."""
    emb = G.walk_embeddings(_walks(spark, d))
    return emb.select("node", F.size("vec").alias("dim"), F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x).alias("sq_norm"))


_NODES_SQL = "n AS (SELECT src AS id FROM e UNION SELECT dst FROM e)"


@register("walk_invariants", f"WITH {_POINTS_SQL}, {_EDGES_SQL}, {_NODES_SQL} SELECT count(*) AS nodes, count(*) * {G.WALKS_PER_NODE} AS walks, "
          f"count(*) * {G.WALKS_PER_NODE * (G.WALK_LENGTH - 1)} AS steps, CAST(0 AS BIGINT) AS steps_off_edges, CAST(0 AS BIGINT) AS wrong_starts FROM n")
def walk_invariants(spark, d):
    """From every connected node as many walks as asked, each of full length (every node has an edge to leave by), every
    step an edge."""
    edges = materialize(G.proximity_edges(part_points(spark, d)), "edges")
    walks = materialize(G.random_walks(G.connected_nodes(edges), edges), "walks")
    pairs = F.arrays_zip(F.slice("path", 1, F.size("path") - 1).alias("a"), F.slice("path", 2, F.size("path") - 1).alias("b"))
    steps = walks.select(F.explode(pairs).alias("s")).select(F.least("s.a", "s.b").alias("src"), F.greatest("s.a", "s.b").alias("dst"))
    off = steps.join(by_key(edges.select("src", "dst").withColumn("edge", F.lit(1))), ["src", "dst"], "left").agg(
        F.count(F.lit(1)).alias("steps"), F.count_if(F.col("edge").isNull()).alias("steps_off_edges"))
    whole = walks.agg(F.count_distinct("start").alias("nodes"), F.count(F.lit(1)).alias("walks"), F.count_if(F.col("path")[0] != F.col("start")).alias("wrong_starts"))
    one = lambda df: df.withColumn("one", F.lit(1))
    return one(whole).join(one(off), "one").select("nodes", "walks", "steps", "steps_off_edges", "wrong_starts")


@register("embedding_invariants", f"WITH {_POINTS_SQL}, {_EDGES_SQL}, {_NODES_SQL} SELECT count(*) AS nodes, {G.EMBED_DIM} AS dim, TRUE AS neighbours_closer FROM n")
def embedding_invariants(spark, d):
    """A vector for every connected node, and the mean cosine of neighbours above that of all pairs by at least 0.2 (the mean over
    all pairs is the squared length of the mean unit vector)."""
    edges = materialize(G.proximity_edges(part_points(spark, d)), "edges")
    emb = G.walk_embeddings(G.random_walks(G.connected_nodes(edges), edges))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda acc, v: acc + v * v))
    unit = materialize(emb.select("node", F.when(norm > 0, F.transform("vec", lambda v: v / norm)).otherwise(F.col("vec")).alias("u")), "units")
    dot = F.aggregate(F.zip_with("ua", "ub", lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    ends = edges.select(F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst"))
    near = (ends.join(by_key(unit.select(F.col("node").alias("src"), F.col("u").alias("ua"))), "src")
            .join(by_key(unit.select(F.col("node").alias("dst"), F.col("u").alias("ub"))), "dst").agg(F.avg(dot).alias("near")))
    mean = unit.agg(F.count(F.lit(1)).alias("nodes"), F.max(F.size("u")).alias("dim"), F.array(*[F.avg(F.col("u")[i]) for i in range(G.EMBED_DIM)]).alias("m"))
    mean = mean.select("nodes", "dim", F.aggregate("m", F.lit(0.0), lambda acc, v: acc + v * v).alias("all_pairs"))
    one = lambda df: df.withColumn("one", F.lit(1))
    return one(mean).join(one(near), "one").select("nodes", "dim", (F.col("near") > F.col("all_pairs") + 0.2).alias("neighbours_closer"))


# ------------------------------------------------------------------ S3 S4

@register("source_counts", "SELECT 'customer.parquet' AS source_file, count(*) AS rows FROM customer UNION ALL "
          "SELECT 'supplier.parquet' AS source_file, count(*) AS rows FROM supplier")
def source_counts(spark, d):
    """S3 union by column name of two sources (columns missing on one side are NULL), S4
    rows per source file."""
    c = DV.table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"),
        F.col("_metadata.file_name").alias("source_file"))
    s = DV.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"), F.col("_metadata.file_name").alias("source_file"))
    return IO.source_counts(IO.merge_frames([c, s]))
