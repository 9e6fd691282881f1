"""Registered queries: sources and sinks (S1–S3, S5, S6, S8, S10) as round trips, V2 and V5.

The given tables are written in the library's file forms to the session's shared folder and read
back by the source operators; DuckDB gives the same rows straight from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from seedrank.functions.exprs import round_doubles
from seedrank.functions.params import new_folder
from seedrank.operators import vectors as V
from seedrank.plans import driver_views as DV
from seedrank.plans import sqlgen as S
from seedrank.plans.queries import base_tables, out, register
from seedrank.sources import io

DIM = DV.VEC_DIM


# ------------------------------------------------------------------ S1 S8 (CSV)

@register("csv_items", "SELECT page_id, url, md5(html) AS html_md5, CAST(length(html) AS INTEGER) AS html_length FROM pages")
def csv_items(spark, d):
    """S8 → S1: pages as CSV; their markup holds quotes, commas and line ends inside cells."""
    path = new_folder(spark, "csv-items")
    io.write_table(DV.table(spark, d, "pages"), path, "csv")
    r = io.read_items(spark, path, "page_id long, url string, html string")
    return r.select("page_id", "url", F.md5("html").alias("html_md5"), F.length("html").alias("html_length"))


# ------------------------------------------------------------------ S2 S8 (seed sets)

@register("csv_seeds", S.with_items() + "SELECT set_id, item_id, name, owner, label, release_date, round(f_price, 6) AS f_price FROM seeds")
def csv_seeds(spark, d):
    """S8 → S2: every seed set in a folder of its own, read back with the folder's set id."""
    path = new_folder(spark, "csv-seeds")
    cols = ["item_id", "name", "owner", "label", "release_date", "f_price"]
    _, sd = base_tables(spark, d)
    io.write_table(sd.select("set_id", *cols), path, "csv", partition_by=["set_id"])
    r = io.read_seeds(spark, path, "item_id long, name string, owner string, label string, release_date string, f_price double, set_id int")
    return out(r, ["set_id", *cols])


# ------------------------------------------------------------------ S3

@register("merge_files", "SELECT c_custkey AS key, c_name AS name, CAST(c_acctbal AS DOUBLE) AS balance, c_mktsegment AS segment FROM customer "
          "UNION ALL SELECT s_suppkey, s_name, CAST(s_acctbal AS DOUBLE), NULL FROM supplier")
def merge_files(spark, d):
    """S3: comma- and tab-separated files of different columns, united by column name."""
    c, s = new_folder(spark, "merge-c"), new_folder(spark, "merge-s")
    io.write_table(DV.table(spark, d, "customer").selectExpr("c_custkey AS key", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment"), c, "csv")
    io.write_table(DV.table(spark, d, "supplier").selectExpr("s_acctbal AS balance", "s_suppkey AS key", "s_name AS name"), s, "csv", sep="\t")
    m = io.merge_sources(spark, io.list_files(spark, c) + io.list_files(spark, s))
    return m.select(F.col("key").cast("long").alias("key"), "name", F.col("balance").cast("double").alias("balance"), "segment")


# ------------------------------------------------------------------ S5 S10

_LOOKUP = ["form", "tag", "n", "v0", "v_sum"]
_SUM = " + ".join(f"CAST(embedding[{i + 1}] AS DOUBLE)" for i in range(DIM))


@register("vector_lookup", "WITH f AS (SELECT * FROM (VALUES ('lines'), ('object')) AS f(form)) SELECT form, 'tag ' || vec_id AS tag, "
          f"CAST(len(embedding) AS INTEGER) AS n, round(CAST(embedding[1] AS DOUBLE), 6) AS v0, round({_SUM}, 6) AS v_sum FROM embeddings, f")
def vector_lookup(spark, d):
    """S10 → S5: the vector table as JSON lines, and as JSON objects {key: vector}; keys come back
    trimmed and in lower case."""
    e = DV.table(spark, d, "embeddings").select(
        F.concat(F.lit(" Tag "), F.col("vec_id").cast("string"), F.lit(" ")).alias("tag"), F.col("embedding").cast("array<double>").alias("vec"))
    lines, objects = new_folder(spark, "lookup-lines"), new_folder(spark, "lookup-objects")
    io.write_vector_lookup(e, lines)
    e.select(F.to_json(F.create_map("tag", "vec")).alias("value")).write.text(objects)
    both = (io.read_vector_lookup(spark, lines, form="lines").withColumn("form", F.lit("lines"))
            .unionByName(io.read_vector_lookup(spark, objects, form="object_lines").withColumn("form", F.lit("object"))))
    total = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)
    return out(both.select("form", "tag", F.size("vec").alias("n"), F.col("vec")[0].alias("v0"), total.alias("v_sum")), _LOOKUP)


# ------------------------------------------------------------------ S6

@register("seed_genres", "SELECT tag, count(*) AS brands FROM (SELECT DISTINCT p_brand, unnest(string_split(p_name, ' ')) AS tag FROM part) GROUP BY tag")
def seed_genres(spark, d):
    """A JSON object with a list of tags for every brand, read back as one row per value."""
    path = new_folder(spark, "genres")
    words = DV.table(spark, d, "part").select("p_brand", F.explode(F.split("p_name", " ")).alias("tag")).distinct()
    words.groupBy("p_brand").agg(F.collect_list("tag").alias("genres")).write.json(path)
    return io.read_seed_genres(spark, path, lines=True).groupBy("tag").agg(F.count(F.lit(1)).alias("brands"))


# ------------------------------------------------------------------ V2 V5

@register("split_tags", "WITH t AS (SELECT p_partkey, CASE WHEN p_size % 5 > 0 THEN list_transform(string_split(p_name, ' '), lambda x: lower(x)) "
          "ELSE [] END AS tags FROM part) SELECT p_partkey, CAST(len(tags) AS INTEGER) AS n_tags, array_to_string(tags, '|') AS tags FROM t")
def split_tags(spark, d):
    """V2: tag texts with blanks and capitals, some of them missing, to lists of tags."""
    p = DV.table(spark, d, "part").select("p_partkey", F.when(
        F.col("p_size") % 5 > 0, F.concat(F.lit(" "), F.regexp_replace(F.initcap("p_name"), " ", " ,  "), F.lit(" "))).alias("txt"))
    t = V.split_tags(p, "txt")
    return t.select("p_partkey", F.size("tags").alias("n_tags"), F.array_join("tags", "|").alias("tags"))


@register("expand_vector", "SELECT vec_id, " + ", ".join(f"round(CAST(embedding[{i + 1}] AS DOUBLE), 6) AS genre_dim_{i}" for i in range(DIM)) + " FROM embeddings")
def expand_vector(spark, d):
    """V5: a vector column to one column per dimension."""
    return round_doubles(V.expand_vector(DV.table(spark, d, "embeddings").select("vec_id", "embedding"), "embedding", DIM))
