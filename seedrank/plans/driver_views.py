"""The library's data model laid over the driver's TPC-H-like tables.

* items  = one row per order: id ``item_id`` (o_orderkey), set ``set_id`` (customer nation:
  each set has its own candidate pool, so items meet their set's parameters on an equi-key),
  name (order key as text), owner (customer name), album (order priority), label (nation
  name), release date (order date text), six numeric features (total price and the
  per-order means of quantity, price, discount, tax, plus the line count; orders without
  lines have NULL features).
* seeds  = the items whose priority is '1-URGENT' and status 'F' (a data predicate, about
  7 % of orders, ~40 per set at sf0.01).
* tags   = the part-name words of an order's lines (``order_tags``) or of a part (``part_tags``).
* vectors = ``embeddings`` rows (64 floats), mean-pooled per order over ``l_suppkey``.

``ITEMS_SQL`` is the same definition for DuckDB; the oracle queries are built on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedrank.functions.params import bounded_broadcast, materialize
from seedrank.operators.vectors import mean_pool, pooled_rows, shared_vectors

FEATURES = ["f_price", "f_qty", "f_ext", "f_disc", "f_tax", "f_lines"]
VEC_DIM = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def line_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.avg("l_quantity").alias("f_qty"),
        F.avg("l_extendedprice").alias("f_ext"),
        F.avg("l_discount").alias("f_disc"),
        F.avg("l_tax").alias("f_tax"),
        F.count(F.lit(1)).cast("double").alias("f_lines"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    lf = line_features(spark, sf_dir)
    j = (o.join(c, o.o_custkey == c.c_custkey)
         .join(n, c.c_nationkey == n.n_nationkey)
         .join(lf, o.o_orderkey == lf.l_orderkey, "left"))
    return j.select(
        F.col("o_orderkey").alias("item_id"),
        F.col("c_nationkey").alias("set_id"),
        F.col("o_orderkey").cast("string").alias("name"),
        F.col("c_name").alias("owner"),
        F.col("o_orderpriority").alias("album"),
        F.col("n_name").alias("label"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("release_date"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("f_price"),
        "f_qty", "f_ext", "f_disc", "f_tax", "f_lines",
    )


def seed_filter(df: DataFrame) -> DataFrame:
    return df.filter((F.col("album") == "1-URGENT") & (F.col("status") == "F"))


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed_filter(items(spark, sf_dir))


#: order lines whose pooled vectors one task holds
LINES_AT_ONCE = 400_000


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, l_suppkey) of the lines with a supplier, an order's lines in one task of about ``LINES_AT_ONCE``."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-li.count() // LINES_AT_ONCE))
    return li.where(F.col("l_suppkey").isNotNull()).repartition(parts, "l_orderkey")


def supplier_vectors(spark: SparkSession, sf_dir: str, dim: int = VEC_DIM):
    """The ``embeddings`` in every worker's memory (see ``shared_vectors``; None: too many), only those of suppliers with lines if they are many."""
    return shared_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", dim, table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("long")))


def item_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, refs): the suppliers of an order's lines, which name the vectors to pool: 8 bytes a line, where a pooled vector is 8 bytes
    a dimension. The partitioning is that of the result, so a join on ``item_id`` leaves the lines where they are."""
    li = _order_lines(spark, sf_dir)
    return li.groupBy(F.col("l_orderkey").alias("item_id")).agg(F.collect_list(F.col("l_suppkey").cast("long")).alias("refs"))


def item_vectors(spark: SparkSession, sf_dir: str, dim: int = VEC_DIM) -> DataFrame:
    """(item_id, vec): element-wise mean of the supplier vectors of an order's lines (V3; NULL entries do not count).

    The lines are shuffled by order before they meet their vectors (16 bytes a line, where half-pooled vectors are 8 bytes a
    dimension and order), and pooled where they lie. Vectors that a worker cannot hold meet the lines in a join, which
    shuffles them; then about ``LINES_AT_ONCE`` lines a task keep tasks from spilling."""
    li, shared = _order_lines(spark, sf_dir), supplier_vectors(spark, sf_dir, dim)
    if shared is not None:
        return pooled_rows(li, ["l_orderkey"], "l_suppkey", shared, by_entry=True).withColumnRenamed("l_orderkey", "item_id")
    e = bounded_broadcast(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    j = li.join(e, li.l_suppkey == e.vec_id)
    if e.where(F.exists("embedding", lambda v: v.isNull())).isEmpty():
        return mean_pool(j, ["l_orderkey"], "embedding", dim).withColumnRenamed("l_orderkey", "item_id")
    agg = j.groupBy("l_orderkey").agg(*[F.avg(F.col("embedding")[i]).alias(f"d{i}") for i in range(dim)])
    return agg.select(F.col("l_orderkey").alias("item_id"), F.array(*[F.col(f"d{i}") for i in range(dim)]).alias("vec"))


ITEMS_SQL = """
__lf AS (
  SELECT l_orderkey, avg(l_quantity) AS f_qty, avg(l_extendedprice) AS f_ext,
         avg(l_discount) AS f_disc, avg(l_tax) AS f_tax, CAST(count(*) AS DOUBLE) AS f_lines
  FROM lineitem GROUP BY l_orderkey),
items AS (
  SELECT o.o_orderkey AS item_id, c.c_nationkey AS set_id, CAST(o.o_orderkey AS VARCHAR) AS name,
         c.c_name AS owner, o.o_orderpriority AS album, n.n_name AS label,
         strftime(o.o_orderdate, '%Y-%m-%d') AS release_date, o.o_orderstatus AS status,
         o.o_totalprice AS f_price, lf.f_qty, lf.f_ext, lf.f_disc, lf.f_tax, lf.f_lines
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN __lf lf ON lf.l_orderkey = o.o_orderkey),
seeds AS (SELECT * FROM items WHERE album = '1-URGENT' AND status = 'F')
"""


def order_tags(spark: SparkSession, sd: str) -> DataFrame:
    """(item_id, tags): sorted distinct part-name words of an order's lines joined by ','.
    The set per order is bounded by the word vocabulary, not by the order's line count."""
    li = table(spark, sd, "lineitem").select("l_orderkey", "l_partkey")
    p = table(spark, sd, "part").select("p_partkey", "p_name")
    w = li.join(p, li.l_partkey == p.p_partkey).select("l_orderkey", F.explode(F.split("p_name", " ")).alias("w"))
    return w.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("w")), ",").alias("tags")).select(
        F.col("l_orderkey").alias("item_id"), "tags")


def part_tags(spark: SparkSession, sd: str) -> DataFrame:
    """(p_partkey, p_brand, p_type, p_size, tags): a part's name words as a ','-joined tag list."""
    p = table(spark, sd, "part")
    return p.select("p_partkey", "p_brand", "p_type", "p_size", F.regexp_replace("p_name", " ", ",").alias("tags"))


# ---------------------------------------------------------------- tracks: a catalogue with duplicates, seeds of their own

#: per row of ``tracks``: its set is the customer's nation; lines 7 carry their part's name as owner (self-titled), returned
#: lines of urgent finished orders are seeds, and from line 5 on a seed's owner names a second one, so it is not in the catalogue
def tracks(spark: SparkSession, sd: str, vectors: DataFrame) -> DataFrame:
    """Order lines as track listings: part name and brand repeat, so the catalogue holds duplicates; a line's vector is its
    supplier's (``vec_ref`` names its row of ``vectors``, see ``track_vectors``), its tags the part's type and the first word of its
    name (none for sizes divisible by 7), a tax of 0 is missing. The lines meet the parts' texts in the last join that shuffles them; returned
    lines that are no seeds are in neither view and go before it."""
    li = table(spark, sd, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_returnflag")
    p = table(spark, sd, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    o = table(spark, sd, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    c, n = table(spark, sd, "customer").select("c_custkey", "c_nationkey"), table(spark, sd, "nation").select("n_nationkey", "n_name")
    e = bounded_broadcast(vectors.select("vec_id", "vec_ref"))
    o = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).drop("o_custkey", "c_custkey", "n_nationkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(e, li.l_suppkey == e.vec_id, "left").drop("o_orderkey", "l_suppkey", "vec_id")
    seed = (F.col("l_returnflag") == "R") & (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    j = j.where((F.col("l_returnflag") != "R") | seed).join(p, F.col("l_partkey") == p.p_partkey)
    return j.select(
        ((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey")).alias("item_id"), F.col("c_nationkey").alias("set_id"),
        F.col("p_name").alias("name"), F.when(F.col("l_linenumber") == 7, F.col("p_name")).otherwise(F.col("p_brand")).alias("owner"),
        F.col("p_type").alias("album"), F.col("o_orderpriority").alias("label"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("release_date"),
        F.col("p_retailprice").alias("f_price"), F.col("l_quantity").alias("f_qty"), F.col("l_extendedprice").alias("f_ext"), F.col("l_discount").alias("f_disc"),
        F.when(F.col("l_tax") != 0, F.col("l_tax")).alias("f_tax"), F.col("p_size").cast("double").alias("f_lines"),
        F.when(F.col("p_size") % 7 != 0, F.concat(F.lower("p_type"), F.lit(","), F.split("p_name", " ")[0])).alias("tags"), "vec_ref",
        F.col("l_linenumber").alias("line"), F.col("l_returnflag").alias("flag"), F.col("o_orderstatus").alias("status"), "n_name")


def track_vectors(spark: SparkSession, sd: str) -> DataFrame:
    """(vec_id, vec, vec_ref), written once: the suppliers' vectors, numbered in the order of their values, so that ``vec_ref`` stands for
    the vector in every comparison (NULL: none). Tracks carry the number until they are single, and are joined by it."""
    e = table(spark, sd, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vec"))
    e = e.orderBy("vec", "vec_id").select("vec_id", "vec", F.monotonically_increasing_id().alias("n"))
    return materialize(e.select("vec_id", "vec", F.when(F.col("vec").isNotNull(), F.col("n")).alias("vec_ref")), "track-vectors")


def track_items(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("flag") != "R").drop("line", "flag", "status", "n_name")


def track_seeds(rows: DataFrame) -> DataFrame:
    """Seeds with tags of their own but for lines 2 and 5, a vector of their own on line 1, and two owners from line 5 on."""
    s = rows.where((F.col("flag") == "R") & (F.col("label") == "1-URGENT") & (F.col("status") == "F"))
    return s.select(*[
        F.when(F.col("line") >= 5, F.concat("owner", F.lit(","), "n_name")).otherwise(F.col("owner")).alias("owner") if c == "owner" else
        F.when(~F.col("line").isin(2, 5), F.col("tags")).alias("tags") if c == "tags" else
        F.when(F.col("line") == 1, F.col("vec_ref")).alias("vec_ref") if c == "vec_ref" else F.col(c)
        for c in rows.columns if c not in ("line", "flag", "status", "n_name")])


def track_lookup(spark: SparkSession, sd: str) -> DataFrame:
    """(tag, vec): the words of the tags in order, each with the vector of that number."""
    from pyspark.sql import Window

    p = table(spark, sd, "part")
    words = p.select(F.lower("p_type").alias("tag")).union(p.select(F.split("p_name", " ")[0])).distinct()
    ranked = words.withColumn("vec_id", (F.row_number().over(Window.orderBy("tag")) - 1).cast("long"))  # the vocabulary of the parts: a few words
    e = table(spark, sd, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vec"))
    return ranked.join(e, "vec_id").select("tag", "vec")


TRACKS_SQL = """
trk AS MATERIALIZED (
  SELECT (l.l_orderkey * 8 + l.l_linenumber) * 1000000 + l.l_partkey AS item_id, c.c_nationkey AS set_id, p.p_name AS name,
         CASE WHEN l.l_linenumber = 7 THEN p.p_name ELSE p.p_brand END AS owner, p.p_type AS album, o.o_orderpriority AS label,
         strftime(l.l_shipdate, '%Y-%m-%d') AS release_date, p.p_retailprice AS f_price, l.l_quantity AS f_qty, l.l_extendedprice AS f_ext,
         l.l_discount AS f_disc, CASE WHEN l.l_tax <> 0 THEN l.l_tax END AS f_tax, CAST(p.p_size AS DOUBLE) AS f_lines,
         CASE WHEN p.p_size % 7 <> 0 THEN lower(p.p_type) || ',' || split_part(p.p_name, ' ', 1) END AS tags, CAST(e.embedding AS DOUBLE[]) AS vec,
         l.l_linenumber AS line, l.l_returnflag AS flag, o.o_orderstatus AS status, n.n_name
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN embeddings e ON e.vec_id = l.l_suppkey),
track_items AS (SELECT * EXCLUDE (line, flag, status, n_name) FROM trk WHERE flag <> 'R'),
track_seeds AS (SELECT * EXCLUDE (line, flag, status, n_name) REPLACE (
    CASE WHEN line >= 5 THEN owner || ',' || n_name ELSE owner END AS owner, CASE WHEN line NOT IN (2, 5) THEN tags END AS tags,
    CASE WHEN line = 1 THEN vec END AS vec) FROM trk WHERE flag = 'R' AND label = '1-URGENT' AND status = 'F'),
track_words AS (SELECT lower(p_type) AS tag FROM part UNION SELECT split_part(p_name, ' ', 1) FROM part),
track_lookup AS (SELECT tag, CAST(embedding AS DOUBLE[]) AS vec FROM (SELECT tag, row_number() OVER (ORDER BY tag) - 1 AS vec_id FROM track_words) JOIN embeddings USING (vec_id))
"""
