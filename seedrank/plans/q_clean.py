"""Registered queries: cleaning (C*), de-duplication (D*) and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from seedrank.operators import clean as C
from seedrank.operators import dedup as D
from seedrank.operators import enrich as J
from seedrank.operators import score as M
from seedrank.plans import driver_views as DV
from seedrank.plans import sqlgen as S
from seedrank.plans.queries import FEATURES, base_tables, candidates, core_scored, out, register

# ------------------------------------------------------------------ C1 C2 C3 C4


@register("clean_items", S.with_items(
    f"c AS (SELECT item_id, set_id, {S.extract_year_text('release_date')} AS release_date FROM items "
    "WHERE NOT coalesce(name = owner, false))",
) + f"SELECT item_id, set_id, release_date, {S.release_year('release_date')} AS release_year FROM c")
def clean_items(spark, d):
    """C1 drop self-titled, C2 year text, C4 drop unused columns, C3 release year."""
    it = C.clean_items(DV.items(spark, d), "name", "owner", "release_date")
    it = C.with_release_year(it, "release_date")
    return it.select("item_id", "set_id", "release_date", "release_year")


# ------------------------------------------------------------------ C5–C9

_IMP = ["item_id", "set_id", "name_num", "qty_median", "ext_mean", "disc_zero", "lines_text"]


@register("impute_features", S.base(
    "pool AS (SELECT set_id, f_qty FROM it UNION ALL SELECT set_id, f_qty FROM sd)",
    "med AS (SELECT set_id, quantile_cont(f_qty, 0.5) AS m FROM pool GROUP BY set_id)",
    "mea AS (SELECT set_id, avg(f_ext) AS a FROM it GROUP BY set_id)",
) + "SELECT " + S.rounded(_IMP, ["name_num", "qty_median", "ext_mean", "disc_zero"]) + " FROM ("
    "SELECT it.item_id, it.set_id, try_cast(it.name AS DOUBLE) AS name_num, coalesce(it.f_qty, med.m) AS qty_median, "
    "coalesce(it.f_ext, mea.a) AS ext_mean, coalesce(it.f_disc, 0.0) AS disc_zero, "
    "coalesce(CAST(CAST(it.f_lines AS BIGINT) AS VARCHAR), 'Unknown') AS lines_text "
    "FROM it JOIN med USING (set_id) JOIN mea USING (set_id))")
def impute_features(spark, d):
    """C5 coerce, C6 median over items ∪ seeds, C7 mean, C8 zero, C9 'Unknown'."""
    it, sd = base_tables(spark, d)
    x = it.withColumn("name_num", F.col("name")).withColumn("lines_text", F.col("f_lines").cast("long").cast("string"))
    x = C.coerce_numeric(x, ["name_num"])
    x = C.impute_median(x, sd, ["f_qty"])
    x = C.impute_mean(x, ["f_ext"])
    x = C.impute_zero(x, ["f_disc"])
    x = C.impute_unknown(x, ["lines_text"])
    x = x.select("item_id", "set_id", "name_num", F.col("f_qty").alias("qty_median"),
                 F.col("f_ext").alias("ext_mean"), F.col("f_disc").alias("disc_zero"), "lines_text")
    return out(x, _IMP)


# ------------------------------------------------------------------ C10 C11

_CC = " AND ".join(f"{f} IS NOT NULL" for f in FEATURES)


@register("complete_cases", S.base() +
          f"SELECT set_id, count(*) AS rows, count(*) FILTER (WHERE {_CC}) AS complete FROM cand GROUP BY set_id")
def complete_cases(spark, d):
    """C11 common feature columns, C10 rows with all of them."""
    cand, sd = candidates(spark, d)
    cols = C.common_columns(cand, sd, FEATURES + ["not_a_column"])
    full = C.complete_cases(cand, cols).groupBy("set_id").agg(F.count(F.lit(1)).alias("complete"))
    allr = cand.groupBy("set_id").agg(F.count(F.lit(1)).alias("rows"))
    return allr.join(full, "set_id", "left").select("set_id", "rows", F.coalesce("complete", F.lit(0)).alias("complete"))


# ------------------------------------------------------------------ C12 C13

EXCLUDED_TAGS = ["ring", "bolt"]
EXCLUDED_OWNERS = ["Brand#1", "Brand#2"]


@register("exclude_tags_owners", "SELECT p_partkey, p_brand, tags FROM (SELECT p_partkey, p_brand, "
          "replace(p_name, ' ', ',') AS tags FROM part) WHERE (tags IS NULL OR NOT list_has_any(string_split(tags, ','), "
          f"{EXCLUDED_TAGS!r})) AND (p_brand IS NULL OR p_brand NOT IN ({', '.join(repr(o) for o in EXCLUDED_OWNERS)}))")
def exclude_tags_owners(spark, d):
    """C12 drop rows carrying an excluded tag, C13 drop excluded owners."""
    p = DV.part_tags(spark, d)
    p = C.exclude_by_tags(p, "tags", EXCLUDED_TAGS)
    p = C.exclude_by_value(p, "p_brand", EXCLUDED_OWNERS)
    return p.select("p_partkey", "p_brand", "tags")


# ------------------------------------------------------------------ C14


@register("threshold_filter", S.base(*S.cosine_score_ctes("cand", "sd", FEATURES, "cos")) +
          "SELECT set_id, item_id, round(cosine_score, 6) AS cosine_score FROM cos WHERE cosine_score >= 60.0")
def threshold_filter(spark, d):
    """C14 on the cosine score (0..100 scale): keep ≥ 60."""
    cand, sd = candidates(spark, d)
    sc = M.cosine_score(cand, sd, FEATURES)
    return out(C.threshold_filter(sc, "cosine_score", 60.0), ["set_id", "item_id", "cosine_score"])


# ------------------------------------------------------------------ C16


def _mask_sql(c):
    return (f"CASE WHEN EXISTS (SELECT 1 FROM sd WHERE sd.set_id = cand.set_id AND sd.{c} = cand.{c}) "
            f"THEN cand.{c} ELSE '????' END AS {c}")


@register("mask_unseen", S.base() + "SELECT set_id, item_id, " + ", ".join(_mask_sql(c) for c in ("owner", "album", "label"))
          + " FROM cand")
def mask_unseen(spark, d):
    """Categories absent from the set's seeds → '????'."""
    cand, sd = candidates(spark, d)
    m = C.mask_unseen(cand, sd, ["owner", "album", "label"])
    return m.select("set_id", "item_id", "owner", "album", "label")


# ------------------------------------------------------------------ C15 C17

_FMT = ["set_id", "rank", "item_id", "link", "cosine_score", "base_score"]


def _fmt_sql(c):
    return f"printf('%.1f', round_even({c}, 1)) || '%' AS {c}"


@register("format_top", S.base(
    *S.cosine_score_ctes("cand", "sd", FEATURES, "cos"), *S.era_params_ctes("sd", "ep"),
    "era AS (SELECT c.*, p.era_class, p.avg_year, p.max_dist, p.max_pen FROM cos c JOIN ep p USING (set_id))",
    "b AS (SELECT *, (0.0 + coalesce(cosine_score, 0.0) * 1.0) * (1.0 - (" + S.era_item_cols()["year_adjustment"]
    + ") / 100.0) AS base_score FROM era)",
    "r AS (SELECT *, CAST(row_number() OVER (PARTITION BY set_id ORDER BY base_score DESC NULLS LAST, item_id) AS INTEGER) "
    "AS rank FROM b)",
) + f"SELECT set_id, rank, item_id, '{C.ITEM_LINK_BASE}' || CAST(item_id AS VARCHAR) AS link, "
    + _fmt_sql("cosine_score") + ", " + _fmt_sql("base_score") + " FROM r WHERE rank <= 20")
def format_top(spark, d):
    """R7 top 20 per set, C17 item link, C15 score columns as '12.3%'."""
    from seedrank.operators import select as R
    top = R.top_n(core_scored(spark, d), "base_score", "item_id", R.TOP_N).withColumn("rank", F.col("rank").cast("int"))
    top = C.item_link(top, "item_id")
    return C.format_scores(top.select(*_FMT))


# ------------------------------------------------------------------ D1


@register("dedup_by_key", S.base(
    "k AS (SELECT *, row_number() OVER (PARTITION BY set_id, lower(trim(album)) || '|' || lower(trim(owner)) "
    "ORDER BY release_date, item_id) AS rn FROM it)") + "SELECT set_id, item_id, owner, album FROM k WHERE rn = 1")
def dedup_by_key(spark, d):
    """One row per (set, album|owner) key, the earliest (release date, id) kept."""
    it, _ = base_tables(spark, d)
    return D.dedup_by_key(it, "album", "owner", ["release_date", "item_id"]).select("set_id", "item_id", "owner", "album")


# ------------------------------------------------------------------ D2 D3


@register("duplicate_count", S.base(
    "dr AS (SELECT set_id, count(*) AS distinct_rows FROM (SELECT DISTINCT set_id, owner, album FROM it) GROUP BY set_id)",
    "dc AS (SELECT set_id, count(*) - count(DISTINCT lower(trim(album)) || '|' || lower(trim(owner))) AS duplicates, "
    "count(*) AS rows FROM it GROUP BY set_id)") + "SELECT set_id, rows, duplicates, distinct_rows FROM dc JOIN dr USING (set_id)")
def duplicate_count(spark, d):
    """D3 rows minus distinct keys, D2 distinct rows, per set."""
    it, _ = base_tables(spark, d)
    dc = D.duplicate_count(it, "album", "owner")
    dr = D.distinct_rows(it.select("set_id", "owner", "album")).groupBy("set_id").agg(F.count(F.lit(1)).alias("distinct_rows"))
    return dc.join(dr, "set_id").select("set_id", "rows", "duplicates", "distinct_rows")


# ------------------------------------------------------------------ D4 D6


@register("union_seed_items", S.base(
    "u AS (SELECT set_id, 0 AS label FROM cand UNION ALL SELECT set_id, 1 AS label FROM sd, range(5))")
    + "SELECT set_id, label, count(*) AS n FROM u GROUP BY set_id, label")
def union_seed_items(spark, d):
    """D6 seeds repeated 5 times, D4 stacked with the candidates under a 0/1 label."""
    cand, sd = candidates(spark, d)
    up = D.upsample(sd, 5, weight_col=None)
    u = D.union_seed_items(up, cand, ["set_id"])
    return u.groupBy("set_id", F.col("label").cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ D5


@register("distinct_tags", "SELECT DISTINCT trim(t) AS value FROM (SELECT unnest(string_split(replace(p_name, ' ', ','), ','))"
          " AS t FROM part) WHERE t IS NOT NULL ORDER BY value")
def distinct_tags(spark, d):
    """Sorted distinct tags of the part catalogue."""
    return D.distinct_values(DV.part_tags(spark, d), "tags", ",")


# ------------------------------------------------------------------ J1


@register("match_rate", S.base(
    "m AS (SELECT s.set_id, count(*) AS seed_rows, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM it i WHERE i.set_id = s.set_id "
    "AND lower(i.name) || '|' || lower(i.owner) = lower(s.name) || '|' || lower(s.owner))) AS matched FROM sd s GROUP BY s.set_id)")
    + "SELECT set_id, seed_rows, matched FROM m")
def match_rate(spark, d):
    """Seed rows found among the set's items by lower(name)|lower(owner)."""
    it, sd = base_tables(spark, d)
    return J.match_rate(sd, it, "name", "owner")


# ------------------------------------------------------------------ J2


@register("enrich_from_items", S.base(
    S.order_tags_cte("otags"),
    "cat AS (SELECT it.set_id, lower(it.name) || '|' || lower(it.owner) AS k, it.item_id, o.tags FROM it "
    "LEFT JOIN otags o USING (item_id))",
    "first AS (SELECT set_id, k, tags FROM (SELECT *, row_number() OVER (PARTITION BY set_id, k ORDER BY item_id) AS rn "
    "FROM cat) WHERE rn = 1)")
    + "SELECT s.set_id, s.item_id, f.tags AS tags FROM sd s LEFT JOIN first f ON f.set_id = s.set_id "
      "AND f.k = lower(s.name) || '|' || lower(s.owner)")
def enrich_from_items(spark, d):
    """Seeds (no tags of their own) take the tags of the first matching item."""
    it, sd = base_tables(spark, d)
    tagged = it.join(DV.order_tags(spark, d), "item_id", "left")
    seeds = sd.withColumn("tags", F.lit(None).cast("string"))
    e = J.enrich_from_items(seeds, tagged, "name", "owner", "tags", None, ["item_id"])
    return e.select("set_id", "item_id", "tags")


# ------------------------------------------------------------------ J3


@register("exclude_seen", S.base() + "SELECT set_id, count(*) AS candidates FROM cand GROUP BY set_id")
def exclude_seen(spark, d):
    """Items left per set once the set's seeds are removed."""
    cand, _ = candidates(spark, d)
    return cand.groupBy("set_id").agg(F.count(F.lit(1)).alias("candidates"))


# ------------------------------------------------------------------ J4

_J4_OWNER = "p_brand || CASE WHEN p_size <= 2 THEN ',' || p_type ELSE '' END"


@register("fill_tags_by_owner", "WITH pt AS (SELECT p_partkey, p_brand, p_type, p_size, replace(p_name, ' ', ',') AS tags FROM part),"
          f" tg AS (SELECT p_partkey, {_J4_OWNER} AS owner, NULL::VARCHAR AS tags FROM pt WHERE p_size <= 5),"
          " cat AS (SELECT p_brand AS owner, tags FROM pt WHERE p_size > 5 AND tags IS NOT NULL AND trim(tags) <> ''),"
          " ex AS (SELECT lower(owner) AS o, lower(trim(t)) AS t FROM (SELECT owner, unnest(string_split(tags, ',')) AS t FROM cat)),"
          " cnt AS (SELECT o, t, count(*) AS n FROM ex WHERE t <> '' GROUP BY o, t),"
          " best AS (SELECT *, row_number() OVER (PARTITION BY o ORDER BY n DESC, t) AS r FROM cnt),"
          " f AS (SELECT o, string_agg(t, ', ' ORDER BY r) AS fill FROM best WHERE r <= 3 GROUP BY o)"
          " SELECT tg.p_partkey, tg.owner, coalesce(f1.fill, f2.fill, tg.tags) AS tags FROM tg"
          " LEFT JOIN f f1 ON f1.o = lower(tg.owner)"
          " LEFT JOIN f f2 ON f2.o = CASE WHEN contains(tg.owner, ',') THEN lower(trim(split_part(tg.owner, ',', 1))) END")
def fill_tags_by_owner(spark, d):
    """Parts of size ≤ 5 lose their tags; they get the top-3 tags of the owner's other parts
    (owner = brand, or 'brand,type' for size ≤ 2, which falls back to the brand)."""
    p = DV.part_tags(spark, d)
    tg = p.where(F.col("p_size") <= 5).select(
        "p_partkey", F.concat(F.col("p_brand"), F.when(F.col("p_size") <= 2, F.concat(F.lit(","), F.col("p_type")))
                              .otherwise(F.lit(""))).alias("owner"), F.lit(None).cast("string").alias("tags"))
    cat = p.where(F.col("p_size") > 5).select(F.col("p_brand").alias("owner"), "tags")
    return J.fill_tags_by_owner(tg, cat, "owner", "tags").select("p_partkey", "owner", "tags")


@register("fill_tags", "WITH pt AS (SELECT p_partkey, p_name, p_brand, p_size, replace(p_name, ' ', ',') AS tags FROM part),"
          " tg AS (SELECT p_partkey, p_name, p_brand AS owner FROM pt WHERE p_size <= 5),"
          " rf AS (SELECT lower(trim(p_name)) || '|' || lower(trim(p_brand)) AS k, min('size ' || p_size) AS ref FROM pt WHERE p_size BETWEEN 6 AND 20 GROUP BY k),"
          " ex AS (SELECT lower(p_brand) AS o, lower(trim(t)) AS t FROM (SELECT p_brand, unnest(string_split(tags, ',')) AS t FROM pt WHERE p_size > 5)),"
          " cnt AS (SELECT o, t, count(*) AS n FROM ex WHERE t <> '' GROUP BY o, t),"
          " best AS (SELECT *, row_number() OVER (PARTITION BY o ORDER BY n DESC, t) AS r FROM cnt),"
          " f AS (SELECT o, string_agg(t, ', ' ORDER BY r) AS fill FROM best WHERE r <= 3 GROUP BY o)"
          " SELECT p_partkey, owner, coalesce(ref, fill) AS tags FROM tg LEFT JOIN rf ON k = lower(trim(p_name)) || '|' || lower(trim(owner))"
          " LEFT JOIN f ON o = lower(owner)")
def fill_tags(spark, d):
    """J4 in both steps: parts of size ≤ 5 take the tag text of the same name and brand in a reference
    table (sizes 6 to 20), the others the top-3 tags of their brand."""
    p = DV.table(spark, d, "part").select("p_partkey", F.col("p_name").alias("name"), F.col("p_brand").alias("owner"), "p_size",
                                          F.regexp_replace("p_name", " ", ",").alias("tags"))
    tg = p.where(F.col("p_size") <= 5).withColumn("tags", F.lit(None).cast("string"))
    ref = p.where(F.col("p_size").between(6, 20)).withColumn("tags", F.concat(F.lit("size "), F.col("p_size").cast("string")))
    return J.fill_tags(tg, p.where(F.col("p_size") > 5), "owner", "tags", "name", ref).select("p_partkey", "owner", "tags")


# ------------------------------------------------------------------ J5 V2 V3

_DIMS_OUT = ["item_id", "v0", "v1", "v63", "v_sum"]


def _lookup_sql():
    dims = ", ".join(f"avg(vec[{i + 1}]) AS d{i}" for i in range(DV.VEC_DIM))
    vsum = " + ".join(f"d{i}" for i in range(DV.VEC_DIM))
    return ("WITH lk AS (SELECT lower(replace(s.s_name, '#', '-')) AS v, e.embedding AS vec FROM supplier s "
            "JOIN embeddings e ON e.vec_id = s.s_suppkey),"
            " pr AS (SELECT l.l_orderkey AS item_id, l.l_linenumber AS pos, lower(replace(s.s_name, '#', ' ')) AS tag "
            "FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey),"
            " tg AS (SELECT DISTINCT tag FROM pr),"
            " var AS (SELECT tag, 0 AS r, tag AS v FROM tg UNION ALL SELECT tag, 1, replace(tag, ' ', '-') FROM tg"
            " UNION ALL SELECT tag, 2, replace(tag, '-', ' ') FROM tg),"
            " hit AS (SELECT tag, vec, row_number() OVER (PARTITION BY tag ORDER BY r) AS rn FROM var JOIN lk USING (v)),"
            f" pooled AS (SELECT item_id, {dims} FROM pr JOIN hit USING (tag) WHERE rn = 1 GROUP BY item_id)"
            f" SELECT item_id, round(d0, 6) AS v0, round(d1, 6) AS v1, round(d63, 6) AS v63, round({vsum}, 6) AS v_sum FROM pooled")


@register("lookup_vectors", _lookup_sql())
def lookup_vectors(spark, d):
    """J5 tag → vector with blank/dash variants, V3 mean pool per order. Tags are the
    suppliers of the order's lines ('supplier 000000001'); the lookup keys are dashed."""
    sup = DV.table(spark, d, "supplier")
    emb = DV.table(spark, d, "embeddings")
    lk = sup.join(emb, emb.vec_id == sup.s_suppkey).select(F.lower(F.regexp_replace("s_name", "#", "-")).alias("tag"),
                                                           F.col("embedding").alias("vec"))
    li = DV.table(spark, d, "lineitem").join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
    pairs = li.select(F.col("l_orderkey").alias("item_id"), F.col("l_linenumber").alias("pos"),
                      F.lower(F.regexp_replace("s_name", "#", " ")).alias("tag"))
    v = J.lookup_vector_pairs(pairs, ["item_id"], "pos", "tag", lk, DV.VEC_DIM)
    vsum = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x)
    return out(v.select("item_id", F.col("vec")[0].alias("v0"), F.col("vec")[1].alias("v1"),
                        F.col("vec")[63].alias("v63"), vsum.alias("v_sum")), _DIMS_OUT)
