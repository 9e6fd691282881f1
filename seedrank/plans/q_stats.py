"""Registered queries: summaries (A*) and the era adjustment (T*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedrank.operators import era as E
from seedrank.operators import score as M
from seedrank.operators import stats as A
from seedrank.plans import driver_views as DV
from seedrank.plans import sqlgen as S
from seedrank.plans.queries import FEATURES, base_tables, candidates, core_scored, out, register

ERA_COLS = S.era_item_cols()


def era_sql(src: str = "cand", seeds: str = "sd", out_name: str = "era") -> list[str]:
    """CTEs: era params of ``seeds`` and ``out_name`` = src rows + all T1–T7 columns."""
    o, lab = S.adj_bin("year_adjustment")
    return [
        *S.era_params_ctes(seeds, "ep"),
        f"{out_name}_a AS (SELECT c.*, p.era_class, p.avg_year, p.max_dist, p.max_pen FROM {src} c JOIN ep p USING (set_id))",
        f"{out_name}_b AS (SELECT *, " + ", ".join(f"{v} AS {k}" for k, v in ERA_COLS.items()) + f" FROM {out_name}_a)",
        f"{out_name}_m AS (SELECT set_id, max(year_distance) AS maxd FROM {out_name}_b GROUP BY set_id)",
        f"{out_name} AS (SELECT b.*, {o} AS adj_bin_ord, {lab} AS adj_bin, CASE WHEN m.maxd > 0 THEN "
        f"100.0 - b.year_distance / m.maxd * 100.0 ELSE 100.0 END AS year_score FROM {out_name}_b b JOIN {out_name}_m m USING (set_id))",
    ]


def era_frame(spark: SparkSession, d: str) -> DataFrame:
    cand, sd = candidates(spark, d)
    return E.apply_era(cand, E.era_params(sd), with_score=True)


# ------------------------------------------------------------------ A1

@register("tag_counts", S.base(
    S.order_tags_cte("otags"),
    "x AS (SELECT sd.set_id, trim(unnest(string_split(o.tags, ','))) AS tag FROM sd JOIN otags o USING (item_id))",
    "c AS (SELECT set_id, tag, count(*) AS n FROM x GROUP BY set_id, tag)",
    "r AS (SELECT *, CAST(row_number() OVER (PARTITION BY set_id ORDER BY n DESC, tag) AS INTEGER) AS rank FROM c)")
    + "SELECT set_id, tag, n, rank FROM r WHERE rank <= 5")
def tag_counts(spark, d):
    """A1: the five most frequent tags of each seed set."""
    _, sd = base_tables(spark, d)
    t = sd.join(DV.order_tags(spark, d), "item_id")
    return A.tag_counts(t, "tags", 5).select("set_id", "tag", "n", F.col("rank").cast("int").alias("rank"))


# ------------------------------------------------------------------ A2

@register("decade_histogram", S.base(
    "h AS (SELECT set_id, CAST(floor(release_year / 10) * 10 AS INTEGER) AS decade, count(*) AS n FROM cand "
    "WHERE release_year IS NOT NULL GROUP BY ALL)",
    "t AS (SELECT set_id, count(*) AS tot FROM cand WHERE release_year IS NOT NULL GROUP BY set_id)")
    + "SELECT set_id, decade, n, round(n / tot, 6) AS share FROM h JOIN t USING (set_id)")
def decade_histogram(spark, d):
    """A2: candidates per decade and share."""
    cand, _ = candidates(spark, d)
    return out(A.decade_histogram(cand), ["set_id", "decade", "n", "share"])


# ------------------------------------------------------------------ A3 A4 T2

_EP = ["set_id", "avg_year", "min_year", "max_year", "year_range", "std_year", "n_dated", "focus_decade",
       "era_class", "max_dist", "max_pen"]


@register("era_params", S.base(*S.era_params_ctes("sd", "ep")) + "SELECT " + S.rounded(_EP, ["std_year", "max_pen"]) + " FROM ep")
def era_params(spark, d):
    """A3 year stats, A4 decade focus, T2 era class with its penalty constants."""
    _, sd = base_tables(spark, d)
    return out(E.era_params(sd), _EP)


# ------------------------------------------------------------------ A5 A6

TEMPO_LIKE = ["f_qty"]
DB_LIKE = ["f_disc"]


def _levels_sql():
    rows = " UNION ALL ".join(f"SELECT set_id, '{f}' AS feature, avg({f}) AS mean FROM sd GROUP BY set_id" for f in FEATURES)

    def rule(lo, hi, low, high):
        return f"CASE WHEN mean > {hi} THEN '{high}' WHEN mean < {lo} THEN '{low}' ELSE '{A.LEVEL_MID}' END"
    lvl = (f"CASE WHEN feature IN ({', '.join(repr(x) for x in DB_LIKE)}) THEN {rule(*A.LEVELS_DB)} "
           f"WHEN feature IN ({', '.join(repr(x) for x in TEMPO_LIKE)}) THEN {rule(*A.LEVELS_TEMPO)} ELSE {rule(*A.LEVELS_UNIT)} END")
    return S.base(f"m AS ({rows})") + f"SELECT set_id, feature, round(mean, 6) AS mean, {lvl} AS level FROM m"


@register("feature_levels", _levels_sql())
def feature_levels(spark, d):
    """A5 seed feature means, A6 level labels."""
    _, sd = base_tables(spark, d)
    m = A.feature_levels(A.feature_means(sd, FEATURES), DB_LIKE, TEMPO_LIKE)
    return out(m, ["set_id", "feature", "mean", "level"])


def _trends_sql():
    rows = " UNION ALL ".join(f"SELECT set_id, '{f}' AS feature, avg({f}) AS mean FROM sd GROUP BY set_id" for f in FEATURES)
    tlo, thi, tlow, thigh, tmid = A.TRENDS_TEMPO
    olo, ohi, olow, ohigh, omid = A.TRENDS_OTHER
    lab = (f"CASE WHEN feature IN ({', '.join(repr(x) for x in TEMPO_LIKE)}) THEN (CASE WHEN mean >= {thi} THEN '{thigh}' "
           f"WHEN mean < {tlo} THEN '{tlow}' ELSE '{tmid}' END) ELSE (CASE WHEN mean > {ohi} THEN '{ohigh}' "
           f"WHEN mean < {olo} THEN '{olow}' ELSE '{omid}' END) END")
    return S.base(f"m AS ({rows})") + f"SELECT set_id, feature, round(mean, 6) AS mean, {lab} AS trend FROM m"


@register("feature_trends", _trends_sql())
def feature_trends(spark, d):
    """Console trend labels of the seed feature means (tempo-like: fast / slow / medium)."""
    _, sd = base_tables(spark, d)
    return out(A.feature_trends(A.feature_means(sd, FEATURES), TEMPO_LIKE), ["set_id", "feature", "mean", "trend"])


# ------------------------------------------------------------------ T1–T7

_ERA = ["set_id", "item_id", "release_year", "year_distance", "year_penalty", "recency_bonus", "year_adjustment",
        "adj_bin_ord", "adj_bin", "year_score"]


@register("era_adjustment", S.base(*era_sql()) + "SELECT " + S.rounded(
    _ERA, ["year_penalty", "recency_bonus", "year_adjustment", "year_score"]) + " FROM era")
def era_adjustment(spark, d):
    """T1 distance, T3 penalty, T4 bonus, T5 adjustment, T6 year score, T7 bin."""
    return out(era_frame(spark, d), _ERA)


# ------------------------------------------------------------------ A9

@register("adjustment_histogram", S.base(
    *era_sql(),
    "h AS (SELECT set_id, adj_bin_ord, adj_bin, count(*) AS n FROM era WHERE adj_bin IS NOT NULL GROUP BY ALL)",
    "t AS (SELECT set_id, count(*) AS tot FROM era GROUP BY set_id)")
    + "SELECT set_id, adj_bin_ord, adj_bin, n, round(n / tot, 6) AS share FROM h JOIN t USING (set_id)")
def adjustment_histogram(spark, d):
    """Candidates per adjustment bin."""
    return out(A.adjustment_histogram(era_frame(spark, d)), ["set_id", "adj_bin_ord", "adj_bin", "n", "share"])


# ------------------------------------------------------------------ A10 A11

def _hist_sql(src_ctes, src, col, bins):
    return S.base(
        *src_ctes,
        f"mm AS (SELECT set_id, min({col}) AS lo, max({col}) AS hi, avg({col}) AS mean FROM {src} WHERE {col} IS NOT NULL GROUP BY set_id)",
        f"b AS (SELECT s.set_id, lo, hi, mean, CAST(CASE WHEN hi > lo THEN least(floor(({col} - lo) / (hi - lo) * {bins}), {bins - 1}) "
        f"ELSE 0 END AS INTEGER) AS bin FROM {src} s JOIN mm USING (set_id) WHERE {col} IS NOT NULL)",
        "h AS (SELECT set_id, bin, lo, hi, mean, count(*) AS n FROM b GROUP BY ALL)",
    ) + (f"SELECT set_id, bin, round(lo + bin * ((hi - lo) / {bins}), 6) AS bin_lo, round(lo + (bin + 1) * ((hi - lo) / {bins}), 6) AS bin_hi, "
         "n, round(mean, 6) AS mean FROM h")


_HIST = ["set_id", "bin", "bin_lo", "bin_hi", "n", "mean"]


@register("year_histogram", _hist_sql([], "cand", "release_year", 30))
def year_histogram(spark, d):
    """A10: 30 equal-width bins of candidate release years per set, and the mean."""
    cand, _ = candidates(spark, d)
    return out(A.histogram(cand, "release_year", 30), _HIST)


@register("score_histogram", _hist_sql(S.cosine_score_ctes("cand", "sd", FEATURES, "cos"), "cos", "cosine_score", 10))
def score_histogram(spark, d):
    """10 bins of the cosine score per set, and the mean."""
    cand, sd = candidates(spark, d)
    return out(A.histogram(M.cosine_score(cand, sd, FEATURES), "cosine_score", 10), _HIST)


# ------------------------------------------------------------------ A12

_SS = ["set_id", "score", "nonzero", "nonzero_share", "nonzero_mean", "nonzero_min", "max", "zeros"]


def _summary_sql():
    parts = " UNION ALL ".join(f"SELECT set_id, '{s}' AS score, {s} AS v FROM era" for s in ("cosine_score", "year_score"))
    return S.base(
        *S.cosine_score_ctes("cand", "sd", FEATURES, "cos"), *era_sql("cos", "sd", "era"), f"l AS ({parts})"
    ) + ("SELECT set_id, score, count(*) FILTER (WHERE v > 0) AS nonzero, round(count(*) FILTER (WHERE v > 0) / count(*), 6) "
         "AS nonzero_share, round(avg(v) FILTER (WHERE v > 0), 6) AS nonzero_mean, round(min(v) FILTER (WHERE v > 0), 6) "
         "AS nonzero_min, round(max(v), 6) AS max, count(*) FILTER (WHERE v = 0) AS zeros FROM l GROUP BY set_id, score")


@register("score_summary", _summary_sql())
def score_summary(spark, d):
    """Per score, non-zero count/share/mean/min, max and zero count."""
    cand, sd = candidates(spark, d)
    sc = E.apply_era(M.cosine_score(cand, sd, FEATURES), E.era_params(sd), with_score=True)
    return out(A.score_summary(sc, ["cosine_score", "year_score"]), _SS)


# ------------------------------------------------------------------ A13

_RC = ["set_id", "items", "seeds", "candidates", "dropped", "share_kept", "missing_features"]


@register("run_counters", S.base(
    "a AS (SELECT set_id, count(*) AS items FROM it GROUP BY set_id)",
    "b AS (SELECT set_id, count(*) AS seeds FROM sd GROUP BY set_id)",
    "c AS (SELECT set_id, count(*) AS candidates, count(*) FILTER (WHERE f_qty IS NULL) AS missing_features FROM cand GROUP BY set_id)")
    + "SELECT set_id, items, coalesce(seeds, 0) AS seeds, coalesce(candidates, 0) AS candidates, items - coalesce(candidates, 0) AS dropped, "
      "round(coalesce(candidates, 0) / items, 6) AS share_kept, coalesce(missing_features, 0) AS missing_features FROM a LEFT JOIN b USING (set_id) LEFT JOIN c USING (set_id)")
def run_counters(spark, d):
    """Catalogue, seed and candidate sizes, dropped rows, share kept, missing features."""
    it, sd = base_tables(spark, d)
    cand, _ = candidates(spark, d)
    a = it.groupBy("set_id").agg(F.count(F.lit(1)).alias("items"))
    b = sd.groupBy("set_id").agg(F.count(F.lit(1)).alias("seeds"))
    c = cand.groupBy("set_id").agg(F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("f_qty").isNull()).alias("missing_features"))
    j = a.join(b, "set_id", "left").join(c, "set_id", "left").na.fill(0, ["seeds", "candidates", "missing_features"])
    j = j.withColumn("dropped", F.col("items") - F.col("candidates")).withColumn("share_kept", F.col("candidates") / F.col("items"))
    return out(j, _RC)


# ------------------------------------------------------------------ A14 + T4 recent branch

def recent_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Orders (1995–2001) plus events (2024) as one catalogue per customer nation; the seeds
    are the purchase events, so every set is 'recent'. Events get negative ids."""
    it, _ = base_tables(spark, d)
    ev = DV.table(spark, d, "events")
    cu = DV.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    e = ev.join(cu, ev.user_id == cu.c_custkey).select(
        (-(F.col("event_id") + 1)).alias("item_id"), F.col("c_nationkey").alias("set_id"),
        F.year("ts").alias("release_year"), F.col("event_type"))
    cat = it.select("item_id", "set_id", "release_year", F.lit("order").alias("event_type")).unionByName(e)
    seeds = cat.where(F.col("event_type") == "purchase")
    return cat.where(F.col("event_type") != "purchase"), seeds


_RECENT_SQL = ("ev AS (SELECT -(e.event_id + 1) AS item_id, c.c_nationkey AS set_id, CAST(year(e.ts) AS INTEGER) AS release_year, "
               "e.event_type FROM events e JOIN customer c ON e.user_id = c.c_custkey)",
               "cat AS (SELECT item_id, set_id, release_year, 'order' AS event_type FROM it UNION ALL SELECT * FROM ev)",
               "rsd AS (SELECT * FROM cat WHERE event_type = 'purchase')",
               "rc AS (SELECT * FROM cat WHERE event_type <> 'purchase')")
_REC = ["set_id", "era_class", "items", "eligible", "eligible_share", "mean_bonus", "min_adj", "max_adj", "avg_adj"]


@register("recency_summary", S.base(*_RECENT_SQL, *era_sql("rc", "rsd", "era")) + (
    "SELECT set_id, era_class, count(*) AS items, count(*) FILTER (WHERE release_year BETWEEN 2019 AND 2025) AS eligible, "
    "round(count(*) FILTER (WHERE release_year BETWEEN 2019 AND 2025) / count(*), 6) AS eligible_share, "
    "round(avg(recency_bonus) FILTER (WHERE release_year BETWEEN 2019 AND 2025), 6) AS mean_bonus, "
    "round(min(year_adjustment), 6) AS min_adj, round(max(year_adjustment), 6) AS max_adj, round(avg(year_adjustment), 6) AS avg_adj "
    "FROM era GROUP BY set_id, era_class"))
def recency_summary(spark, d):
    """T2 recent class, T4 recency bonus, T5 adjustment, A14 summary of the bonus."""
    cat, seeds = recent_tables(spark, d)
    p = E.era_params(seeds)
    e = E.apply_era(cat, p)
    e = e.join(p.select("set_id", "era_class"), "set_id")
    elig = F.col("release_year").between(E.RECENT_BONUS[0], E.CURRENT_YEAR)
    s = e.groupBy("set_id", "era_class").agg(
        F.count(F.lit(1)).alias("items"), F.count_if(elig).alias("eligible"),
        (F.count_if(elig) / F.count(F.lit(1))).alias("eligible_share"),
        F.avg(F.when(elig, F.col("recency_bonus"))).alias("mean_bonus"),
        F.min("year_adjustment").alias("min_adj"), F.max("year_adjustment").alias("max_adj"),
        F.avg("year_adjustment").alias("avg_adj"))
    return out(s, _REC)


# ------------------------------------------------------------------ A15

@register("year_summary", S.with_items(
    f"c AS (SELECT {S.release_year(S.extract_year_text('release_date'))} AS y FROM items WHERE NOT coalesce(name = owner, false))")
    + "SELECT y AS release_year, count(*) AS n, min(y) AS earliest, max(y) AS latest FROM c GROUP BY GROUPING SETS ((y), ())")
def year_summary(spark, d):
    """Rows per release year of the cleaned catalogue, plus one summary row (release
    year NULL) with the total and the earliest and latest year — one grouping-sets aggregate."""
    from seedrank.operators.clean import clean_items, with_release_year
    it = with_release_year(clean_items(DV.items(spark, d), "name", "owner", "release_date"), "release_date", "y")
    return it.rollup("y").agg(F.count(F.lit(1)).alias("n"), F.min("y").alias("earliest"), F.max("y").alias("latest")).select(
        F.col("y").alias("release_year"), "n", "earliest", "latest")


# ------------------------------------------------------------------ T8

_PICK = "row_number() OVER (PARTITION BY set_id ORDER BY md5(CAST(item_id AS VARCHAR)), item_id) AS rn"


@register("extreme_penalty", S.base(
    *_RECENT_SQL, *era_sql("rc", "rsd", "era"),
    "x AS (SELECT *, count(*) OVER (PARTITION BY set_id) AS n_max_penalty, CAST(row_number() OVER (PARTITION BY set_id "
    "ORDER BY year_distance DESC, item_id) AS INTEGER) AS rank FROM era WHERE year_penalty >= max_pen - 0.1)",
    "hb AS (SELECT set_id, count(*) FILTER (WHERE recency_bonus > 7.5) AS n_high_bonus FROM era GROUP BY set_id)")
    + "SELECT x.set_id, item_id, year_distance, rank, n_max_penalty, n_high_bonus FROM x JOIN hb USING (set_id) WHERE rank <= 5")
def extreme_penalty(spark, d):
    """T8 on the recent-era catalogue: rows at the maximum penalty (five shown per set, farthest first, ties by id), their number, and
    the number of rows with a recency bonus above 7.5 %."""
    from seedrank.operators.select import top_n
    cat, seeds = recent_tables(spark, d)
    e = E.apply_era(cat, E.era_params(seeds))
    mx = e.where(F.col("year_penalty") >= F.col("max_pen") - 0.1)
    cnt = mx.groupBy("set_id").agg(F.count(F.lit(1)).alias("n_max_penalty"))
    hb = e.groupBy("set_id").agg(F.count_if(F.col("recency_bonus") > 7.5).alias("n_high_bonus"))
    top = top_n(mx, "year_distance", "item_id", 5)
    return top.join(cnt, "set_id").join(hb, "set_id").select(
        "set_id", "item_id", "year_distance", F.col("rank").cast("int").alias("rank"), "n_max_penalty", "n_high_bonus")


@register("high_bonus", S.base(*_RECENT_SQL, *era_sql("rc", "rsd", "era"),
    "x AS (SELECT set_id, item_id, recency_bonus, count(*) OVER (PARTITION BY set_id) AS n_high_bonus, CAST(row_number() OVER "
    "(PARTITION BY set_id ORDER BY recency_bonus DESC, item_id) AS INTEGER) AS rank FROM era WHERE recency_bonus > 7.5)")
    + "SELECT set_id, item_id, round(recency_bonus, 6) AS recency_bonus, rank, n_high_bonus FROM x WHERE rank <= 5")
def high_bonus(spark, d):
    """T8, second list: rows with a recency bonus above 7.5 % (five shown per set, highest first), and their number."""
    from seedrank.operators.select import top_n
    cat, seeds = recent_tables(spark, d)
    hb = E.apply_era(cat, E.era_params(seeds)).where(F.col("recency_bonus") > 7.5)
    cnt = hb.groupBy("set_id").agg(F.count(F.lit(1)).alias("n_high_bonus"))
    top = top_n(hb, "recency_bonus", "item_id", 5)
    return out(top.join(cnt, "set_id").withColumn("rank", F.col("rank").cast("int")), ["set_id", "item_id", "recency_bonus", "rank", "n_high_bonus"])


# ------------------------------------------------------------------ T9 T10

@register("user_recency", S.base(
    *S.cosine_score_ctes("cand", "sd", FEATURES, "cos"), *era_sql("cos", "sd", "era"),
    "b AS (SELECT *, (0.0 + coalesce(cosine_score, 0.0) * 1.0) * (1.0 - year_adjustment / 100.0) AS base_score FROM era)",
    "mm AS (SELECT set_id, min(release_year) AS miny, max(release_year) AS maxy FROM b GROUP BY set_id)")
    + "SELECT set_id, item_id, round(base_score * (1 + 0.5 * (release_year - miny) / (CASE WHEN greatest(maxy, 2025) > miny "
      "THEN greatest(maxy, 2025) - miny ELSE 1 END)), 6) AS base_score FROM b JOIN mm USING (set_id)")
def user_recency(spark, d):
    """T9 apply the era adjustment, T10 user recency preference b = 0.5 (favour newer)."""
    sc = core_scored(spark, d)
    return out(E.user_recency(sc, "base_score", 0.5), ["set_id", "item_id", "base_score"])


# ------------------------------------------------------------------ T11

@register("sample_values", S.base(f"x AS (SELECT set_id, item_id, release_date, {_PICK} FROM sd WHERE release_date IS NOT NULL)")
          + "SELECT set_id, item_id, release_date FROM x WHERE rn <= 5")
def sample_values(spark, d):
    """A sample of five raw release dates per seed set."""
    _, sd = base_tables(spark, d)
    return E.sample_rows(sd.where(F.col("release_date").isNotNull()), "item_id", 5).select("set_id", "item_id", "release_date")
