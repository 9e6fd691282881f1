from pyspark.sql import functions as F

from seedrank.operators import clean as C
from seedrank.operators import dedup as D


def test_clean_items_drops_self_titled_keeps_nulls(spark):
    df = spark.createDataFrame(
        [("Same", "Same", "2001-01-01", "x"), ("Song", None, "1999", "y"), ("A", "B", "Jan 1987", "z")],
        "`Track Name` string, `Artist Name(s)` string, `Release Date` string, `Added By` string")
    out = C.clean_items(df, "Track Name", "Artist Name(s)", "Release Date").collect()
    assert [r["Release Date"] for r in out] == ["1999", "1987"]
    assert "Added By" not in out[0].asDict()


def test_impute_and_mask(spark):
    items = spark.createDataFrame([(0, 1, None, "a"), (0, 2, 4.0, "b"), (0, 3, 6.0, None)], "set_id int, id int, v double, cat string")
    seeds = spark.createDataFrame([(0, 9, 10.0, "a")], "set_id int, id int, v double, cat string")
    med = {r.id: r.v for r in C.impute_median(items, seeds, ["v"]).collect()}
    assert med[1] == 6.0  # median of 4, 6, 10
    mean = {r.id: r.v for r in C.impute_mean(items, ["v"]).collect()}
    assert mean[1] == 5.0
    masked = {r.id: r.cat for r in C.mask_unseen(C.impute_unknown(items, ["cat"]), seeds, ["cat"]).collect()}
    assert masked == {1: "a", 2: "????", 3: "????"}


def test_exclude_by_tags_untrimmed(spark):
    df = spark.createDataFrame([("rock,pop",), ("rock, pop",), (None,)], "g string")
    got = [r.g for r in C.exclude_by_tags(df, "g", ["pop"]).collect()]
    assert got == ["rock, pop", None]  # ' pop' is not 'pop': the reference does not trim


def test_format_scores_half_even(spark):
    df = spark.createDataFrame([(12.25, 1)], "cosine_score double, n int")
    assert C.format_scores(df).first().cosine_score == "12.2%"


def test_keep_first_is_min_by_order_and_groups_nulls(spark):
    df = spark.createDataFrame([(0, "A ", "x", 3), (0, "a", "X", 1), (0, None, "x", 5), (0, None, "x", 4)],
                               "set_id int, name string, owner string, id int")
    got = sorted(r.id for r in D.dedup_by_key(df, "name", "owner", ["id"]).collect())
    # 'A ' and 'a' share the trimmed, lower-cased key (first by id: 1); the NULL-name rows
    # form one group (first: 4)
    assert got == [1, 4]


def test_duplicate_count_and_upsample(spark):
    df = spark.createDataFrame([(0, "a", "x"), (0, "A", "x"), (0, "b", "y")], "set_id int, name string, owner string")
    r = D.duplicate_count(df, "name", "owner").first()
    assert (r.rows, r.duplicates) == (3, 1)
    assert D.upsample(df, 5, None).count() == 15
    assert D.upsample(df, 5).select(F.max("weight")).first()[0] == 5.0


def test_exact_median_matches_numpy_with_ties_and_small_accuracy(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    data = {0: rng.normal(size=5001), 1: np.r_[np.zeros(3000), rng.normal(size=2000)], 2: np.array([4.0, 1.0]),
            3: np.array([7.0]), 4: rng.integers(0, 5, size=4000).astype(float)}
    rows = [(k, float(v)) for k, vs in data.items() for v in vs] + [(0, None)]
    df = spark.createDataFrame(rows, "set_id int, x double")
    for acc in (100, 100_000):  # a coarse accuracy forces wide bands / the fallback path
        got = {r.set_id: r.median for r in C.exact_median(df, "x", accuracy=acc).collect()}
        for k, vs in data.items():
            assert abs(got[k] - float(np.median(vs))) < 1e-12, (acc, k)


def _first_rows(rows, order):
    """Brute force: the first row of every (set, trimmed lower-case name and owner); NULLs first, a NULL name or owner is one key."""
    groups = {}
    for r in rows:
        k = None if r["name"] is None or r["owner"] is None else (r["name"].strip(" ").lower(), r["owner"].strip(" ").lower())
        groups.setdefault((r["set_id"], k), []).append(r)
    place = lambda r: tuple((r[c] is not None, r[c] if r[c] is not None else 0) for c in order)
    return sorted((min(g, key=place) for g in groups.values()), key=repr)


def test_dedup_reduces_only_rows_that_can_be_first(spark):
    """Many listings of few tracks: their rows meet the keys by broadcast and are not shuffled to find repeated ones."""
    rows = [{"set_id": None if i % 41 == 0 else i % 3, "name": None if i % 37 == 0 else ("Ab ", "ab", "é")[i % 3], "owner": ("x", " X", "y")[i // 3 % 3], "id": i,
             "day": None if i % 97 == 5 else ("", "é", "2020-01-3", "2020-01-29", "2020-01-290")[i * 7 % 5 if i % 11 else 2], "n": None if i % 89 == 2 else (i * 31) % 50,
             "x": None if i % 83 == 2 else float((i * 17) % 23)} for i in range(1200)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "set_id int, name string, owner string, id long, day string, n int, x double")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for order in (["day", "id"], ["n", "id"], ["x", "id"]):
            want = _first_rows(rows, order)
            for how in ({}, {"max_bytes": 0}):  # all keys broadcast; more keys than that
                got = D.dedup_by_key(df, "name", "owner", order, **how)
                assert sorted((r.asDict() for r in got.collect()), key=repr) == want
        plan = D.dedup_by_key(df, "name", "owner", ["day", "id"])._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
