from pyspark.sql import functions as F

from seedrank.functions import exprs as X


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"c {typ}")


def test_extract_year_text(spark):
    vals = ["2019-05-01", "1999", "Released 1987 remaster", "20105", "12", None, "abc"]
    got = [r[0] for r in one_col(spark, vals).select(X.extract_year_text("c")).collect()]
    assert got == ["2019", "1999", "1987", "2010", "12", None, "abc"]


def test_release_year(spark):
    vals = ["2019-05-01", "2019-05", "1999", "1850", "live in 2003", "x", None]
    got = [r[0] for r in one_col(spark, vals).select(X.release_year("c")).collect()]
    # a bare 4-digit year parses as a date first (1850-01-01), as a full date parse does
    assert got == [2019, 2019, 1999, 1850, 2003, None, None]


def test_parse_vector_forms(spark):
    vals = ["[0.5, -1.0, 2]", "0.5 -1.0\n 2", "[0.5, oops, 2]", None, ""]
    got = [r[0] for r in one_col(spark, vals).select(X.parse_vector("c", 3)).collect()]
    assert got == [[0.5, -1.0, 2.0], [0.5, -1.0, 2.0], [0.0] * 3, [0.0] * 3, [0.0] * 3]


def test_split_tags(spark):
    got = [r[0] for r in one_col(spark, [" Pop, indie POP ", None]).select(X.split_tags("c")).collect()]
    assert got == [["pop", "indie pop"], []]


def test_null_safe_ne_and_clip(spark):
    df = spark.createDataFrame([("a", "a"), ("a", None), (None, None), ("a", "b")], "x string, y string")
    assert [r[0] for r in df.select(X.null_safe_ne("x", "y")).collect()] == [False, True, True, True]
    d = spark.createDataFrame([(5.0,), (-3.0,), (None,)], "v double")
    assert [r[0] for r in d.select(X.clip(F.col("v"), 0.0, 4.0)).collect()] == [4.0, 0.0, None]


def test_cosine_zero_norm(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0, 1.0), (1.0, 0.0, 1.0, 0.0), (1.0, 1.0, -1.0, -1.0)], "a double, b double, c double, d double")
    got = [round(r[0], 12) for r in df.select(X.cosine([F.col("a"), F.col("b")], [F.col("c"), F.col("d")])).collect()]
    assert got == [0.0, 1.0, -1.0]


def test_minmax_flat_rules(spark):
    df = spark.createDataFrame([(0.5,)], "x double")
    lo, hi = F.lit(0.5), F.lit(0.5)
    r = df.select(X.minmax_100(F.col("x"), lo, hi, "fifty"), X.minmax_100(F.col("x"), lo, hi, "glm"),
                  X.minmax_100(F.col("x"), lo, hi, "keep")).first()
    assert tuple(r) == (50.0, 50.0, 0.5)
