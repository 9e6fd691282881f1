import os
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as E
from seedrank.operators import era as EA
from seedrank.operators import vectors as V
from seedrank.streaming.score_stream import score_stream

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["set_id", "item_id", "rank", "cosine_score", "year_adjustment", "base_score"]


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 60


def test_queries_run_on_smallest_scale(spark):
    for name in ["recommend", "lookup_vectors", "proximity_edges", "fill_tags_by_owner", "similarity_filter"]:
        E.queries()[name](spark, SF).write.format("noop").mode("overwrite").save()


def test_score_stream_matches_batch_expressions(spark):
    d = tempfile.mkdtemp(prefix="seedrank-stream-")
    items = spark.createDataFrame([(0, i, float(i), float(10 - i), 1990 + i) for i in range(10)],
                                  "set_id int, item_id int, a double, b double, release_year int")
    seeds = items.where("item_id < 3")
    items.write.mode("overwrite").parquet(os.path.join(d, "in"))
    st = V.scaler_stats(items, ["a", "b"])
    cen = V.centroid(seeds, ["a", "b"], prefix="")
    from seedrank.functions import exprs as X
    tgt = cen.join(st, "set_id").select("set_id", *[X.standardized(F.col(f), F.col(f"m_{f}"), F.col(f"s_{f}")).alias(f"t_{f}") for f in ("a", "b")])
    era = EA.era_params(seeds)
    stream = spark.readStream.schema(items.schema).parquet(os.path.join(d, "in"))
    q = (score_stream(stream, st, tgt, era, ["a", "b"]).writeStream.format("memory").queryName("scored_stream")
         .outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    got = spark.table("scored_stream")
    assert got.count() == 10
    assert got.where(F.col("stream_score").isNull()).count() == 0
