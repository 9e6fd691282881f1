"""Exact deduplication as a stateful stream.

A batch pass writes the content table (every row once, with a row number) and a digest record per
row: digest of the text without white space, code points, identifier, row number, and the content
locator (the content table's bucket of the row). A Structured Streaming query reads the digest
records and keeps one state entry per digest in the RocksDB state store, with no watermark and so
without expiry: digest, number of rows, and the retained row (most code points, then smallest
identifier, then row number) with its locator. Records are pre-aggregated per task before they
reach the state, so a digest that holds a third of all rows costs one record a task. The state
updates go to the shared folder; the last one per digest is the outcome.

Rows that hit a known digest are then compared byte for byte with the retained content, fetched by
locator. Rows that differ (a digest collision) are grouped anew by digest and whole normalised
text, so the result is exact for any digest function.

Null text counts as empty; all texts without other characters than white space are equal. Null
identifiers come after all others. Rows that repeat in full keep exactly one row (the smallest row
number). Any long is an identifier. Extra columns pass through, whatever their names (``free_name``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ty

from seedrank.llm.tables import Staged, free_name

#: state in RocksDB; many small stores should not reserve disk ahead
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    """``text`` without the characters of ``[\\x20\\x09-\\x0D]``; null becomes empty."""
    out = F.coalesce(text, F.lit(""))
    for ch in (" ", "\n", "\t", "\r", "\x0b", "\x0c"):
        out = F.replace(out, F.lit(ch), F.lit(""))
    return out


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _best(points: str, ident: str, row: str, locator: str) -> Column:
    """Sort key whose maximum is the retained row; the complement turns the order of any long round."""
    return F.struct(F.col(points).alias("points"), F.col(ident).isNotNull().alias("known"), F.bitwise_not(ident).alias("neg_id"),
                    F.bitwise_not(row).alias("neg_row"), F.col(locator).alias("locator"))


def _run_stream(records: DataFrame, stage: Staged, batch_bytes: int) -> DataFrame:
    """Stream the digest records through the keyed state; (digest, best, n), the last per digest."""
    spark = records.sparkSession
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    out = stage.path("updates")
    try:
        source = (spark.readStream.schema(records.schema).option("maxBytesPerTrigger", str(batch_bytes))
                  .parquet(stage.path("records")))
        state = source.groupBy("digest").agg(F.max(_best("points", "ident", "row", "locator")).alias("best"), F.count(F.lit(1)).alias("n"))

        def save(batch: DataFrame, number: int) -> None:
            batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/b{number}")

        query = (state.writeStream.outputMode("update").foreachBatch(save)
                 .option("checkpointLocation", stage.path("state")).trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    schema = ty.StructType([*state.schema.fields, ty.StructField("batch", ty.IntegerType())])
    if records.isEmpty():
        return spark.createDataFrame([], state.schema)
    updates = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(out)
    return updates.groupBy("digest").agg(F.max_by(F.struct("best", "n"), "batch").alias("u")).select("digest", "u.best", "u.n")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest: Callable[[Column], Column] = sha256_digest, batch_bytes: int = 64 << 30, buckets: int = 0,
                prefix: str = "_xd_") -> DataFrame:
    """``docs`` with ``_xd_keep_id``, ``_xd_group_size``, ``_xd_kept`` and ``_xd_sha256`` (or another ``prefix`` that no column of
    ``docs`` begins with), one row per row."""
    spark = docs.sparkSession
    stage = Staged(spark, "exact")
    content = stage.write(docs.withColumn(f"{prefix}row", F.monotonically_increasing_id()), "content")
    text = normalised(F.col(text_col))
    buckets = buckets or 1024
    records = stage.write(content.select(
        digest(text).alias("digest"), F.unhex(F.sha2(text, 256)).alias("sha"),
        F.coalesce(F.length(text_col), F.lit(0)).cast("long").alias("points"),
        F.col(id_col).cast("long").alias("ident"), F.col(f"{prefix}row").alias("row"),
        F.pmod(F.xxhash64(f"{prefix}row"), F.lit(buckets)).cast("int").alias("locator")), "records")
    groups = stage.write(_run_stream(records, stage, batch_bytes), "groups")
    stage.drop("updates", "state")
    # rows of digests that were hit, with the row retained for their digest
    hits = stage.write(records.join(groups.filter("n > 1"), "digest").select(
        "digest", "points", "ident", "row", "locator", F.bitwise_not("best.neg_row").alias("kept_row"), F.col("best.locator").alias("kept_locator")), "hits")
    mine = stage.write(content.select(F.col(f"{prefix}row").alias("row"), text.alias("t")).join(hits, "row"), "members")
    held = mine.filter("row = kept_row").select(F.col("locator").alias("kept_locator"), F.col("row").alias("kept_row"), F.col("t").alias("kept_t"))
    checked = stage.write(mine.join(held, ["kept_locator", "kept_row"]).select("digest", "row", (F.col("t") == F.col("kept_t")).alias("same")), "checked")
    odd = checked.filter("not same")
    if odd.isEmpty():
        outcome = groups
        joined = records.join(outcome, "digest")
    else:
        # collisions: every digest with a differing row is grouped anew by its whole text
        clash = odd.select("digest").distinct()
        again = mine.join(clash, "digest", "left_semi")
        parts = again.groupBy("digest", "t").agg(F.max(_best("points", "ident", "row", "locator")).alias("best"), F.count(F.lit(1)).alias("n"))
        regrouped = again.select("digest", "t", "points", "ident", "row", "locator").join(parts, ["digest", "t"])
        regrouped = records.select("row", "sha").join(regrouped.select("row", "points", "ident", "best", "n"), "row")
        plain = records.join(clash, "digest", "left_anti").join(groups, "digest")
        cols = ["row", "ident", "sha", "best", "n"]
        joined = plain.select(cols).unionByName(regrouped.select(cols))
    decided = joined.select(
        F.col("row").alias(f"{prefix}row"), F.bitwise_not("best.neg_id").alias(f"{prefix}keep_id"), F.col("n").alias(f"{prefix}group_size"),
        (F.col("row") == F.bitwise_not("best.neg_row")).alias(f"{prefix}kept"), F.lower(F.hex("sha")).alias(f"{prefix}sha256"))
    decided = stage.write(decided, "decided")
    stage.drop("hits", "members", "checked", "groups")
    return content.join(decided, f"{prefix}row").drop(f"{prefix}row")


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256): one row per row of ``docs``."""
    out = deduplicate(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id", "text", **how)
    return out.select("doc_id", F.col("_xd_keep_id").alias("keep_id"), F.col("_xd_group_size").alias("group_size"),
                      F.col("_xd_kept").alias("kept"), F.col("_xd_sha256").alias("text_sha256"))


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """The rows that stay, with the columns of ``docs``, whatever their names."""
    prefix = free_name(docs.columns, "_xd_")
    return deduplicate(docs, prefix=prefix, **how).filter(F.col(f"{prefix}kept")).select(*docs.columns)
