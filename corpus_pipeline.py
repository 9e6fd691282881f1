"""Corpus pipeline: language ID, exact and near deduplication, decontamination, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir), works on all rows its
predecessor kept and returns a DataFrame with the columns of ``documents``, but for the last stage,
which returns the packed pieces. Every stage decides per row: identifiers may be null or repeat. ``run`` writes every stage as Parquet under the cluster's shared
folder and reads it again as the next one's input. Each stage calls its operator of ``seedrank.llm``;
an empty table or an extra column passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedrank.llm import decontam, exact_stream, langid, packing, simhash
from seedrank.llm.queries import tokenizer_path
from seedrank.llm.tables import Staged, free_name, read

#: no DuckDB form: the stages need trained networks, XXH64 and a BPE vocabulary
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts in no known language (null, or without a letter)."""
    return langid.keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact_stream.keep_one(docs)


def numbered(stage: Staged, docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` written with a row number, and that column's name (none of ``docs``): what a stage drops is dropped by
    it, since identifiers may be null or repeat (and many rows may hold one identifier)."""
    row = free_name(docs.columns, "_cp_row")
    return stage.write(docs.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group stays: the smallest doc_id (null last), then row number."""
    stage = Staged(spark, "near")
    rows, row = numbered(stage, docs)
    classes = stage.write(simhash.near_duplicates(rows, id_col=row).select(F.col("doc_id").alias(row), "component_id"), "classes")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", row)).alias("first")
    kept = classes.join(rows.select(row, "doc_id"), row).groupBy("component_id").agg(first).select(F.col(f"first.{row}").alias(row))
    gone = stage.write(classes.select(row).join(kept, row, "left_anti"), "gone")
    stage.drop("classes")
    return rows.join(gone, row, "left_anti").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops contaminated documents."""
    stage = Staged(spark, "contaminated")
    rows, row = numbered(stage, docs)
    found = decontam.contamination(rows, read(spark, sf_dir, "benchmark"), id_col=row).filter("contaminated")
    bad = stage.write(found.select(F.col("doc_id").alias(row)), "bad")
    return rows.join(bad, row, "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces of the documents that are left."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontaminate", decontaminate),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = Staged(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for i, (name, fn) in enumerate(STAGES):
        docs = stage.write(fn(spark, docs, sf_dir), name)
        if i > 0:
            stage.drop(STAGES[i - 1][0])
    return docs
