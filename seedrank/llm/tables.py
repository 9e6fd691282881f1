"""Reading, keying and staging of text tables shared by the operators of this package."""

from __future__ import annotations

import math
import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedrank.functions.params import new_folder


_SHIPPED: set[str] = set()
#: bytes of an Arrow batch sent to a Python worker
BATCH_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Give the package to the executors' Python workers (once per application), and bound the
    Arrow batches that they get by bytes: texts may be long."""
    if "spark.sql.execution.arrow.maxBytesPerBatch" not in dict(spark.sparkContext.getConf().getAll()):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    to = os.path.join(tempfile.mkdtemp(prefix="seedrank-"), "seedrank.zip")
    with zipfile.ZipFile(to, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(top)))
    spark.sparkContext.addPyFile(to)
    _SHIPPED.add(app)


def read(spark: SparkSession, d: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{d.rstrip('/')}/{table}.parquet")


class Staged:
    """Tables written to the cluster's shared folder by one call; ``drop`` removes those that
    the returned frame no longer reads, and ``params.drop_written`` all of them."""

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.base = new_folder(spark, name)

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def write(self, df: DataFrame, name: str, row_group: int = 0) -> DataFrame:
        """``df`` written and read back; ``row_group``: bytes a writer holds in memory (0: the format's default)."""
        schema = df.schema
        out = df.write.mode("overwrite")
        (out.option("parquet.block.size", str(row_group)) if row_group else out).parquet(self.path(name))
        return self.spark.read.schema(schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            p = jvm.org.apache.hadoop.fs.Path(self.path(name))
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def free_name(taken: list[str], name: str) -> str:
    """``name``, lengthened until no column of ``taken`` begins with it (in any case): a column, or a prefix of columns, of
    our own beside whatever columns a table has."""
    while any(c.lower().startswith(name.lower()) for c in taken):
        name += "_"
    return name


def input_bytes(df: DataFrame) -> int:
    """Size of a frame as Spark's statistics give it (file sizes for a table scan), or the bytes of
    its texts where Spark has no statistics."""
    n = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return n if n < 1 << 50 else int(df.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def n_buckets(docs: DataFrame, bytes_each: int = 8 << 20) -> int:
    """Number of hash buckets: follows the input, at least the shuffle partitions."""
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(1 << 24, max(least, math.ceil(input_bytes(docs) / bytes_each)))


def keyed(docs: DataFrame, *more: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k, rid, text, *more): ``k`` is the document id (a reserved value for null) and ``rid`` a
    hash of the row's id and text, so that rows which share an id but not a text stay apart and
    equal rows share their result."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("k"),
        F.xxhash64(F.col(id_col).isNull(), F.col(id_col).cast("long"), F.col(text_col)).alias("rid"),
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *more)
