"""Sources and sinks (S1–S10): CSV catalogues and seed sets, JSON lookups, parquet outputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CSV_OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"', "mode": "PERMISSIVE"}


def read_items(spark: SparkSession, path: str | Sequence[str], schema: str | None = None, sep: str = ",") -> DataFrame:
    """Catalogue CSV with a header, quoted commas, doubled quotes and newlines inside
    quoted cells (multiLine). Only a blank cell is NULL: 'NA' stays text."""
    r = spark.read.options(**CSV_OPTIONS).option("sep", sep)
    r = r.schema(schema) if schema else r.option("inferSchema", "false")
    return r.csv(path if isinstance(path, str) else list(path))


def read_seeds(spark: SparkSession, path: str | Sequence[str], schema: str | None = None,
               set_col: str = "set_id") -> DataFrame:
    """One or many seed-set CSVs (a UTF-8 BOM is dropped by the reader); the set id is the source
    file name without extension, or the folder's value where the sets were written partitioned by it."""
    df = read_items(spark, path, schema)
    if set_col in df.columns:
        return df
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    return df.withColumn(set_col, name)


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """The data files of a folder (Hadoop file status; names that begin with '_' or '.' are not data)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in fs.listStatus(path) if s.isFile() and s.getPath().getName()[0] not in "_.")


def _header(spark: SparkSession, path: str) -> str:
    """First line of a file, read on the driver without a job."""
    jvm, p = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(path)
    lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p), "UTF-8"))
    try:
        return (lines.readLine() or "").lstrip("\ufeff")
    finally:
        lines.close()


def merge_sources(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """S3: union CSV files by column name; files of the same header are read in one scan. A header
    with tabs and no comma is tab-separated. Empty files are skipped."""
    groups: dict[str, list[str]] = {}
    for f in files:
        h = _header(spark, f)
        if not h:
            continue
        groups.setdefault(h, []).append(f)
    out = None
    for header, fs in groups.items():
        df = read_items(spark, fs, sep="\t" if "\t" in header and "," not in header else ",").withColumn("source_file", F.col("_metadata.file_name"))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def merge_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """S3 for already-read sources: union by column name, missing columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def source_counts(df: DataFrame, file_col: str = "source_file") -> DataFrame:
    """Rows per input file."""
    return df.groupBy(file_col).agg(F.count(F.lit(1)).alias("rows"))


def read_vector_lookup(spark: SparkSession, path: str, form: str = "object") -> DataFrame:
    """(tag, vec); keys lower-cased and trimmed. ``form``: 'object', each file one JSON object
    {key: [floats]} (read whole by one task, so for small files); 'object_lines', such an object on
    each line; 'lines', the JSON lines that ``write_vector_lookup`` writes. The last two are split."""
    if form == "lines":
        pairs = spark.read.schema("tag string, vec array<double>").json(path).select(F.col("tag").alias("k"), "vec")
    else:
        txt = spark.read.text(path, wholetext=form == "object")
        pairs = txt.select(F.explode(F.from_json("value", "map<string,array<double>>")).alias("k", "vec"))
    return pairs.select(F.lower(F.trim("k")).alias("tag"), "vec")


def read_seed_genres(spark: SparkSession, path: str, field: str = "genres", lines: bool = False) -> DataFrame:
    """JSON {"genres": [...]}, one object a file or (``lines``) a line → one row per value."""
    return spark.read.option("multiLine", str(not lines).lower()).json(path).select(F.explode(field).alias("tag"))


def cache_items(df: DataFrame) -> DataFrame:
    """Keep the cleaned catalogue between requests (spills to disk, rebuilt on loss)."""
    from pyspark import StorageLevel
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "overwrite", sep: str = ",") -> None:
    """Write recommendations, clustered seeds or cleaned items. CSV cells keep their white
    space and quotes (doubled), so that ``read_items`` reads them back unchanged."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.options(header="true", sep=sep, escape='"', quote='"', ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)
    else:
        w.format(fmt).save(path)


def write_vector_lookup(df: DataFrame, path: str, key: str = "tag", vec: str = "vec") -> None:
    """(tag, vec) rows as JSON lines."""
    df.select(F.col(key).alias("tag"), F.col(vec).alias("vec")).write.mode("overwrite").json(path)
