"""Delimited text I/O shared by batch and streaming readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

# Reader options of the bronze layer: tab separated, one header line skipped,
# columns mapped by position to the declared all-string schema, cells trimmed.
READ_OPTIONS = {
    "sep": "\t",
    "header": "true",
    "enforceSchema": "true",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    "inferSchema": "false",
    "mode": "PERMISSIVE",
}

# Writer options that keep padding intact (the writer trims by default).
WRITE_OPTIONS = {
    "sep": "\t",
    "header": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def string_schema(columns) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_tsv(spark: SparkSession, path: str, columns, glob: str | None = None) -> DataFrame:
    """Batch read with the bronze options."""
    r = spark.read.format("csv").options(**READ_OPTIONS).schema(string_schema(columns))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def write_tsv(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write a directory of tab-separated part files (parallel, one per task)."""
    df.write.mode(mode).options(**WRITE_OPTIONS).csv(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_named_tsv(df: DataFrame, folder: str, name: str, staging: str) -> str:
    """Write a small table as ONE file called ``name`` inside ``folder``.

    Used for lookup files that share a folder and are told apart by name
    (``pathGlobFilter``). Only bounded lookups go through here; the single
    output file is produced by one task and moved with a metadata rename.
    """
    spark = df.sparkSession
    df.coalesce(1).write.mode("overwrite").options(**WRITE_OPTIONS).csv(staging)
    jvm = spark.sparkContext._jvm
    sp, fs = _fs(spark, staging)
    part = [s.getPath() for s in fs.listStatus(sp) if s.getPath().getName().startswith("part-")][0]
    dest_dir = jvm.org.apache.hadoop.fs.Path(folder)
    fs.mkdirs(dest_dir)
    dest = jvm.org.apache.hadoop.fs.Path(folder.rstrip("/") + "/" + name)
    if not fs.rename(part, dest):
        raise OSError(f"could not move {part} to {dest}")
    return dest.toString()
