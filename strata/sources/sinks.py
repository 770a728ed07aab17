"""Table sinks with comments, properties and clustered layout."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def annotate_columns(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """Attach column comments as field metadata (kept through parquet and DESCRIBE)."""
    present = {c: t for c, t in comments.items() if c in df.columns}
    for c, text in present.items():
        df = df.withMetadata(c, {**df.schema[c].metadata, "comment": text})
    return df


def clustered(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partition and sort on ``keys`` so each output file covers a narrow
    key range and parquet min/max statistics prune scans on those keys."""
    if not keys:
        return df
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys)


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_table(df: DataFrame, name: str, path: str, comment: str | None = None,
                properties: Mapping[str, str] | None = None,
                cluster_by: Sequence[str] = (), laid_out: bool = False) -> DataFrame:
    """Persist ``df`` as a parquet table at ``path`` (a shared location),
    register it as ``name``, set its comment and properties, return a read of it.
    ``laid_out`` says that ``df`` is clustered already."""
    spark: SparkSession = df.sparkSession
    out = df if laid_out else clustered(df, cluster_by)
    out.write.mode("overwrite").format("parquet").option("path", path).saveAsTable(name)
    props = dict(properties or {})
    if cluster_by:
        props.setdefault("clustering.columns", ",".join(cluster_by))
    if props:
        body = ", ".join(f"{_sql_str(k)} = {_sql_str(v)}" for k, v in props.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({body})")
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {_sql_str(comment)}")
    return spark.table(name)


def write_clustered(df: DataFrame, path: str, cluster_by: Sequence[str]) -> DataFrame:
    """Write parquet files laid out by ``cluster_by``; return a read of them."""
    clustered(df, cluster_by).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_partitioned(df: DataFrame, path: str, key: str) -> DataFrame:
    """Write one folder per value of ``key``; return a read that prunes them, at run time too.

    Rows of a value go together, so a folder has few files; adaptive
    execution cuts a value with many rows into several tasks and files.
    """
    df.hint("rebalance", F.col(key)).write.mode("overwrite").partitionBy(key).parquet(path)
    columns = [f for f in df.schema.fields if f.name != key]
    return df.sparkSession.read.schema(StructType([*columns, df.schema[key]])).parquet(path).select(*df.columns)
