"""Access to the analytic source tables (one parquet dataset per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import session_key

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


_SCANS: dict[tuple[str, str], DataFrame] = {}


def clear_scan_cache() -> None:
    """Forget cached scans (their file listings), e.g. after new files land."""
    _SCANS.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it.

    The scan DataFrame is built once per session and path (file listing and
    footer schema are resolved once), then reused by every plan that reads it.
    """
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (session_key(spark), path)
    df = _SCANS.get(key)
    if df is None:
        df = _SCANS[key] = spark.read.parquet(path)
    return df
