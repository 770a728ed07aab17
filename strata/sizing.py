"""Size estimates and byte-size settings used for plan decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def parse_bytes(text: str | None, default: int) -> int:
    """Spark byte-size strings: ``134217728``, ``128m``, ``128MB``, ``-1``."""
    if text is None:
        return default
    t = str(text).strip().lower()
    num = t.rstrip("kmgtb")
    try:
        return int(float(num) * _UNITS[t[len(num):]])
    except (ValueError, KeyError):
        return default


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of ``df``; None when unavailable.

    For scans, filters, projections and aggregates this is an upper bound
    (file size scaled by the projected row width); an RDD-backed frame
    reports a huge default, which callers treat as "too big".
    """
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - e.g. a Connect session without JVM access
        return None
