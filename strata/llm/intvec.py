"""Integer vectors for clustering and compression: kept rows, blocks, exact sums and distances."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reach(width: int) -> int:
    """Largest component for which every squared distance of ``width`` components fits a long."""
    return math.isqrt((1 << 60) // max(1, width))


def finite(vec: Column) -> Column:
    """True for a vector that is not null and holds no null or non-finite component."""
    bad = F.exists(vec, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vec.isNotNull() & F.coalesce(~bad, F.lit(False))


def integers(vec: Column, scale: int, width: int) -> Column:
    """floor(scale * x) of every component; a component too large for exact distances is an error."""
    ints = F.transform(vec, lambda c: F.floor(F.lit(float(scale)) * c))
    # only for finite components, as the optimiser may look at vectors that are left out
    wide = F.exists(vec, lambda c: (F.abs(c * F.lit(float(scale))) > reach(width)) & (F.abs(c) < float("inf")))
    return F.when(wide, F.raise_error(F.lit(f"a component beyond {reach(width)} / {scale}"))
                  .cast("array<bigint>")).otherwise(ints)


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Rows of a list column, each of ``width`` components, as one matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distance of every row to every point, as longs."""
    top = max(int(np.abs(rows).max(initial=0)), int(np.abs(points).max(initial=0)))
    if 4 * rows.shape[1] * top * top < 1 << 52:  # doubles hold every sum exactly
        a, b = rows.astype(np.float64), points.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    out = np.empty((len(rows), len(points)), np.int64)
    for n, point in enumerate(points):
        gap = rows - point
        out[:, n] = (gap * gap).sum(1)
    return out


def add_groups(totals: np.ndarray, groups: np.ndarray, rows: np.ndarray) -> None:
    """Adds each row, and a one behind it, to its group's line of ``totals``."""
    order = np.argsort(groups, kind="stable")
    ordered = groups[order]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.empty(0, np.int64)
    if len(starts):
        totals[ordered[starts], :-1] += np.add.reduceat(rows[order], starts, axis=0)
        totals[ordered[starts], -1] += np.diff(np.r_[starts, len(ordered)])


def slots(totals: np.ndarray) -> pa.RecordBatch:
    """One task's totals as ``(slot, total)``, slots counted through the whole array; zeros are left out."""
    flat = totals.reshape(-1)
    at = np.flatnonzero(flat)
    return pa.RecordBatch.from_pydict({"slot": pa.array(at, pa.int64()), "total": pa.array(flat[at], pa.int64())})


def moved(partials: DataFrame, points: np.ndarray) -> np.ndarray:
    """``points`` replaced by the floor of their rows' mean; a point without rows stays.

    ``partials(slot, total)`` holds each task's sums; they are added as
    decimals, so they are exact whatever the number of rows. What reaches the
    driver is one number for each component of a point.
    """
    sums = partials.groupBy("slot").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    width = points.shape[-1] + 1
    whole = {r.slot: int(r.total) for r in sums.collect()}
    flat = points.reshape(-1, points.shape[-1]).copy()
    for n in range(len(flat)):
        count = whole.get(n * width + width - 1, 0)
        if count:
            flat[n] = [whole.get(n * width + i, 0) // count for i in range(width - 1)]
    return flat.reshape(points.shape)
