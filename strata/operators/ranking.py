"""Top-1 per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .aggregates import of_kind, summarise


def best_year_per_series(wide: DataFrame, include_q05: bool = True) -> DataFrame:
    """Per series, the year whose quarterly values sum highest (earliest year on ties, missing sums last).

    Sums are by series and year; the long label rides along as a value, not as
    a key. The best year is the largest (sum, -year), an aggregate that
    combines in every map task, so no group is sorted.
    """
    yearly = summarise(of_kind(wide, "quarterly", include_q05), ("series_id", "year"),
                       {"annual_sum": F.sum("value"), "series_label": F.min("series_label")})
    best = F.max_by(F.struct("series_label", "year", "annual_sum"), F.struct("annual_sum", -F.col("year")))
    return yearly.groupBy("series_id").agg(best.alias("best")).select("series_id", "best.*")
