"""Human-readable series label."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Label parts, defaults and seasonal wording.
LABEL_SEPARATOR_MEASURE = " — "
LABEL_SEPARATOR_DURATION = ", "
UNKNOWN_SECTOR = "Unknown sector"
UNKNOWN_MEASURE = "Unknown measure"
UNKNOWN_DURATION = "Unknown duration"
SEASONAL_WORDS = {"S": "Seasonally Adjusted", "U": "Not Seasonally Adjusted"}
UNKNOWN_SEASONAL = "Unknown"


def seasonal_word(seasonal: Column) -> Column:
    expr = None
    for code, word in SEASONAL_WORDS.items():
        expr = F.when(seasonal == code, word) if expr is None else expr.when(seasonal == code, word)
    return expr.otherwise(F.lit(UNKNOWN_SEASONAL))


def series_label(sector_name: Column, measure_text: Column,
                 duration_text: Column, seasonal: Column) -> Column:
    """``<sector> — <measure>, <duration> (<seasonal wording>)``; never NULL."""
    return F.concat(
        F.coalesce(sector_name, F.lit(UNKNOWN_SECTOR)),
        F.lit(LABEL_SEPARATOR_MEASURE),
        F.coalesce(measure_text, F.lit(UNKNOWN_MEASURE)),
        F.lit(LABEL_SEPARATOR_DURATION),
        F.coalesce(duration_text, F.lit(UNKNOWN_DURATION)),
        F.lit(" ("), seasonal_word(seasonal), F.lit(")"),
    )
