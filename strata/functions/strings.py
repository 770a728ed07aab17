"""String normalisation applied between bronze and silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType


def blank_to_null(c: Column) -> Column:
    """``NULLIF(TRIM(c), '')`` — spaces trimmed, an empty result becomes NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def clean_strings(df: DataFrame) -> DataFrame:
    """Trim every string column and turn empty strings into NULL.

    One projection for all columns (not a withColumn loop), so the analyzer
    sees a single Project node no matter how wide the table is.
    """
    targets = {f.name: blank_to_null(F.col(f"`{f.name}`"))
               for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.withColumns(targets) if targets else df


def to_upper(df: DataFrame, *cols: str) -> DataFrame:
    """Upper-case the named code columns, keeping column order."""
    if not cols:
        return df
    return df.withColumns({c: F.upper(F.col(f"`{c}`")) for c in cols})


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename columns (e.g. mixed-case raw headers to snake_case)."""
    return df.withColumnsRenamed(mapping) if mapping else df
