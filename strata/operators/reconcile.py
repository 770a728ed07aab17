"""Layer reconciliation checks (V1–V6).

Counts over two layers are taken in ONE aggregate over a tagged union (no
join), so each check is one scan per input plus a global partial aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def _two_counts(left: DataFrame, right: DataFrame, lname: str, rname: str) -> DataFrame:
    tagged = (left.select(F.lit(1).alias("_l"), F.lit(0).alias("_r"))
              .unionByName(right.select(F.lit(0).alias("_l"), F.lit(1).alias("_r"))))
    return tagged.agg(F.sum("_l").cast("bigint").alias(lname), F.sum("_r").cast("bigint").alias(rname))


def check_retention(bronze: DataFrame, silver: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Silver keeps at least ``threshold`` of the bronze rows."""
    c = _two_counts(bronze, silver, "bronze_rows", "silver_rows")
    ratio = F.when(F.col("bronze_rows") > 0, F.col("silver_rows") / F.col("bronze_rows"))
    return c.select("bronze_rows", "silver_rows", F.round(ratio, 6).alias("retention"),
                    (F.col("silver_rows") >= F.col("bronze_rows") * F.lit(threshold)).alias("passed"))


def check_no_growth(silver: DataFrame, wide: DataFrame) -> DataFrame:
    """The gold wide table never has more rows than silver."""
    c = _two_counts(silver, wide, "silver_rows", "wide_rows")
    return c.select("silver_rows", "wide_rows", (F.col("wide_rows") <= F.col("silver_rows")).alias("passed"))


def check_null_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Number of rows with a NULL in any of ``cols`` (expected 0)."""
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    return (df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(any_null).alias("null_key_rows"))
              .withColumn("passed", F.col("null_key_rows") == 0))


def check_unique_key(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``count(*) = count(distinct key)``."""
    return (df.agg(F.count(F.lit(1)).alias("rows"),
                   F.count_distinct(F.struct(*cols)).alias("distinct_keys"))
              .withColumn("passed", F.col("rows") == F.col("distinct_keys")))


def check_dim_coverage(wide: DataFrame, period: str = "Q01") -> DataFrame:
    """Per series: rows of one period and how many lack each dimension attribute."""
    def missing(c: str):
        return F.count_if(F.col(c).isNull()).alias(f"missing_{c}")
    return (wide.where(F.col("period") == period)
                .groupBy("series_id")
                .agg(F.count(F.lit(1)).alias("rows"), F.min("year").alias("year_from"),
                     F.max("year").alias("year_to"), missing("sector_name"), missing("measure_text"),
                     missing("duration_text"), missing("seasonal"), missing("series_label")))


def check_gap_year(q01_population: DataFrame) -> DataFrame:
    """Per year: rows, rows with population, and whether population is present."""
    return (q01_population.groupBy("year")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.count("us_population").alias("rows_with_population"))
            .withColumn("has_population", F.col("rows_with_population") > 0))
