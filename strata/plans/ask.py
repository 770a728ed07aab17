"""Analyst questions over the gold tables (Q1–Q6).

Text filters are case-insensitive substring matches, every character taken as
it is; the defaults are the questions' original wording and every one is a parameter.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..operators import aggregates


def _like(col: str, needle: str):
    return F.contains(F.lower(F.col(col)), F.lower(F.lit(needle)))


def ask_annual_trend(annual: DataFrame, sector: str = "nonfarm business",
                     measure: str = "output per hour") -> DataFrame:
    """Q1: yearly average of a measure for one sector."""
    return (annual.where(_like("sector_name", sector) & _like("measure_text", measure))
                  .select("year", F.round("avg_value", 2).alias("avg_value"), "series_count")
                  .orderBy("year"))


def ask_latest_year_ranking(annual: DataFrame, measure: str = "unit labor cost") -> DataFrame:
    """Q2: sectors ranked by a measure in the latest year that has it.

    The latest year is a one-row global aggregate (scalar subquery), joined
    back as a broadcast of exactly one row.
    """
    m = annual.where(_like("measure_text", measure))
    latest = m.agg(F.max("year").alias("_latest"))
    return (m.join(F.broadcast(latest), F.col("year") == F.col("_latest"))
             .select("sector_name", F.round("avg_value", 2).alias("avg_value"), "series_count",
                     F.col("avg_value").alias("_order"))
             .orderBy(F.desc("_order")).drop("_order"))


def ask_latest_year_of_wide(wide: DataFrame, measure: str = "unit labor cost") -> DataFrame:
    """Q2 from the wide table, aggregating the latest year only.

    On a table partitioned by year the one-row subquery prunes at run time: the
    values read are those of one year; all years are read for measure and kind only.
    """
    m = wide.where(_like("measure_text", measure) & (F.col("period_type") == "annual"))
    latest = m.agg(F.max("year").alias("_latest"))
    newest = m.join(F.broadcast(latest), F.col("year") == F.col("_latest"), "left_semi")
    return (aggregates.annual_aggregation(newest)
            .select("sector_name", F.round("avg_value", 2).alias("avg_value"), "series_count",
                    F.col("avg_value").alias("_order"))
            .orderBy(F.desc("_order")).drop("_order"))


def ask_sector_comparison(quarterly: DataFrame, sectors: Mapping[str, str] | None = None,
                          measure: str = "output per hour", since: int = 2015) -> DataFrame:
    """Q3: sectors side by side per quarter (conditional aggregate, not pivot:
    the sector patterns may overlap)."""
    sectors = sectors or {"nonfarm_business": "nonfarm business", "manufacturing": "manufacturing"}
    q = quarterly.where(_like("measure_text", measure)
                        & F.col("period").isin("Q01", "Q02", "Q03", "Q04")
                        & (F.col("year") >= since))
    cols = [F.max(F.when(_like("sector_name", pat), F.round("avg_value", 2))).alias(name)
            for name, pat in sectors.items()]
    return q.groupBy("year", "period").agg(*cols).orderBy("year", "period")


def ask_population_stats(stats: DataFrame) -> DataFrame:
    """Q4: mean and standard deviation of population in the window."""
    return stats.select("mean_population", "stddev_population", "year_from", "year_to", "year_count")


def ask_population_by_year(population: DataFrame) -> DataFrame:
    """Q5: population by year."""
    return population.select("year", "population").orderBy("year")


def ask_q01_population_corr(q01_population: DataFrame, wide: DataFrame | None = None,
                            measure: str | None = None) -> DataFrame:
    """Q6: correlation of first-quarter values with population, per series label
    and overall (pairs with a NULL side are ignored)."""
    df = q01_population
    if measure is not None and wide is not None:
        ids = (wide.where(_like("measure_text", measure)).select("series_id").distinct())
        df = df.join(ids, "series_id", "left_semi")
    pairs = df.where(F.col("us_population").isNotNull())
    return (pairs.groupBy("series_label")
                 .agg(F.corr("value", F.col("us_population").cast("double")).alias("corr_value_population"),
                      F.count(F.lit(1)).alias("pairs")))
