"""Gold tables: the wide table and the analytics over it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..operators import aggregates, joins, ranking
from ..operators.quality import expect_all_or_drop
from . import specs


def gold_wide(silver: Mapping[str, DataFrame]) -> DataFrame:
    """Fact joined with every dimension, gated.

    The gate reads only fact columns and left joins never change them, so it
    is applied to the fact before the joins, as one predicate: it then stays
    above the silver dedup instead of being split and pushed below it.
    """
    data = expect_all_or_drop(silver["data"], specs.WIDE_RULES, split=False)
    return joins.build_wide_table(
        data=data, series=silver["series"], measure=silver["lookup_measure"],
        sector=silver["lookup_sector"], class_=silver["lookup_class"],
        duration=silver["lookup_duration"], seasonal=silver["lookup_seasonal"],
        period=silver["lookup_period"])


def gold_quarterly(wide: DataFrame) -> DataFrame:
    return aggregates.quarterly_aggregation(wide)


def gold_annual(wide: DataFrame) -> DataFrame:
    return aggregates.annual_aggregation(wide)


def gold_best_year(wide: DataFrame) -> DataFrame:
    return ranking.best_year_per_series(wide)


def gold_population_stats(population: DataFrame, year_from: int = 2013, year_to: int = 2018) -> DataFrame:
    return aggregates.population_stats_window(population, year_from, year_to)


def gold_q01_population(wide: DataFrame, population: DataFrame, nation_id: str | None = None) -> DataFrame:
    pop = population if nation_id is None else population.where(F.col("nation_id") == nation_id)
    return joins.q01_with_population(wide, pop)
