"""Analyst questions Q1–Q3 as Spark SQL over DataFrame arguments (the form
they are asked in), same contract as ``plans.ask``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def ask_annual_trend(annual: DataFrame, sector: str = "nonfarm business",
                     measure: str = "output per hour") -> DataFrame:
    return annual.sparkSession.sql("""
        SELECT year, ROUND(avg_value, 2) AS avg_value, series_count
        FROM {annual}
        WHERE CONTAINS(LOWER(sector_name), LOWER(:sector)) AND CONTAINS(LOWER(measure_text), LOWER(:measure))
        ORDER BY year ASC""", args={"sector": sector, "measure": measure}, annual=annual)


def ask_latest_year_ranking(annual: DataFrame, measure: str = "unit labor cost") -> DataFrame:
    return annual.sparkSession.sql("""
        SELECT sector_name, ROUND(avg_value, 2) AS avg_value, series_count
        FROM {annual}
        WHERE CONTAINS(LOWER(measure_text), LOWER(:measure))
          AND year = (SELECT MAX(year) FROM {annual} WHERE CONTAINS(LOWER(measure_text), LOWER(:measure)))
        ORDER BY avg_value DESC""", args={"measure": measure}, annual=annual)


def ask_sector_comparison(quarterly: DataFrame, sectors: Mapping[str, str] | None = None,
                          measure: str = "output per hour", since: int = 2015) -> DataFrame:
    """Result columns are named by ``sectors``' keys; its values, ``measure`` and ``since`` are parameters of the query."""
    sectors = sectors or {"nonfarm_business": "nonfarm business", "manufacturing": "manufacturing"}
    cols = ",\n".join(f"MAX(CASE WHEN CONTAINS(LOWER(sector_name), LOWER(:sector{i})) THEN ROUND(avg_value, 2) END) AS {_name(n)}"
                      for i, n in enumerate(sectors))
    return quarterly.sparkSession.sql(f"""
        SELECT year, period, {cols}
        FROM {{quarterly}}
        WHERE CONTAINS(LOWER(measure_text), LOWER(:measure)) AND period IN ('Q01', 'Q02', 'Q03', 'Q04')
          AND year >= :since
        GROUP BY year, period
        ORDER BY year, period""",
        args={f"sector{i}": p for i, p in enumerate(sectors.values())} | {"measure": measure, "since": int(since)}, quarterly=quarterly)


def _name(column: str) -> str:
    """A column name as an identifier; braces are doubled, as the text is a template."""
    return "`" + column.replace("`", "``").replace("{", "{{").replace("}", "}}") + "`"
