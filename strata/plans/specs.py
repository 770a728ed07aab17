"""One declarative spec per medallion table.

The ten silver tables differ only in these parameters, so one builder
(``plans.silver.build_silver``) produces all of them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from ..functions.typing_rules import period_columns, population_columns, series_columns, value_columns


@dataclass(frozen=True)
class TableSpec:
    name: str                                   # silver name
    bronze: str                                 # bronze name
    raw_columns: tuple[str, ...]                # positional all-string schema
    folder: str                                 # landing folder
    file_name: str | None = None                # file name inside a shared folder
    rename: dict[str, str] = field(default_factory=dict)
    upper: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    typer: Callable[[dict], dict] | None = None   # column-level typing rule
    derived: Callable[[dict], dict] | None = None  # columns that the typed key decides
    prefer: tuple[str, str] | None = None       # (column, value) that wins dedup
    order: tuple[tuple[str, str], ...] = ()     # extra dedup order: (column, "asc"|"desc")
    rules: dict[str, str] = field(default_factory=dict)
    cluster_by: tuple[str, ...] = ()
    comment: str = ""


_LOOKUP_TAIL = ("display_level", "selectable", "sort_sequence")

# Quality rules per table (rule name -> SQL predicate).
DATA_RULES = {
    "valid_series_id": "series_id IS NOT NULL",
    "valid_year_range": "year > 1900",
    "valid_value": "value IS NOT NULL",
    "valid_period_format": "period RLIKE '^(Q0[1-5]|A01)$'",
}
SERIES_RULES = {
    "valid_series_id": "series_id IS NOT NULL",
    "valid_begin_year": "begin_year > 1900",
    "valid_end_year": "end_year > 1900",
}
POPULATION_RULES = {
    "valid_year_range": "year > 1900",
    "valid_population": "population IS NOT NULL AND population > 0",
}
WIDE_RULES = {
    "valid_series_id": "series_id IS NOT NULL",
    "valid_year": "year > 1900",
    "valid_value": "value IS NOT NULL",
    "valid_period": "period IS NOT NULL",
}


def _lookup(name: str, code: str, text: str, file_name: str, upper_extra=("selectable",),
            tail=_LOOKUP_TAIL) -> TableSpec:
    return TableSpec(
        name=f"lookup_{name}", bronze=f"raw_{name}", raw_columns=(code, text, *tail),
        folder="enrichment", file_name=file_name, upper=(code, *upper_extra), key=(code,),
        rules={f"valid_{code}": f"{code} IS NOT NULL"},
        comment=f"{name} lookup: trimmed, code upper-cased, one row per {code}.")


DATA = TableSpec(
    name="data", bronze="raw_data",
    raw_columns=("series_id", "year", "period", "value", "footnote_codes"),
    folder="backfill", upper=("series_id", "period", "footnote_codes"),
    key=("series_id", "year", "period"), typer=value_columns, derived=period_columns,
    prefer=("footnote_codes", "R"),
    order=(("value", "desc"), ("footnote_codes", "asc")), rules=DATA_RULES,
    cluster_by=("series_id", "year", "period_type"),
    comment="Typed, cleaned fact; one row per (series_id, year, period); revised values win.")

SERIES = TableSpec(
    name="series", bronze="raw_series",
    raw_columns=("series_id", "sector_code", "class_code", "measure_code", "duration_code", "seasonal",
                 "base_year", "footnote_codes", "begin_year", "begin_period", "end_year", "end_period"),
    folder="series",
    upper=("sector_code", "class_code", "measure_code", "duration_code", "seasonal",
           "begin_period", "end_period", "footnote_codes"),
    key=("series_id",), typer=series_columns, rules=SERIES_RULES, cluster_by=("series_id",),
    comment="Series dimension: attribute codes per series_id.")

MEASURE = _lookup("measure", "measure_code", "measure_text", "pr.measure")
SECTOR = _lookup("sector", "sector_code", "sector_name", "pr.sector")
CLASS = _lookup("class", "class_code", "class_text", "pr.class")
DURATION = _lookup("duration", "duration_code", "duration_text", "pr.duration")
FOOTNOTE = _lookup("footnote", "footnote_code", "footnote_text", "pr.footnote", upper_extra=(), tail=())
PERIOD = TableSpec(
    name="lookup_period", bronze="raw_period", raw_columns=("period", "period_abbr", "period_name"),
    folder="enrichment", file_name="pr.period", upper=("period",), key=("period",),
    rules={"valid_period": "period IS NOT NULL"}, comment="Period codes and names.")
SEASONAL = TableSpec(
    name="lookup_seasonal", bronze="raw_seasonal", raw_columns=("Seasonal_code", "Seasonal_text"),
    folder="enrichment", file_name="pr.seasonal",
    rename={"Seasonal_code": "seasonal_code", "Seasonal_text": "seasonal_text"},
    upper=("seasonal_code",), key=("seasonal_code",),
    rules={"valid_seasonal_code": "seasonal_code IS NOT NULL"}, comment="Seasonal adjustment codes.")
POPULATION = TableSpec(
    name="lookup_population", bronze="raw_population",
    raw_columns=("nation_id", "nation", "year", "population"),
    folder="enrichment", file_name="us_population", upper=("nation_id",),
    key=("nation_id", "year"), typer=population_columns, rules=POPULATION_RULES,
    comment="Yearly population per nation; one row per (nation_id, year).")

#: What each column means, in every silver and gold table that has it.
COLUMN_COMMENTS = {
    "series_id": "Code of the time series the row belongs to.",
    "year": "Calendar year.",
    "period": "Part of the year: Q01 to Q04 quarters, Q05 and A01 yearly averages.",
    "value": "Observed or computed figure.",
    "footnote_codes": "Footnote marks; R is a revised figure.",
    "period_start_date": "First day of the period.",
    "period_type": "Whether the period is a quarter or a year.",
    "period_num": "Number within the period code.",
    "period_abbr": "Short form of the period's name.",
    "period_name": "The period's name.",
    "sector_code": "Code of the economic sector.",
    "sector_name": "Name of the economic sector.",
    "class_code": "Code of the worker class.",
    "class_text": "Name of the worker class.",
    "measure_code": "Code of what is measured.",
    "measure_text": "Name of what is measured.",
    "duration_code": "Code of how figures compare over time.",
    "duration_text": "How figures compare over time.",
    "seasonal": "Code of the seasonal adjustment.",
    "seasonal_code": "Code of the seasonal adjustment.",
    "seasonal_text": "Name of the seasonal adjustment.",
    "footnote_code": "One footnote mark.",
    "footnote_text": "Wording of the footnote.",
    "base_year": "Year an index is set to 100; NULL where the series is no index.",
    "begin_year": "First year of the series.",
    "begin_period": "First period of the series.",
    "end_year": "Last year of the series.",
    "end_period": "Last period of the series.",
    "display_level": "Depth at which the entry is shown.",
    "selectable": "T where the entry can be chosen.",
    "sort_sequence": "Place of the entry in lists.",
    "nation_id": "Code of the nation.",
    "nation": "Name of the nation.",
    "population": "Inhabitants in that year.",
    "us_population": "Inhabitants in the row's year; NULL where unknown.",
    "series_label": "Sector, measure, duration and adjustment in words.",
    "avg_value": "Mean of the group's values.",
    "min_value": "Smallest of the group's values.",
    "max_value": "Largest of the group's values.",
    "series_count": "Rows of the group.",
    "annual_sum": "Sum of the year's quarterly values.",
    "mean_population": "Mean population over the years.",
    "stddev_population": "Population standard deviation over the years.",
    "year_from": "First year counted.",
    "year_to": "Last year counted.",
    "year_count": "Years counted.",
}
GOLD_COMMENTS = {
    "wide": "Every fact with its series, lookups and label.",
    "quarterly": "Quarterly values by sector, measure, year and quarter.",
    "annual": "Yearly values by sector, measure and year.",
    "best_year": "Year with the largest sum of quarterly values, per series.",
    "population_stats": "Mean and spread of the population over a range of years.",
    "q01_population": "First-quarter values beside the population of the same year.",
}

ALL = (DATA, SERIES, MEASURE, SECTOR, CLASS, DURATION, FOOTNOTE, PERIOD, SEASONAL, POPULATION)
BY_NAME = {s.name: s for s in ALL}
LOOKUPS = (MEASURE, SECTOR, CLASS, DURATION, FOOTNOTE, PERIOD, SEASONAL)
