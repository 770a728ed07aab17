"""Tolerant schema-on-read typing for the silver layer.

Raw text is never hard-cast: under ANSI mode a bad cast raises, so every
conversion is a ``try_cast`` and unparsable input becomes NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def try_int(c: Column) -> Column:
    return c.try_cast("int")


def try_double(c: Column) -> Column:
    return c.try_cast("double")


# Quarter code -> month its period starts in.
PERIOD_START_MONTH = {"Q01": 1, "Q02": 4, "Q03": 7, "Q04": 10, "A01": 1}


def period_start_date(period: Column, year: Column) -> Column:
    """First day of the period; NULL for Q05 (annual average) and unknown codes.

    ``make_date`` raises on an impossible year under ANSI mode, so the year is
    range-guarded first.
    """
    valid_year = year.between(1, 9999)
    expr = None
    for code, month in PERIOD_START_MONTH.items():
        cond = (period == code) & valid_year
        d = F.make_date(year, F.lit(month), F.lit(1))
        expr = F.when(cond, d) if expr is None else expr.when(cond, d)
    return expr.otherwise(F.lit(None).cast("date"))


def period_type(period: Column) -> Column:
    return (F.when(period.startswith("Q"), F.lit("quarterly"))
             .when(period.startswith("A"), F.lit("annual"))
             .otherwise(F.lit("other")))


def period_num(period: Column) -> Column:
    """First run of digits as int; codes without digits give NULL, not an error."""
    return F.nullif(F.regexp_extract(period, r"\d+", 0), F.lit("")).try_cast("int")


def value_columns(cols: dict[str, Column]) -> dict[str, Column]:
    """Year and value of the fact, typed from raw (cleaned) expressions."""
    return {**cols, "year": try_int(cols["year"]), "value": try_double(cols["value"])}


def period_columns(cols: dict[str, Column]) -> dict[str, Column]:
    """The three columns that the typed year and the period decide."""
    return {**cols, "period_start_date": period_start_date(cols["period"], cols["year"]),
            "period_type": period_type(cols["period"]), "period_num": period_num(cols["period"])}


def data_columns(cols: dict[str, Column]) -> dict[str, Column]:
    """All typed fact columns as one projection."""
    return period_columns(value_columns(cols))


def series_columns(cols: dict[str, Column]) -> dict[str, Column]:
    return {**cols, **{c: try_int(cols[c]) for c in ("base_year", "begin_year", "end_year")}}


def population_columns(cols: dict[str, Column]) -> dict[str, Column]:
    return {**cols, "year": try_int(cols["year"]),
            "population": try_double(cols["population"]).try_cast("bigint")}


def _apply(df: DataFrame, fn) -> DataFrame:
    cols = fn({c: F.col(f"`{c}`") for c in df.columns})
    return df.select(*[e.alias(n) for n, e in cols.items()])


def schema_data(df: DataFrame) -> DataFrame:
    """Type the fact: year -> int, value -> double, plus three period columns."""
    return _apply(df, data_columns)


def schema_series(df: DataFrame) -> DataFrame:
    """Type the series dimension: the three year columns -> int (bad -> NULL)."""
    return _apply(df, series_columns)


def schema_population(df: DataFrame) -> DataFrame:
    """year -> int; population text (often a float string) -> double -> bigint."""
    return _apply(df, population_columns)
