"""Parameters of the analyst questions are taken as they are, in both forms."""

import pytest

from strata.operators import joins
from strata.plans import ask, ask_sql

ODD = "50% o'clock_\\ {x}"


@pytest.mark.parametrize("form", [ask, ask_sql])
def test_parameters_are_literal(spark, form):
    annual = spark.createDataFrame([("Sector " + ODD, ODD, 2000, 1.005, 1), ("Sector", ODD, 2001, 2.0, 2), ("other", "50X o'clock", 2002, 3.0, 3)],
                                   "sector_name string, measure_text string, year int, avg_value double, series_count long")
    assert [r.year for r in form.ask_annual_trend(annual, sector=ODD.upper(), measure=ODD).collect()] == [2000]
    assert [r.sector_name for r in form.ask_latest_year_ranking(annual, ODD).collect()] == ["Sector"]
    assert form.ask_annual_trend(annual, sector="%", measure="_x").count() == 0
    quarterly = annual.selectExpr("*", "'Q01' AS period")
    got = form.ask_sector_comparison(quarterly, {"a `b` {c}": ODD, "s": "sector"}, ODD, 2000).collect()
    assert [(r.year, r["a `b` {c}"], r.s) for r in got] == [(2000, got[0].s, got[0].s), (2001, None, 2.0)]


def test_population_of_several_nations(spark):
    wide = spark.createDataFrame([("s", "l", 2000, "Q01", 1.0), ("s", "l", 2001, "Q01", 2.0), ("s", "l", 2000, "Q02", 9.0)],
                                 "series_id string, series_label string, year int, period string, value double")
    people = spark.createDataFrame([("A", 2000, 10), ("B", 2000, 20), ("B", None, 5)], "nation_id string, year int, population long")
    found = joins.q01_with_population(wide, people, nations=["A", "B", "A", "C"]).collect()
    assert sorted((r.nation_id, r.year, r.us_population) for r in found) == [
        ("A", 2000, 10), ("A", 2001, None), ("B", 2000, 20), ("B", 2001, None), ("C", 2000, None), ("C", 2001, None)]
    with pytest.raises(Exception, match="more than one population row"):
        joins.q01_with_population(wide, people).collect()
