from datetime import date

import pytest
from pyspark.sql import Row

from strata.functions.strings import clean_strings, rename_columns, to_upper
from strata.functions.typing_rules import schema_data, schema_population, schema_series
from strata.operators.dedup import deduplicate
from strata.operators.quality import expect_all_or_drop, expectation_metrics, observe_expectations
from strata.plans import specs
from strata.plans.silver import build_silver


def test_clean_strings_trims_and_blanks(spark):
    df = spark.createDataFrame([("  x1 ", "", "   ", None, 7)], "a string, b string, c string, d string, n int")
    r = clean_strings(df).first()
    assert (r.a, r.b, r.c, r.d, r.n) == ("x1", None, None, None, 7)


def test_clean_strings_is_one_projection(spark):
    df = spark.createDataFrame([("a", "b")], "p string, q string")
    plan = clean_strings(df)._jdf.queryExecution().analyzed().toString()
    assert plan.count("Project") == 1


def test_to_upper_only_named(spark):
    df = spark.createDataFrame([Row(code="ab1", seasonal="s", label="keep me")])
    r = to_upper(df, "code", "seasonal").first()
    assert (r.code, r.seasonal, r.label) == ("AB1", "S", "keep me")
    assert to_upper(df).columns == df.columns


def test_rename_columns(spark):
    df = spark.createDataFrame([("S", "x")], "Seasonal_code string, Seasonal_text string")
    assert rename_columns(df, specs.SEASONAL.rename).columns == ["seasonal_code", "seasonal_text"]


def _fact(spark, rows):
    return spark.createDataFrame(rows, "series_id string, year int, period string, value double, footnote_codes string")


def test_dedup_exact_copies(spark):
    df = _fact(spark, [("S1", 1995, "Q01", 2.6, None), ("S1", 1995, "Q01", 2.6, None), ("S1", 1995, "Q02", 1.0, None)])
    assert deduplicate(df, ["series_id", "year", "period"]).count() == 2


def test_dedup_revised_wins(spark):
    df = _fact(spark, [("S1", 1995, "Q01", 1.0, None), ("S1", 1995, "Q01", 1.5, "R"), ("S1", 1995, "Q01", 9.0, "X")])
    rows = deduplicate(df, ["series_id", "year", "period"], "footnote_codes", "R").collect()
    assert len(rows) == 1 and rows[0].value == 1.5 and rows[0].footnote_codes == "R"


def test_dedup_is_deterministic_without_preference(spark):
    df = _fact(spark, [("S1", 1995, "Q01", 3.0, None), ("S1", 1995, "Q01", 1.0, None), ("S1", 1995, "Q01", None, None)])
    for _ in range(3):
        assert deduplicate(df.repartition(3), ["series_id", "year", "period"]).first().value == 1.0


def test_dedup_null_keys_form_one_group(spark):
    df = _fact(spark, [(None, 1995, "Q01", 1.0, None), (None, 1995, "Q01", 2.0, None)])
    assert deduplicate(df, ["series_id", "year", "period"]).count() == 1


@pytest.mark.parametrize("kw", [{"tiebreak_col": "f"}, {"prefer_value": "R"}])
def test_dedup_half_paired_arguments_raise(spark, kw):
    df = spark.createDataFrame([Row(id="a", f="X")])
    with pytest.raises(ValueError):
        deduplicate(df, ["id"], **kw)


def test_dedup_plans_partial_group_limit(spark):
    df = _fact(spark, [("S1", 1995, "Q01", 1.0, None)])
    plan = deduplicate(df, ["series_id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def _raw_fact(spark, rows):
    return spark.createDataFrame(rows, "series_id string, year string, period string, value string, footnote_codes string")


def test_schema_data_types_and_periods(spark):
    df = schema_data(_raw_fact(spark, [
        ("A", "2020", "Q01", "2.6", None), ("B", "2020", "Q02", "1", None), ("C", "2020", "Q03", "1", None),
        ("D", "2020", "Q04", "1", None), ("E", "2000", "A01", "not-a-number", None),
        ("F", "2020", "Q05", "1", None), ("G", "2020", "X99", "1", None), ("H", "n/a", "Q01", "1", None),
        ("I", "2020", "QQ", "1", None), ("J", "2020", None, "1", None)]))
    r = {x.series_id: x for x in df.collect()}
    assert r["A"].year == 2020 and abs(r["A"].value - 2.6) < 1e-9
    assert r["E"].value is None and r["E"].period_type == "annual" and r["E"].period_start_date == date(2000, 1, 1)
    assert [r[k].period_start_date for k in "ABCD"] == [date(2020, m, 1) for m in (1, 4, 7, 10)]
    assert r["F"].period_start_date is None and r["F"].period_type == "quarterly" and r["F"].period_num == 5
    assert r["G"].period_type == "other" and r["G"].period_num == 99
    assert r["H"].year is None and r["H"].period_start_date is None
    assert r["I"].period_num is None          # no digits: NULL instead of an ANSI cast error
    assert r["J"].period_type == "other"
    assert dict(df.dtypes)["period_start_date"] == "date"


def test_schema_series_and_population(spark):
    s = spark.createDataFrame([("P", "2012", "1988", "2024"), ("Q", "-", "1988", "x")],
                              "series_id string, base_year string, begin_year string, end_year string")
    r = {x.series_id: x for x in schema_series(s).collect()}
    assert (r["P"].base_year, r["P"].begin_year, r["P"].end_year) == (2012, 1988, 2024)
    assert r["Q"].base_year is None and r["Q"].end_year is None
    p = spark.createDataFrame([("2015", "321418821.0"), ("n/a", "N/A"), ("2016", "3.9")], "year string, population string")
    out = schema_population(p).collect()
    assert out[0].year == 2015 and out[0].population == 321418821 and isinstance(out[0].population, int)
    assert out[1].year is None and out[1].population is None
    assert out[2].population == 3                # double -> bigint truncates


def test_gate_treats_null_as_failure(spark):
    df = spark.createDataFrame([(None,), (1800,), (2000,)], "year int")
    assert [r.year for r in expect_all_or_drop(df, {"valid_year_range": "year > 1900"}).collect()] == [2000]


def test_expectation_metrics_and_observation(spark):
    df = spark.createDataFrame([(None, 1.0), (1800, None), (2000, 2.0)], "year int, value double")
    rules = {"valid_year_range": "year > 1900", "valid_value": "value IS NOT NULL"}
    m = expectation_metrics(df, rules).first()
    assert (m.rows_in, m.rows_out, m.failed_valid_year_range, m.failed_valid_value) == (3, 1, 2, 1)
    gated, obs = observe_expectations(df, rules)
    assert gated.count() == 1
    assert obs.get["failed_valid_year_range"] == 2


def test_silver_revised_row_with_null_value_loses_key(spark):
    raw = _raw_fact(spark, [("s1", "2001", "q01", "5.0", ""), ("s1", "2001", "q01", "-", "r")])
    assert build_silver(raw, specs.DATA).count() == 0                 # dedup first, then gate
    assert build_silver(raw, specs.DATA, gate_first=True).first().value == 5.0


def test_silver_seasonal_renames_before_cleaning(spark):
    raw = spark.createDataFrame([(" s ", "Seasonal"), ("S", "Seasonal"), ("  ", "blank")],
                                "Seasonal_code string, Seasonal_text string")
    out = build_silver(raw, specs.SEASONAL).collect()
    assert [(r.seasonal_code, r.seasonal_text) for r in out] == [("S", "Seasonal")]
