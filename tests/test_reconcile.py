from strata.operators import reconcile


def _ints(spark, n):
    return spark.range(n).selectExpr("cast(id as int) as k")


def test_retention_and_growth(spark):
    r = reconcile.check_retention(_ints(spark, 100), _ints(spark, 96)).first()
    assert (r.bronze_rows, r.silver_rows, r.retention, r.passed) == (100, 96, 0.96, True)
    assert reconcile.check_retention(_ints(spark, 100), _ints(spark, 90)).first().passed is False
    g = reconcile.check_no_growth(_ints(spark, 10), _ints(spark, 11)).first()
    assert (g.silver_rows, g.wide_rows, g.passed) == (10, 11, False)


def test_retention_plan_has_no_join(spark):
    plan = reconcile.check_retention(_ints(spark, 5), _ints(spark, 4))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_null_and_unique_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "s string, y int")
    n = reconcile.check_null_keys(df, ["s", "y"]).first()
    assert (n.rows, n.null_key_rows, n.passed) == (3, 1, False)
    u = reconcile.check_unique_key(df, ["s", "y"]).first()
    assert (u.rows, u.distinct_keys, u.passed) == (3, 2, False)


def test_dim_coverage_and_gap_year(spark):
    wide = spark.createDataFrame([("S1", 2013, "Q01", "x", "m", "d", "S", "L"),
                                  ("S1", 2014, "Q01", None, "m", "d", "S", "L"),
                                  ("S1", 2014, "Q02", None, None, None, None, "L")],
                                 "series_id string, year int, period string, sector_name string, measure_text string, "
                                 "duration_text string, seasonal string, series_label string")
    c = reconcile.check_dim_coverage(wide).first()
    assert (c.rows, c.year_from, c.year_to, c.missing_sector_name, c.missing_measure_text) == (2, 2013, 2014, 1, 0)
    q = spark.createDataFrame([(2019, 1), (2020, None), (2020, None)], "year int, us_population long")
    g = {r.year: r for r in reconcile.check_gap_year(q).collect()}
    assert g[2019].has_population and not g[2020].has_population and g[2020].rows == 2
