"""Manifest upsert by point in time, content comparison with missing texts, label of orphan facts."""

from strata.operators import joins
from strata.sources import manifest


def test_upsert_keeps_the_latest_point_in_time(spark):
    stored = spark.createDataFrame([("a", "1/2/2025 8:30 AM"), ("c", "1/1/2025 1:00 PM")], "url string, last_modified string")
    records = spark.createDataFrame(
        [("a", "9/6/2025 9:00 AM"), ("a", "10/6/2025 9:00 AM"), ("b", "2/1/2025 11:00 AM"), ("b", "2/1/2025 1:00 PM"), ("d", None)],
        "url string, last_modified string")
    assert {tuple(r) for r in manifest.manifest_upsert(stored, records).collect()} == {
        ("a", "10/6/2025 9:00 AM"), ("b", "2/1/2025 1:00 PM"), ("c", "1/1/2025 1:00 PM"), ("d", None)}


def test_content_that_appears_or_disappears_is_a_change(spark):
    texts = spark.createDataFrame([(1, "x"), (2, None), (3, None), (4, None), (5, "new")], "doc_id long, text string")
    digest = "2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881"  # of x
    stored = spark.createDataFrame([(1, digest), (2, digest), (3, None)], "doc_id long, digest string")
    assert {r.doc_id for r in manifest.content_changed(texts, stored).collect()} == {2, 4, 5}


def test_only_two_joins_read_the_fact_and_no_lookup_shuffles_it(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        one = lambda **c: spark.createDataFrame([tuple(c.values())], list(c))
        data = spark.createDataFrame([("S1", 2020, "Q01", 1.0), ("S9", 2020, "Q01", 2.0)], "series_id string, year int, period string, value double")
        wide = joins.build_wide_table(
            data, one(series_id="S1", sector_code="1", class_code="2", measure_code="3", duration_code="4", seasonal="S"),
            one(measure_code="3", measure_text="M"), one(sector_code="1", sector_name="A"), one(class_code="2", class_text="C"),
            one(duration_code="4", duration_text="D"), one(seasonal_code="S", seasonal_text="T"),
            one(period="Q01", period_abbr="Q1", period_name="first"))
        rows = {r.series_id: r for r in wide.collect()}
        assert rows["S1"].series_label == "A — M, D (Seasonally Adjusted)" and rows["S1"].period_abbr == "Q1"
        assert rows["S9"].series_label.startswith("Unknown") and rows["S9"].sector_name is None
        text = wide._jdf.queryExecution().optimizedPlan().toString()
        fact = next(i for i, x in enumerate(text.split("\n")) if "value" in x and "LogicalRDD" in x)
        depth = text.split("\n")[fact].index("LogicalRDD")
        above = [x for x in text.split("\n")[:fact] if "Join" in x and x.index("Join") < depth]
        assert len(above) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
