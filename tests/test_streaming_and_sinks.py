from pyspark.sql import functions as F

from strata.plans import specs
from strata.session import local_dir, scratch_path
from strata.sources import sinks, tsv
from strata.streaming import ingest


def _raw(spark, n0, n1):
    return spark.range(n0, n1).select(F.concat(F.lit("  prs"), F.col("id").cast("string"), F.lit(" ")).alias("series_id"),
                                      F.lit("2001").alias("year"), F.lit("q01").alias("period"),
                                      F.lit("1.5").alias("value"), F.lit("  ").alias("footnote_codes"))


def test_available_now_processes_each_file_once(spark):
    root = scratch_path(spark, "test-stream")
    landing, bronze = f"{root}/landing", f"{root}/bronze"
    ingest.land(spark, _raw(spark, 0, 50), specs.DATA, landing)
    assert ingest.ingest(spark, specs.DATA, landing, bronze).count() == 50
    assert ingest.ingest(spark, specs.DATA, landing, bronze).count() == 50        # idle run adds nothing
    ingest.land(spark, _raw(spark, 50, 60), specs.DATA, landing)
    out = ingest.ingest(spark, specs.DATA, landing, bronze)
    assert out.count() == 60 and out.select("series_id").distinct().count() == 60
    r = out.where("series_id = 'prs7'").first()                                     # trimmed at read
    assert r.footnote_codes is None and r.period == "q01"


def test_positional_schema_and_glob(spark):
    root = scratch_path(spark, "test-read")
    df = spark.createDataFrame([("01000us", "US", "2015", "1.0", "extra")], "a string, b string, c string, d string, e string")
    tsv.write_named_tsv(df, f"{root}/enrichment", "us_population", f"{root}/stage1")
    other = spark.createDataFrame([("01", "x")], "m string, t string")
    tsv.write_named_tsv(other, f"{root}/enrichment", "pr.measure", f"{root}/stage2")
    pop = tsv.read_tsv(spark, f"{root}/enrichment", specs.POPULATION.raw_columns, glob="us_population")
    assert pop.columns == list(specs.POPULATION.raw_columns)
    assert [tuple(r) for r in pop.collect()] == [("01000us", "US", "2015", "1.0")]


def test_table_sink_comment_properties_and_clustering(spark):
    path = scratch_path(spark, "test-table")
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    df = sinks.annotate_columns(df, {"k": "the key"})
    out = sinks.write_table(df, "strata_test_tbl", path, comment="a test table",
                            properties={"quality": "silver"}, cluster_by=("k",))
    assert out.count() == 100
    desc = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED strata_test_tbl").collect()}
    assert desc.get("Comment") == "a test table"
    props = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES strata_test_tbl").collect()}
    assert props["quality"] == "silver" and props["clustering.columns"] == "k"
    assert spark.table("strata_test_tbl").schema["k"].metadata["comment"] == "the key"


def test_scratch_paths_live_under_checkpoint_dir(spark):
    from strata.session import checkpoint_root
    p = scratch_path(spark, "x")
    assert p.startswith(checkpoint_root(spark)) and p != scratch_path(spark, "x")
    assert local_dir("file:///tmp/a") == "/tmp/a"


def test_pipeline_run_matches_registered_tables(spark):
    import __spark_entry__ as entry
    from strata.plans import pipeline
    from tests.conftest import SF_SMALL
    root = scratch_path(spark, "test-pipeline")
    ingest.land_all(spark, SF_SMALL, f"{root}/landing")
    out = pipeline.run(spark, f"{root}/landing", f"{root}/out")
    q = entry.queries()
    for name in ("silver_data", "silver_series", "silver_lookup_measure", "gold_wide"):
        assert out[name].exceptAll(q[name](spark, SF_SMALL)).count() == 0
        assert out[name].count() == q[name](spark, SF_SMALL).count()
    assert out["gold_best_year"].count() == q["best_year_per_series"](spark, SF_SMALL).count()
    assert out["gold_q01_population"].count() == q["q01_with_population"](spark, SF_SMALL).count()
    for name in [f"silver_{s.name}" for s in specs.ALL] + [f"gold_{n}" for n in specs.GOLD_COMMENTS]:
        written = spark.table(f"strata_{name}")
        for field in written.schema:
            assert field.metadata.get("comment") == specs.COLUMN_COMMENTS[field.name], (name, field.name)
        described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED strata_{name}").collect()}
        assert described["Comment"]
        assert f"quality={name.split('_')[0]}" in described["Table Properties"]


def test_pipeline_records_expectations(spark):
    from strata.plans import pipeline
    from tests.conftest import SF_SMALL
    root = scratch_path(spark, "test-pipeline-exp")
    ingest.land_all(spark, SF_SMALL, f"{root}/landing")
    out = pipeline.run(spark, f"{root}/landing", f"{root}/out")
    exp = {(r.table_name, r.rule): r for r in out["expectations"].collect()}
    data = exp[("data", "valid_period_format")]
    assert data.rows_out == out["silver_data"].count() and data.rows_in >= data.rows_out
    assert exp[("lookup_measure", "valid_measure_code")].failed == 1        # the blank-key row
    assert exp[("lookup_population", "valid_year_range")].failed == 1      # the 'n/a' year


def test_stream_can_include_current_folder(spark):
    root = scratch_path(spark, "test-current")
    landing = f"{root}/landing"
    ingest.land(spark, _raw(spark, 0, 5), specs.DATA, landing)
    tsv.write_tsv(_raw(spark, 5, 8), f"{landing}/current")
    only_backfill = ingest.bronze_stream(spark, specs.DATA, landing)
    both = ingest.bronze_stream(spark, specs.DATA, landing, extra_folders=("current",))
    ingest.run_available_now(only_backfill, f"{root}/b1", f"{root}/c1")
    ingest.run_available_now(both, f"{root}/b2", f"{root}/c2")
    assert spark.read.parquet(f"{root}/b1").count() == 5
    assert spark.read.parquet(f"{root}/b2").count() == 8
