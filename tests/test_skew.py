"""A key that holds a third of all rows must neither break results nor land
whole on one reducer: dedup and aggregates pre-reduce map-side."""

from pyspark.sql import functions as F

from strata.operators import aggregates, dedup, ranking
from strata.sources import manifest
from strata.session import scratch_path


def _skewed(spark, n=30000):
    ids = spark.range(n).repartition(8)
    hot = F.col("id") % 3 == 0                                    # a third of the rows share one key
    return ids.select(
        F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("S"), (F.col("id") % 500).cast("string"))).alias("series_id"),
        F.when(hot, F.lit(2000)).otherwise((F.col("id") % 7 + 1995).cast("int")).alias("year"),
        F.lit("Q01").alias("period"), F.lit("quarterly").alias("period_type"),
        (F.col("id") % 1000 / 10.0).alias("value"),
        F.when(F.col("id") == 3, F.lit("R")).otherwise(F.lit(None).cast("string")).alias("footnote_codes"),
        F.lit("label").alias("series_label"))


def test_dedup_hot_key_partial_limit_and_result(spark):
    df = _skewed(spark)
    out = dedup.deduplicate(df, ["series_id", "year", "period"], "footnote_codes", "R")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    hot = out.where("series_id = 'HOT'").collect()
    assert len(hot) == 1 and hot[0].footnote_codes == "R" and hot[0].value == 0.3
    assert out.count() == df.select("series_id", "year", "period").distinct().count()


def test_aggregates_on_hot_key(spark):
    df = _skewed(spark)
    sums = aggregates.annual_sums(df)
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2                        # partial + final
    exp = df.where("series_id = 'HOT'").agg(F.sum("value")).first()[0]
    got = sums.where("series_id = 'HOT'").first().annual_sum
    assert abs(got - exp) < 1e-6
    best = ranking.best_year_per_series(df)
    assert best.count() == df.select("series_id").distinct().count()


def test_routing_write_partitions_by_category(spark):
    entries = spark.createDataFrame([("pr.series",), ("pr.data.0.Current",), ("pr.contacts",), ("pr.class",)],
                                    "filename string")
    path = scratch_path(spark, "test-categories")
    manifest.write_by_category(entries, path)
    back = spark.read.parquet(path)
    assert sorted(r.category for r in back.collect()) == ["current", "enrichment", "series"]


def test_fact_scan_reads_only_needed_columns(spark):
    import re

    import __spark_entry__ as entry
    from tests.conftest import SF_ORACLE
    plan = entry.queries()["silver_data"](spark, SF_ORACLE)._jdf.queryExecution().executedPlan().toString()
    cols = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert len(cols) == 1
    read = {c.split("#")[0] for c in cols[0].split(",")}
    assert read == {"l_orderkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate"}


def test_lookups_are_broadcast_in_wide_table(spark):
    import __spark_entry__ as entry
    from tests.conftest import SF_ORACLE
    plan = entry.queries()["gold_wide"](spark, SF_ORACLE)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 7
