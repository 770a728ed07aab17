"""Kept and dropped rows from one scan, with reasons and counts."""

import pytest
from pyspark.sql import functions as F

from strata.operators import quality, quarantine
from strata.session import scratch_path

RULES = {"has_key": "k IS NOT NULL", "positive": "v > 0", "short": "length(t) < 4"}


def test_counts_reasons_and_rows_equal_the_plain_gate(spark):
    rows = [("a", 1, "x"), (None, 1, "x"), ("b", -1, "long text"), ("c", None, None), ("a", 1, "x"), (None, None, None)]
    df = spark.createDataFrame(rows, "k string, v int, t string")
    split = quarantine.split_by_rules(df, RULES, scratch_path(spark, "test-split"))
    assert split.kept.columns == df.columns
    assert sorted(map(tuple, split.kept.collect())) == [("a", 1, "x"), ("a", 1, "x")]
    assert split.kept.exceptAll(quality.expect_all_or_drop(df, RULES)).isEmpty()
    assert split.metrics().collect() == quality.expectation_metrics(df, RULES).collect()
    found = {(r.k, r.v): r.reasons for r in split.dropped.collect()}
    assert found == {(None, 1): ["has_key"], ("b", -1): ["positive", "short"], ("c", None): ["positive", "short"],
                     (None, None): ["has_key", "positive", "short"]}


def test_sides_without_rows_and_taken_names(spark):
    df = spark.createDataFrame([("a", 1, "x")], "k string, v int, t string")
    split = quarantine.split_by_rules(df, RULES, scratch_path(spark, "test-split"))
    assert split.dropped.count() == 0 and split.kept.count() == 1
    none = quarantine.split_by_rules(df.where("false"), RULES, scratch_path(spark, "test-split"))
    assert none.kept.count() == none.dropped.count() == 0
    assert none.metrics().collect() == quality.expectation_metrics(df.where("false"), RULES).collect()
    free = quarantine.split_by_rules(df, {}, scratch_path(spark, "test-split"))
    assert free.kept.count() == 1 and free.dropped.select("reasons").count() == 0
    with pytest.raises(ValueError, match="taken"):
        quarantine.split_by_rules(df.withColumn(quarantine.MASK, F.lit(1)), RULES, "unused")
    with pytest.raises(ValueError, match="don't fit"):
        quarantine.failed_mask({str(n): "true" for n in range(63)})


def test_each_side_reads_its_own_files(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 10 != 0, F.col("id").cast("string")).alias("k"), F.lit(1).alias("v"), F.lit("x").alias("t"))
    split = quarantine.split_by_rules(df, RULES, scratch_path(spark, "test-split"))
    plan = split.kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and quarantine.DROPPED in plan and plan.count("FileScan") == 1
    assert split.kept.count() == 900 and split.dropped.count() == 100
