"""Bucketed joins without exchange, bitmaps for key uniqueness, pruning by year at run time."""

import pytest
from pyspark.sql import functions as F

from strata.operators import bitmaps, reconcile
from strata.plans import ask
from strata.session import scratch_path
from strata.sources import colocated, sinks


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def fact(spark):
    """A third of the rows share one key, some have none, some know no dimension row."""
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").when(n % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("s"), (n % 700).cast("string")))
    path = scratch_path(spark, "test-fact")
    spark.range(30_000).select(key.alias("k"), n.alias("v")).write.parquet(path)
    return spark.read.parquet(path)


def test_join_moves_no_fact_and_equals_the_plain_join(spark, fact):
    dim = spark.range(650).select(F.concat(F.lit("s"), "id").alias("k"), (F.col("id") * 2).alias("a")).union(
        spark.createDataFrame([("hot", -1)], "k string, a long"))
    assert colocated.hot_keys(fact, "k", 8) == ["hot"]
    laid = colocated.lay_out(fact, dim, "k", scratch_path(spark, "test-colocated"), buckets=8)
    got, want = laid.join(), fact.join(dim, "k", "left")
    assert "hashpartitioning" not in _plan(got) and "ShuffledHashJoin" in _plan(got)
    assert got.count() == 30_000 and got.exceptAll(want).isEmpty()
    assert laid.fact.where("k = 'hot' OR k IS NULL").count() == 0
    assert laid.hot_fact.where("k = 'hot'").count() == 10_000


def test_join_of_empty_tables(spark):
    none = spark.createDataFrame([], "k string, v long")
    dim = spark.createDataFrame([("a", 1)], "k string, a long")
    assert colocated.lay_out(none, dim, "k", scratch_path(spark, "test-colocated"), buckets=4).join().count() == 0
    one = spark.createDataFrame([("a", 1), (None, 2)], "k string, v long")
    got = colocated.lay_out(one, dim.where("false"), "k", scratch_path(spark, "test-colocated"), buckets=4).join()
    assert sorted(map(tuple, got.select("v", "a").collect())) == [(1, None), (2, None)]


def test_bitmaps_count_keys_as_distinct_does(spark, fact):
    path = scratch_path(spark, "test-bitmaps")
    rows = fact.select("k", (F.col("v") % 40 - 20).cast("int").alias("y"), (F.col("v") * 1_000_003).alias("wide"),
                       F.when(F.col("v") % 9 != 0, (F.col("v") % 4).cast("tinyint")).alias("q"))
    for n, keys in enumerate((("k", "y", "q"), ("k", "wide"), ("y",), ("q", "k"))):
        got = bitmaps.check_unique_key_bitmap(rows, keys, f"{path}/{n}").first()
        want = reconcile.check_unique_key(rows, keys).first()
        assert (got.rows, got.distinct_keys, got.passed) == (want.rows, want.distinct_keys, want.passed), keys
    unique = bitmaps.check_unique_key_bitmap(rows, ("wide",), f"{path}/u").first()
    assert unique.passed and unique.distinct_keys == 30_000


def test_bitmaps_of_empty_tables_and_too_many_values(spark):
    path = scratch_path(spark, "test-bitmaps")
    none = spark.createDataFrame([], "k string, y int")
    r = bitmaps.check_unique_key_bitmap(none, ("k", "y"), path).first()
    assert (r.rows, r.distinct_keys, r.passed) == (0, 0, True)
    only = spark.createDataFrame([(None, None), (None, None)], "k string, y int")
    r = bitmaps.check_unique_key_bitmap(only, ("k", "y"), path + "2").first()
    assert (r.rows, r.distinct_keys, r.passed) == (2, 1, False)
    wide = spark.range(1000).select(*[F.col("id").alias(c) for c in "abcdefg"])
    with pytest.raises(ValueError, match="too many"):
        bitmaps.numbered(wide, list("abcdefg"), path + "3")


def test_bitmaps_move_few_rows(spark):
    """Keys sorted in files: each task ships the bitmaps of its own stretch."""
    numbers = spark.range(0, 400_000, 1, 4).select(F.col("id").alias("key_number"))
    got = bitmaps.bitmap_distinct(numbers)
    assert tuple(got.first()) == (400_000, 400_000)
    assert numbers.groupBy(F.bitmap_bucket_number("key_number")).count().count() <= 14


def test_latest_year_reads_one_year(spark):
    n = F.col("id")
    wide = spark.range(4000).select(
        (1990 + n % 20).cast("int").alias("year"), F.lit("annual").alias("period_type"), n.cast("double").alias("value"),
        F.when(n % 20 < 15, "steel rings").otherwise("bolts").alias("measure_text"), F.lit("01").alias("measure_code"),
        (n % 3).cast("string").alias("sector_code"), F.concat(F.lit("s"), n % 3).alias("sector_name"))
    kept = sinks.write_partitioned(wide, scratch_path(spark, "test-by-year"), "year")
    assert kept.columns == wide.columns and kept.exceptAll(wide).isEmpty() and kept.count() == 4000
    got = ask.ask_latest_year_of_wide(kept, "ring")
    assert "dynamicpruning" in _plan(got)
    want = wide.where("year = 2004").groupBy("sector_name").agg(F.round(F.avg("value"), 2).alias("a"), F.count("*").alias("c"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = ask.ask_latest_year_of_wide(kept, "ring")
        got.collect()
        leaves = got._jdf.queryExecution().executedPlan().collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size())]
        files = [s.metrics().apply("numFiles").value() for s in scans if "FileScan" in s.toString()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert files and min(files) * 20 <= len(kept.inputFiles())
