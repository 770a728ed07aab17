"""Z order: files hold narrow ranges of every key, and reads skip the others."""

import glob

import pytest
from pyspark.sql import functions as F

from strata.session import local_dir, scratch_path
from strata.sources import layout


@pytest.fixture(scope="module")
def laid_out(spark):
    df = spark.range(120_000).select(
        (F.xxhash64(F.lit(1), "id") % 1000).cast("int").alias("a"), F.concat(F.lit("k"), F.lpad(F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(500)).cast("string"), 4, "0")).alias("b"),
        F.expr("date_add(DATE'2000-01-01', int(pmod(xxhash64(3, id), 4000)))").alias("c"),
        F.when(F.col("id") % 50 != 0, F.col("id")).alias("id"))
    path = scratch_path(spark, "test-zorder")
    df.write.parquet(f"{path}-in")
    df = spark.read.parquet(f"{path}-in")
    layout.write_z_ordered(df, path, ("a", "b", "c"), files=128)
    return path, df


def test_a_filter_on_any_key_opens_a_quarter_of_the_files(spark, laid_out):
    path, df = laid_out
    total = len(glob.glob(f"{local_dir(path) or path}/*.parquet"))
    assert 100 <= total <= 192
    import datetime
    for probe in ({"a": (17, 17)}, {"b": ("k0123", "k0123")}, {"c": (datetime.date(2003, 2, 1),) * 2}):
        names = layout.files_for(spark, path, probe)
        assert 0 < len(names) <= total // 4, (probe, len(names))
        key, (value, _) = next(iter(probe.items()))
        got = layout.read_where(spark, path, probe)
        assert got.count() == df.where(F.col(key) == F.lit(value)).count() > 0
        assert got.exceptAll(df.where(F.col(key) == F.lit(value))).isEmpty()
        assert len(got.inputFiles()) == len(names)
    both = {"a": (10, 300), "b": (None, "k0100")}
    assert layout.read_where(spark, path, both).count() == df.where("a BETWEEN 10 AND 300 AND b <= 'k0100'").count()
    assert layout.read_where(spark, path, {"a": (5000, None)}).count() == 0


def test_a_hot_place_is_spread_and_no_row_is_lost(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).cast("int").alias("a"),
                                    F.when(F.col("id") % 3 == 0, "x").when(F.col("id") % 7 != 0, F.col("id").cast("string")).alias("b"),
                                    "id", F.lit(1).alias("__extra"))
    path = scratch_path(spark, "test-hot")
    kept = layout.write_z_ordered(df, path, ("a", "b"), files=16)
    assert kept.columns == df.columns and kept.exceptAll(df).isEmpty() and kept.count() == 30_000
    sizes = [r["rows"] for r in spark.read.parquet(f"{path}/{layout.ZONES}").collect()]
    assert max(sizes) < 3_000  # 10,000 rows share one place


def test_empty_table_and_null_keys(spark):
    path = scratch_path(spark, "test-none")
    none = spark.createDataFrame([], "a int, b string")
    assert layout.write_z_ordered(none, path, ("a", "b")).count() == 0
    assert layout.read_where(spark, path, {"a": (1, 1)}).count() == 0
    only = spark.createDataFrame([(None, None), (None, "x"), (1, None)], "a int, b string")
    layout.write_z_ordered(only, path + "2", ("a", "b"), files=2)
    assert [tuple(r) for r in layout.read_where(spark, path + "2", {"a": (1, 1)}).collect()] == [(1, None)]


def test_rank_counts_the_opening_values(spark):
    df = spark.createDataFrame([(n,) for n in [None, -5, 0, 1, 2, 3, 9]], "a int")
    got = [r[0] for r in df.select(layout.rank(F.col("a"), [0, 2, 3])).collect()]
    assert got == [0, 0, 1, 1, 2, 3, 3]
    assert layout.leaves({0: 5, 1: 1, 2: 1, 3: 1}, 2, 3) == ([0, 2, 3, 3], [2, 1, 1, 1], 4)
    with pytest.raises(ValueError, match="don't fit"):
        layout.z_ordered(df, ("a",) * 8, bits=8)
