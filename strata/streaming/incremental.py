"""Silver kept up to date batch by batch (S2 to T1), with a feed of what changed.

``refresh`` runs one availableNow pass of a bronze stream; every micro-batch is
merged into the key buckets it touches. The table holds each key's preferred
row before the gate (a preferred row that fails the gate still hides its key,
as in a full build); ``silver`` applies the gate and adds the derived columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.dedup import placed
from ..operators.quality import all_rules_pass_as_one, expect_all_or_drop
from ..plans.silver import derived, preference, typed, winners
from ..plans.specs import TableSpec
from ..session import scratch_path
from ..sources.buckets import BucketedTable, one_file_a_bucket
from ..sources.tsv import string_schema
from .ingest import bronze_stream

#: place: 1 for a key's current row, 2 for the row it replaced in that batch; fresh: whether the batch brought it.
_MARKS = ("place", "fresh")


def merged_table(spark: SparkSession, spec: TableSpec, root: str, buckets: int = 64) -> BucketedTable:
    rows = typed(spark.createDataFrame([], string_schema(spec.raw_columns)), spec)
    return BucketedTable(spark, root, spec.key, rows.schema.add("place", "integer").add("fresh", "boolean"), buckets)


def merge_batch(table: BucketedTable, spec: TableSpec, raw: DataFrame, batch: int) -> bool:
    """Merges raw rows into the buckets of their keys; False if the batch was merged before.

    The batch is reduced to one row a key first, so a key that fills it
    reaches one task as one row a map task. Then the rows of the touched
    buckets and the batch meet by bucket, in one exchange that serves the
    window and the write. Between equal rows the stored one stays.
    """
    if batch <= table.last():
        return False
    spark = table.spark
    path = scratch_path(spark, f"batch-{spec.name}")
    table.with_bucket(winners(typed(raw, spec), spec)).write.parquet(path)
    fresh = spark.read.parquet(path)
    touched = table.touched(fresh)
    stored = table.read(touched).where("place = 1").drop(*_MARKS)
    both = one_file_a_bucket(stored.withColumn("fresh", F.lit(False)).unionByName(fresh.withColumn("fresh", F.lit(True))))
    found = placed(both, ("bucket", *spec.key), **preference(spec), name="place")
    # what a batch brings in vain is neither current nor replaced
    kept = found.where("place = 1 OR (place = 2 AND NOT fresh)")
    return table.replace(kept, touched, batch)


def current(table: BucketedTable, only: Sequence[int] | None = None) -> DataFrame:
    """Each key's preferred row, before the gate."""
    return table.read(only).where("place = 1").drop(*_MARKS, "bucket")


def silver(table: BucketedTable, spec: TableSpec) -> DataFrame:
    """The silver table as a full build of all merged rows would give it."""
    return derived(expect_all_or_drop(current(table), spec.rules, split=False), spec)


def changes(table: BucketedTable, spec: TableSpec, batch: int) -> DataFrame:
    """Silver rows that a batch added (``change`` 1) and took away (-1); a revised row is both.

    Read from the batch's own files, so it can be asked for again after a failure.
    """
    rows = table.written(batch).where("(place = 1 AND fresh) OR (place = 2 AND NOT fresh)")
    marked = rows.select("*", F.when(F.col("fresh"), 1).otherwise(-1).alias("change"))
    return derived(marked.where(all_rules_pass_as_one(spec.rules)).drop(*_MARKS, "bucket"), spec)


def refresh(spark: SparkSession, spec: TableSpec, landing: str, root: str, buckets: int = 64,
            then: Sequence[Callable[[BucketedTable, int], None]] = (), max_files_per_trigger: int | None = 1000) -> BucketedTable:
    """Merges every file that landed since the last call, batch by batch.

    ``then`` is called with the table and the batch after each merge (to
    maintain what is built on it). The stream's checkpoint numbers batches;
    a batch that is run again after a failure finds its merge done and goes
    on with ``then``, whose steps know the batches they applied themselves.
    """
    table = merged_table(spark, spec, f"{root}/{spec.name}", buckets)

    def step(raw: DataFrame, batch: int) -> None:
        merge_batch(table, spec, raw, batch)
        for follow in then:
            follow(table, batch)

    query = (bronze_stream(spark, spec, landing, max_files_per_trigger).writeStream.foreachBatch(step)
             .option("checkpointLocation", f"{root}/checkpoints/{spec.name}").trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return table
