"""Quality gates that keep what they drop, with the reasons (E1–E3 in one pass).

One scan of the input writes kept and dropped rows side by side; every row
carries a bit mask of the rules it fails. Counts per rule come from the masks
that were written, so neither the metrics nor the dropped rows cost another
pass over the input.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from .quality import rule_passes

#: Column with the failed rules' bits, and the one that the written table is partitioned by.
MASK, DROPPED = "failed_rules", "is_dropped"


def failed_mask(rules: Mapping[str, str]) -> Column:
    """Bit n is set where the n-th rule fails; a rule that gives NULL fails."""
    if len(rules) > 62:
        raise ValueError(f"{len(rules)} rules don't fit one mask")
    mask = F.lit(0).cast("long")
    for n, expr in enumerate(rules.values()):
        mask = mask.bitwiseOR(F.when(rule_passes(expr), F.lit(0)).otherwise(F.lit(1 << n)).cast("long"))
    return mask


def reasons(rules: Mapping[str, str], mask: str = MASK) -> Column:
    """Names of the rules whose bits are set, in the rules' order."""
    named = [F.when(F.col(mask).bitwiseAND(F.lit(1 << n).cast("long")) != 0, F.lit(name)) for n, name in enumerate(rules)]
    if not named:
        return F.array().cast("array<string>")
    return F.filter(F.array(*named), lambda x: x.isNotNull())


class SplitTable:
    """What ``split_by_rules`` wrote: ``kept`` and ``dropped`` rows and their counts, each read from its own files."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, rules: Mapping[str, str]):
        self.path, self.rules = path, dict(rules)
        self._columns = schema.fieldNames()
        # named here, so that a side without rows (and so without files) still has its columns
        full = StructType([*schema.fields, StructField(MASK, LongType()), StructField(DROPPED, BooleanType())])
        self._all = spark.read.schema(full).parquet(path)

    @property
    def kept(self) -> DataFrame:
        return self._all.where(~F.col(DROPPED)).select(*[F.col(f"`{c}`") for c in self._columns])

    @property
    def dropped(self) -> DataFrame:
        """Dropped rows with the mask and the names of the rules they fail."""
        return self._all.where(F.col(DROPPED)).drop(DROPPED).withColumn("reasons", reasons(self.rules))

    def metrics(self) -> DataFrame:
        """One row, the same as ``expectation_metrics`` of the input; reads the masks only."""
        failed = [F.count_if(F.col(MASK).bitwiseAND(F.lit(1 << n).cast("long")) != 0).alias(f"failed_{name}")
                  for n, name in enumerate(self.rules)]
        return self._all.agg(F.count(F.lit(1)).alias("rows_in"), F.count_if(~F.col(DROPPED)).alias("rows_out"), *failed)


def split_by_rules(df: DataFrame, rules: Mapping[str, str], path: str) -> SplitTable:
    """Writes ``df`` to ``path``, rows that pass every rule apart from the others.

    A narrow plan: no shuffle, one scan, each task writes at most one file a
    side. A table with a column named like the mask is refused.
    """
    taken = {MASK, DROPPED, "reasons"} & {c.lower() for c in df.columns}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are taken by the split")
    marked = df.withColumn(MASK, failed_mask(rules))
    marked.withColumn(DROPPED, F.col(MASK) != 0).write.mode("overwrite").partitionBy(DROPPED).parquet(path)
    return SplitTable(df.sparkSession, path, df.schema, rules)
