"""A fact and a dimension in equal buckets, joined without moving either.

A dimension too large to broadcast shuffles the whole fact at every join.
Written once in hash buckets of the join key, both sides meet bucket by bucket.
Hashing would put a hot key's rows into one bucket, and so into one task:
rows of keys with more than an even share lie apart, unbucketed, and meet
their few dimension rows by broadcast.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F


class Colocated(NamedTuple):
    """Two bucketed tables and, apart, the rows of hot and NULL keys with the hot keys' dimension rows."""

    key: str
    fact: DataFrame
    dim: DataFrame
    hot_fact: DataFrame
    hot_dim: DataFrame

    def join(self) -> DataFrame:
        """Fact ⟕ dimension, with no exchange of the fact.

        A bucket of the dimension is hashed in memory by the task that reads it, so
        choose enough buckets for that.
        """
        even = self.fact.join(self.dim.hint("shuffle_hash"), self.key, "left")
        return even.unionByName(self.hot_fact.join(F.broadcast(self.hot_dim), self.key, "left"))


def hot_keys(fact: DataFrame, key: str, buckets: int) -> list:
    """Keys with more rows than an even share of ``buckets``: fewer than ``buckets`` of them, whatever the data."""
    counts = fact.where(F.col(key).isNotNull()).groupBy(key).count()
    return [r[0] for r in counts.where(F.col("count") > fact.count() // buckets).select(key).collect()]


def bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Writes ``df`` as a table of ``buckets`` files hashed by ``key``; the table's name is new."""
    name = f"strata_bucketed_{uuid.uuid4().hex[:12]}"
    (df.repartition(buckets, key).write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def lay_out(fact: DataFrame, dim: DataFrame, key: str, path: str, buckets: int = 200) -> Colocated:
    """Writes both sides below ``path``; ``fact`` is read four times, so pass a written table.

    ``dim`` must be unique on ``key``. Rows whose key is NULL join nothing and
    are kept with the hot ones, so they are spread too.
    """
    spark = fact.sparkSession
    hot = hot_keys(fact, key, buckets)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False)) if hot else F.lit(False)
    apart = F.col(key).isNull() | is_hot
    fact.where(apart).write.mode("overwrite").parquet(f"{path}/hot_fact")
    laid = bucketed(dim, f"{path}/dim", key, buckets)
    return Colocated(key, bucketed(fact.where(~apart), f"{path}/fact", key, buckets), laid,
                     spark.read.schema(fact.schema).parquet(f"{path}/hot_fact"), laid.where(is_hot))
