"""Tables kept in hash buckets that are replaced one by one.

A commit writes new files for the buckets it touches and one small file that
says which batch holds each bucket now. Readers follow the last such file, so
they see a commit whole or not at all; files of untouched buckets stay as they
are; a batch that was committed before changes nothing when it comes again.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _names(spark: SparkSession, path: str) -> list[str]:
    files, at = _fs(spark, path)
    return [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []


@dataclass(frozen=True)
class BucketedTable:
    """Rows of ``schema`` under ``root``, in ``buckets`` buckets by a hash of ``key`` (NULLs hash like values).

    Choose the number of buckets so that one holds a few files' worth of
    rows; it is fixed once the table has rows.
    """
    spark: SparkSession
    root: str
    key: tuple[str, ...]
    schema: StructType
    buckets: int = 64

    def with_bucket(self, df: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.key]), F.lit(self.buckets)).cast("int")
        return df.withColumn("bucket", bucket)

    def touched(self, df: DataFrame) -> list[int]:
        """Buckets that ``df`` (with its bucket column) has rows in: at most ``buckets`` numbers."""
        return sorted(r.bucket for r in df.select("bucket").distinct().collect())

    def last(self) -> int:
        """Number of the last committed batch; -1 before the first."""
        return max((int(n.removesuffix(".json")) for n in _names(self.spark, f"{self.root}/commits") if n.endswith(".json")),
                   default=-1)

    def placed(self) -> dict[int, int]:
        """For each bucket that has rows, the batch that wrote it."""
        last = self.last()
        if last < 0:
            return {}
        text = self.spark.read.text(f"{self.root}/commits/{last}.json", wholetext=True).first()[0]
        return {int(bucket): batch for bucket, batch in json.loads(text).items()}

    def read(self, only: Iterable[int] | None = None) -> DataFrame:
        """Current rows with their bucket, of all buckets or of some; only their files are listed."""
        wanted = None if only is None else set(only)
        paths = [f"{self.root}/data/batch={batch}/bucket={bucket}" for bucket, batch in sorted(self.placed().items())
                 if wanted is None or bucket in wanted]
        schema = StructType(list(self.schema.fields)).add("bucket", "integer")
        if not paths:
            return self.spark.createDataFrame([], schema)
        return (self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths)
                .select(*[F.col(f"`{c}`") for c in schema.names]))

    def written(self, batch: int) -> DataFrame:
        """Rows that one batch wrote, whether they are current or not."""
        schema = StructType(list(self.schema.fields)).add("bucket", "integer")
        return self.spark.read.schema(schema).parquet(f"{self.root}/data/batch={batch}")

    def replace(self, rows: DataFrame, touched: Iterable[int], batch: int) -> bool:
        """Makes ``rows`` (with their bucket) all that the ``touched`` buckets hold; False if the batch was committed before."""
        if batch <= self.last():
            return False
        touched = set(touched)
        names = [*self.schema.names, "bucket"]
        (rows.select(*[F.col(f"`{c}`") for c in names]).write.mode("overwrite").partitionBy("bucket")
         .parquet(f"{self.root}/data/batch={batch}"))
        filled = [int(n.partition("=")[2]) for n in _names(self.spark, f"{self.root}/data/batch={batch}") if n.startswith("bucket=")]
        self._commit({b: w for b, w in self.placed().items() if b not in touched} | dict.fromkeys(filled, batch), batch)
        return True

    def _commit(self, now: dict[int, int], batch: int) -> None:
        """One small file, written aside and renamed: the commit is there whole or not at all."""
        files, target = _fs(self.spark, f"{self.root}/commits/{batch}.json")
        _, aside = _fs(self.spark, f"{self.root}/commits/_{batch}.writing")
        stream = files.create(aside, True)
        stream.write(bytearray(json.dumps(now, sort_keys=True).encode()))
        stream.close()
        if not files.rename(aside, target):
            raise OSError(f"can't commit batch {batch} of {self.root}")

    def vacuum(self) -> None:
        """Deletes files of buckets that the last commit doesn't hold any more."""
        current, last = self.placed(), self.last()
        for folder in _names(self.spark, f"{self.root}/data"):
            batch = folder.partition("=")[2]
            if not batch.isdigit() or int(batch) > last:
                continue
            for child in _names(self.spark, f"{self.root}/data/{folder}"):
                name, _, bucket = child.partition("=")
                if name == "bucket" and current.get(int(bucket)) != int(batch):
                    files, at = _fs(self.spark, f"{self.root}/data/{folder}/{child}")
                    files.delete(at, True)


def one_file_a_bucket(rows: DataFrame) -> DataFrame:
    """``rows`` brought together by bucket, so that a bucket is written by one task."""
    return rows.repartition("bucket")

