"""Helpers shared by the operators: scratch tables, Arrow text slices, connected components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Hashable, Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package's source to the executors once, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp()) / f"{package.name}-source.zip"
    with zipfile.ZipFile(target, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)


_HELD: dict = {}


def release() -> None:
    """Gives memory that nothing uses any more back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def held(token: Hashable, build: Callable[[], object]) -> object:
    """What ``build`` makes, remembered by a worker until it is asked for under another token.

    A worker serves many tasks and many operators in turn; it remembers for one
    of them at a time, so what an operator learned is given back when the next begins.
    """
    if _HELD.get("token") != token:
        forget()
        _HELD["value"] = build()
        _HELD["token"] = token
    return _HELD["value"]


def forget(but: Hashable = None) -> None:
    """Drops what a worker remembers, unless it is remembered under the token ``but``."""
    if _HELD and (but is None or _HELD["token"] != but):
        _HELD.clear()
        gc.collect()
        release()


def holding(token: Hashable) -> Callable[[Callable], Callable]:
    """Marks a function for :func:`mapped` as one that asks ``held`` for this token."""
    def marked(run: Callable) -> Callable:
        run.token = token
        return run

    return marked


#: Spark's setting for the bytes of an Arrow batch, its default, and what batches of texts get where nothing else is set.
BATCH_SETTING, BATCH_DEFAULT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20, 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds Arrow batches by BATCH_BYTES unless the session sets a bound of its own: a batch of long texts
    is held by the JVM and by the worker, for every task at once."""
    now = spark.conf.get(BATCH_SETTING, None)
    if now is not None and now.rstrip("b") == str(BATCH_DEFAULT):
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with this package importable on the executors.

    A worker first forgets what it remembers under a token that ``run`` doesn't
    ask for (see :func:`holding`), so no operator works beside another's memory.
    """
    ship(df.sparkSession)
    small_batches(df.sparkSession)

    token = getattr(run, "token", None)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(but=token)
        yield from run(batches)
        release()

    return df.mapInArrow(task, schema)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, removed when the driver ends."""
    path = scratch_path(spark, purpose)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage and outlives executors."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class _Index(dict):
    """Numbers keys in order of first sight; ``fresh`` lists those not yet encoded."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        self.fresh.append(key)
        return number


class Memo:
    """Values of words, each word worked out once while it is remembered.

    ``values`` maps a list of new words to one integer sequence each. The memory is
    emptied between calls once it holds ``limit`` words or values, so it stays
    bounded whatever the texts hold.
    """

    def __init__(self, values, limit: int = 300_000):
        self.values, self.limit = values, limit
        self.clear()

    def clear(self) -> None:
        self.index = _Index()
        self.flat = np.empty(0, np.int32)
        self.starts = np.empty(0, np.int64)
        self.sizes = np.empty(0, np.int64)

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All words' values end to end, and how many each word has."""
        if len(self.index) > self.limit or len(self.flat) > 8 * self.limit:
            self.clear()
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        if self.index.fresh:
            found = self.values(self.index.fresh)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            self.starts = np.concatenate((self.starts, len(self.flat) + np.cumsum(sizes) - sizes))
            self.sizes = np.concatenate((self.sizes, sizes))
            self.flat = np.concatenate((self.flat, np.fromiter(
                chain.from_iterable(found), np.int32, int(sizes.sum()))))
            self.index.fresh = []
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(self.starts[at] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)], sizes


#: Rows of ids, or of small records, up to which a join's side is broadcast (some tens of MB).
BROADCAST_ROWS = 2_000_000


def checked(side: DataFrame, lists: str | None = None) -> DataFrame:
    """A written side of a join, broadcast if it has BROADCAST_ROWS rows at most; beyond that the join shuffles.

    ``lists`` names an array column whose entries count like rows.
    """
    size = F.count("*") + (F.sum(F.size(lists)) if lists else F.lit(0))
    return F.broadcast(side) if (side.agg(size).first()[0] or 0) <= BROADCAST_ROWS else side


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most ``rows`` rows and, but for a longer single row, ``size`` bytes, so Python holds few texts at a time."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            take = min(rows, batch.num_rows - at)
            while take > 1 and batch.slice(at, take).nbytes > size:
                take = (take + 1) // 2
            yield batch.slice(at, take)
            at += take


def remainder(id_col: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % divisor


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """Smallest reachable node of every node of ``edges(a, b)``, as ``(node, label)``.

    Alternates two contractions until nothing changes, each written to the
    shared folder: every node links its larger neighbours to the smallest
    node it sees ("large star"), then its smaller neighbours and itself
    ("small star"). Rounds grow with the logarithm of a component's size and
    the edge count never grows. A hub's edges are pre-aggregated for the
    minimum and joined back, where adaptive execution can split a hot hub.
    """
    def star(links: DataFrame) -> DataFrame:
        least = links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return links.join(least, "u")

    pairs = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                    .where("u <> v").distinct(), purpose)
    state = None
    while True:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        joined = star(large)
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(joined.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        pairs = written(small, purpose)
        seen = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                         F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    labels = pairs.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return labels.union(roots)
