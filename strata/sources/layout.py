"""Layout on several keys at once, and reads that skip files by it.

Sorting by keys in order lets only the first one prune. Here every key is cut
into ranges of about equally many rows, the ranks' bits are interleaved
(Z order), and files hold neighbours on that curve: each key's range in a file
is narrow. A zone map beside the files holds each file's least and greatest
key values; a read with conditions on any of the keys opens the files whose
ranges can meet them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows sampled for the cuts, and bits of a key's rank.
SAMPLE_ROWS = 20_000
BITS = 6
ZONES = "_zones"


def cuts(df: DataFrame, keys: Sequence[str], bits: int = BITS, sample_rows: int = SAMPLE_ROWS) -> dict[str, list]:
    """For each key the values that open a new rank: at most 2**bits - 1, from about ``sample_rows`` sampled rows.

    The sample decides how even the ranks are, never which rows are kept.
    """
    share = min(1.0, sample_rows / max(1, df.count()))
    sample = df.select(*[F.col(f"`{k}`") for k in keys]).sample(share, seed=1).collect()
    out = {}
    for n, key in enumerate(keys):
        values = sorted(r[n] for r in sample if r[n] is not None)
        at = [values[len(values) * i // (1 << bits)] for i in range(1, 1 << bits)] if values else []
        out[key] = sorted(set(at))
    return out


def rank(key: Column, opens: Sequence, low: int = 0, high: int | None = None) -> Column:
    """How many of the sorted values ``opens`` are at most ``key``, by halving; 0 for NULL."""
    high = len(opens) if high is None else high
    if low == high:
        return F.lit(low)
    mid = (low + high) // 2
    return F.when(key >= F.lit(opens[mid]), rank(key, opens, mid + 1, high)).otherwise(rank(key, opens, low, mid))


def interleaved(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """Place on the Z curve: the ranks' bits in turn, highest first."""
    place = F.lit(0).cast("long")
    for n, r in enumerate(ranks):
        for bit in range(bits):
            one = F.shiftright(r, bit).bitwiseAND(F.lit(1)).cast("long")
            place = place.bitwiseOR(F.shiftleft(one, bit * len(ranks) + n))
    return place


def leaves(counts: Mapping[int, int], depth: int, target: int) -> tuple[list[int], list[int], int]:
    """Files for the curve's cells of ``depth`` bits, given their rows: each cell's first file and its number of files.

    The curve is halved until a piece has ``target`` rows at most, so a file
    holds a whole box and never reaches over a jump of the curve; a single
    cell with more rows gets several files.
    """
    first, ways, files = [0] * (1 << depth), [1] * (1 << depth), 0
    below = [0]
    for cell in range(1 << depth):
        below.append(below[-1] + counts.get(cell, 0))
    open_ = [(0, 1 << depth)]
    while open_:
        low, high = open_.pop()
        rows = below[high] - below[low]
        if rows > target and high - low > 1:
            mid = (low + high) // 2
            open_ += [(mid, high), (low, mid)]
            continue
        several = max(1, -(-rows // target))
        first[low:high], ways[low:high] = [files] * (high - low), [several] * (high - low)
        files += several if rows else 0
    return first, ways, max(1, files)


def z_ordered(df: DataFrame, keys: Sequence[str], files: int = 64, bits: int = BITS) -> DataFrame:
    """``df`` in about ``files`` partitions (more where keys go together), each a box of the Z curve of ``keys``, sorted within.

    Rows of one cell, however many, are spread by a hash of the whole row, so
    a hot key becomes several files instead of one. Counted first: rows a
    cell, at most 16 times as many cells as files, combined in map tasks.
    """
    if bits * len(keys) > 62:
        raise ValueError(f"{len(keys)} keys of {bits} bits don't fit one place")
    if not keys:
        return df
    opens = cuts(df, keys, bits)
    place = interleaved([rank(F.col(f"`{k}`"), opens[k]) for k in keys], bits)
    depth = min(bits * len(keys), max(1, (files - 1).bit_length()) + 4)
    cell = F.shiftright(place, bits * len(keys) - depth).cast("int")
    counts = {r.cell: r["count"] for r in df.select(cell.alias("cell")).groupBy("cell").count().collect()}
    # a quarter more than an even share, so that cells which are even but for the sample's noise aren't halved
    first, ways, whole = leaves(counts, depth, max(1, sum(counts.values()) * 5 // (4 * files)))
    marked = df.withColumn("__place", place).withColumn("__cell", cell)
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.element_at(F.lit(ways), F.col("__cell") + 1))
    number = (F.element_at(F.lit(first), F.col("__cell") + 1) + spread).cast("int")
    return (marked.repartitionById(whole, number).sortWithinPartitions("__place", *[F.col(f"`{k}`") for k in keys])
            .drop("__place", "__cell"))


def write_z_ordered(df: DataFrame, path: str, keys: Sequence[str], files: int = 64) -> DataFrame:
    """Writes ``df`` in Z order with its zone map; returns a read of it."""
    spark = df.sparkSession
    z_ordered(df, keys, files).write.mode("overwrite").parquet(path)
    kept = spark.read.schema(df.schema).parquet(path)
    zones(kept, keys).coalesce(1).write.mode("overwrite").parquet(f"{path}/{ZONES}")
    return kept


def zones(kept: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a file: its name, rows, and each key's least and greatest value and NULLs (``<key>_least`` and so on)."""
    found = [f(k) for k in keys for f in (
        lambda k: F.min(f"`{k}`").alias(f"{k}_least"), lambda k: F.max(f"`{k}`").alias(f"{k}_most"),
        lambda k: F.count_if(F.col(f"`{k}`").isNull()).alias(f"{k}_nulls"))]
    return kept.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("rows"), *found)


def may_hold(conditions: Mapping[str, tuple]) -> Column:
    """Whether a file's zone can hold rows with every key within its inclusive (low, high); None leaves an end open."""
    hit = F.lit(True)
    for key, (low, high) in conditions.items():
        if low is not None:
            hit = hit & (F.col(f"`{key}_most`") >= F.lit(low))
        if high is not None:
            hit = hit & (F.col(f"`{key}_least`") <= F.lit(high))
    return F.coalesce(hit, F.lit(False))


def files_for(spark: SparkSession, path: str, conditions: Mapping[str, tuple]) -> list[str]:
    """Names of the files that can hold matching rows, from the zone map alone."""
    found = spark.read.parquet(f"{path}/{ZONES}").where(may_hold(conditions)).select("file").collect()
    return sorted(r.file for r in found)


def read_where(spark: SparkSession, path: str, conditions: Mapping[str, tuple]) -> DataFrame:
    """Rows of a Z-ordered table with every key within its inclusive (low, high), reading only files that can hold them.

    ``(v, v)`` asks for one value, ``(v, None)`` for at least v. A NULL key matches no condition.
    """
    schema = spark.read.parquet(path).schema
    names = files_for(spark, path, conditions)
    rows = spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in names]) if names else spark.createDataFrame([], schema)
    for key, (low, high) in conditions.items():
        if low is not None:
            rows = rows.where(F.col(f"`{key}`") >= F.lit(low))
        if high is not None:
            rows = rows.where(F.col(f"`{key}`") <= F.lit(high))
    return rows
