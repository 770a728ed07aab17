"""Exact distinct counts of keys through mergeable bitmaps (V4).

Every key gets a number, dense by construction: each column is numbered
within its own values, and the numbers are put together like digits. Bitmaps of
32,768 numbers are filled in map tasks and merged by OR, so the shuffle holds
bitmaps instead of keys, and a key that holds a third of the rows is one bit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

from .joins import sized_broadcast

#: A whole-number column is numbered by its distance from the least value up to this span, others by a dictionary.
DIRECT_SPAN = 1 << 20


def dictionary(df: DataFrame, column: str, path: str) -> tuple[DataFrame, int]:
    """``(value, number)`` of the distinct non-NULL values, numbered from 1 without gaps, and how many there are.

    Values are sorted into ranges and numbered within them; only the ranges'
    sizes reach the driver. The ranges are written first, so that a lost
    executor can't number them in another way.
    """
    values = df.select(F.col(f"`{column}`").alias("value")).where("value IS NOT NULL").distinct()
    (values.repartitionByRange("value").sortWithinPartitions("value")
     .select("value", F.monotonically_increasing_id().alias("place")).write.mode("overwrite").parquet(path))
    kept = df.sparkSession.read.parquet(path)
    part = F.shiftrightunsigned("place", 33)  # monotonic ids keep the range above 33 bits of position
    sizes = kept.groupBy(part.alias("part")).count().orderBy("part").collect()
    starts, total = {}, 0
    for row in sizes:
        starts[row.part], total = total, total + row["count"]
    if not starts:
        return kept.select("value", F.lit(0).cast("long").alias("number")), 0
    # one array a range: its place in the array is the range's own number
    first = F.element_at(F.lit([starts.get(n, 0) for n in range(max(starts) + 1)]), (part + 1).cast("int"))
    within = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return kept.select("value", (first + within + 1).cast("long").alias("number")), total


def numbered(df: DataFrame, cols: Sequence[str], path: str, as_: str = "key_number") -> DataFrame:
    """One column: each row's key as one number; equal keys have equal numbers, others differ. NULL is a value of its own."""
    keys = df.select(*[F.col(f"`{c}`").alias(f"k{n}") for n, c in enumerate(cols)])
    whole = [c for c in keys.columns if isinstance(keys.schema[c].dataType, IntegralType)]
    ends = keys.agg(*[f(c).cast("decimal(20,0)").alias(f"{f.__name__}_{c}") for c in whole for f in (F.min, F.max)],
                    F.count(F.lit(1)).alias("rows")).first()
    digits: list[tuple[Column, int]] = []
    for n, c in enumerate(keys.columns):
        low, high = (ends[f"min_{c}"], ends[f"max_{c}"]) if c in whole else (None, None)
        if c in whole and (low is None or high - low < DIRECT_SPAN):
            size = 1 if low is None else int(high - low) + 2
            digits.append((F.coalesce(F.col(c).cast("long") - F.lit(int(low or 0)) + 1, F.lit(0)), size))
            continue
        numbers, size = dictionary(keys, c, f"{path}/k{n}")
        keys = keys.join(sized_broadcast(numbers.select(F.col("value").alias(c), F.col("number").alias(f"n{n}"))), c, "left")
        digits.append((F.coalesce(F.col(f"n{n}"), F.lit(0)), size + 1))
    place, space = F.lit(0).cast("long"), 1
    for digit, size in digits:
        place, space = place * F.lit(size).cast("long") + digit, space * size
    if space >= 1 << 62:
        raise ValueError(f"keys of {list(cols)} have {space} possible values, too many for one number")
    return keys.select(place.alias(as_))


def bitmap_distinct(numbers: DataFrame, column: str = "key_number") -> DataFrame:
    """One row: ``rows`` and ``distinct_keys`` of a column of whole numbers from 0."""
    bits = (numbers.groupBy(F.bitmap_bucket_number(column).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(column)).alias("bits"), F.count(F.lit(1)).alias("rows")))
    return bits.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                    F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("distinct_keys"))


def check_unique_key_bitmap(df: DataFrame, cols: Sequence[str], path: str) -> DataFrame:
    """``count(*) = count(distinct key)``, as ``check_unique_key``, by bitmaps.

    Pays where keys fill their space well and come sorted, as in fact tables
    clustered by their first key: a task then ships a few bitmaps of 4 KB. Put
    the key that the table is sorted by first. ``df`` is read once for the
    ends of whole-number columns, once for each dictionary and once for the bits, so
    pass a written table; dictionaries are written below ``path``.
    """
    return bitmap_distinct(numbered(df, cols, path)).withColumn("passed", F.col("rows") == F.col("distinct_keys"))
