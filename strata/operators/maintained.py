"""Aggregates kept up to date from added and retracted rows (A1-A3, A5).

A group's state is mergeable: rows, values, their sum and sum of squares as
decimals (so a retraction cancels exactly what was added), minimum and
maximum; an aggregate that reports no deviation, or no extremes, keeps NULL for
them. Only a group whose minimum or maximum was taken away, and not
reached again by an added row, is looked up in the facts once more.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path
from ..sources.buckets import BucketedTable, one_file_a_bucket
from .joins import sized_broadcast

EXACT = "decimal(38,9)"


def _values(value: str) -> tuple[Column, Column]:
    """A value and its square as exact decimals."""
    x = F.col(value).cast("double")
    return F.col(value).cast(EXACT), (x * x).cast(EXACT)


def delta_of(changes: DataFrame, by: Sequence[str], value: str, extreme: str, squares: bool = True) -> DataFrame:
    """What ``changes`` (facts with ``change`` 1 or -1) do to each group, combined in map tasks."""
    x, square = _values(value)
    square = square if squares else F.lit(0).cast(EXACT)
    e, sign = F.col(extreme).cast("double"), F.col("change")
    added, gone = F.when(sign > 0, e), F.when(sign < 0, e)
    return changes.groupBy(*by).agg(
        F.sum(sign).alias("d_rows"), F.sum(F.when(F.col(value).isNotNull(), sign).otherwise(0)).alias("d_values"),
        F.coalesce(F.sum(x * sign), F.lit(0)).cast(EXACT).alias("d_total"),
        F.coalesce(F.sum(square * sign), F.lit(0)).cast(EXACT).alias("d_squares"),
        F.min(added).alias("added_least"), F.max(added).alias("added_most"),
        F.min(gone).alias("gone_least"), F.max(gone).alias("gone_most"))


def _same_group(by: Sequence[str], left: str, right: str) -> Column:
    same = F.lit(True)
    for c in by:
        same = same & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return same


def applied(state: DataFrame, delta: DataFrame, by: Sequence[str]) -> DataFrame:
    """Every group of ``state`` and ``delta`` after the change, with ``recheck`` where an extreme may be gone.

    ``state`` holds the groups that may be concerned; others pass through.
    """
    s, d = state.alias("s"), delta.alias("d")
    both = s.join(d, _same_group(by, "s", "d"), "full_outer")
    zero = F.lit(0).cast(EXACT)
    col = lambda name: F.col(f"s.{name}")
    num = lambda name, d_name, none: F.coalesce(col(name), none) + F.coalesce(F.col(f"d.{d_name}"), none)
    has_delta = F.col("d.d_rows").isNotNull()
    lost_least = (F.col("d.gone_least") <= col("least")) & ~F.coalesce(F.col("d.added_least") <= col("least"), F.lit(False))
    lost_most = (F.col("d.gone_most") >= col("most")) & ~F.coalesce(F.col("d.added_most") >= col("most"), F.lit(False))
    return both.select(
        *[F.when(has_delta, F.col(f"d.{c}")).otherwise(col(c)).alias(c) for c in by],
        num("rows", "d_rows", F.lit(0).cast("long")).alias("rows"), num("values", "d_values", F.lit(0).cast("long")).alias("values"),
        num("total", "d_total", zero).cast(EXACT).alias("total"), num("squares", "d_squares", zero).cast(EXACT).alias("squares"),
        F.least(col("least"), F.col("d.added_least")).alias("least"), F.greatest(col("most"), F.col("d.added_most")).alias("most"),
        (F.coalesce(lost_least, F.lit(False)) | F.coalesce(lost_most, F.lit(False))).alias("recheck"),
    ).where("rows > 0")


def with_extremes(groups: DataFrame, facts: DataFrame, by: Sequence[str], extreme: str) -> DataFrame:
    """``groups`` with minimum and maximum taken from ``facts`` where ``recheck`` is set."""
    asked = groups.where("recheck").select(*[F.col(c).alias(f"__{c}") for c in by])
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    v = F.col(extreme).cast("double")
    found = (facts.join(sized_broadcast(asked), same, "left_semi").groupBy(*by)
             .agg(F.min(v).alias("__least"), F.max(v).alias("__most")))
    g, f = groups.alias("g"), found.alias("f")
    return g.join(f, F.col("g.recheck") & _same_group(by, "g", "f"), "left").select(
        *[F.col(f"g.{c}") for c in by], "g.rows", "g.values", "g.total", "g.squares",
        F.when(F.col("g.recheck"), F.col("f.__least")).otherwise(F.col("g.least")).alias("least"),
        F.when(F.col("g.recheck"), F.col("f.__most")).otherwise(F.col("g.most")).alias("most"))


def cut(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a table in the shared folder: worked out once, and read again after a lost executor."""
    path = scratch_path(df.sparkSession, f"maintained-{purpose}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def state_schema(by: Mapping[str, str]) -> StructType:
    """Schema of the states of groups by the named, typed columns."""
    return StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in by.items())
                              + f", rows bigint, values bigint, total {EXACT}, squares {EXACT}, least double, most double")


@dataclass(frozen=True)
class MaintainedAggregate:
    """Group states in buckets by group, brought forward one batch of changes at a time."""
    table: BucketedTable
    by: tuple[str, ...]
    value: str
    facts: Callable[[DataFrame], DataFrame]  # silver rows (or changes) -> the facts that are aggregated
    extreme: str | None = None               # column of minimum and maximum; the value itself if none
    extremes: bool = True                    # whether minimum and maximum are kept; without them facts are never read again
    squares: bool = True                     # whether the sum of squares is kept

    def apply(self, changes: DataFrame, silver: Callable[[], DataFrame], batch: int) -> bool:
        """Applies silver ``changes``; ``silver`` gives all rows after them. False if the batch was applied before.

        Only the buckets of changed groups are read and written.
        """
        if batch <= self.table.last():
            return False
        delta = self.table.with_bucket(delta_of(self.facts(changes), self.by, self.value, self.extreme or self.value, self.squares))
        delta = cut(delta, "delta")
        touched = self.table.touched(delta)
        after = applied(self.table.read(touched).drop("bucket"), delta.drop("bucket"), self.by)
        if not self.squares:
            after = after.withColumn("squares", F.lit(None).cast(EXACT))
        if not self.extremes:  # each group once, from both sides: nothing more to look up
            after = after.withColumns({c: F.lit(None).cast("double") for c in ("least", "most")})
            return self.table.replace(one_file_a_bucket(self.table.with_bucket(after)), touched, batch)
        after = cut(after, "after")
        if not after.where("recheck").isEmpty():
            after = with_extremes(after, self.facts(silver()), self.by, self.extreme or self.value)
        return self.table.replace(one_file_a_bucket(self.table.with_bucket(after)), touched, batch)

    def state(self) -> DataFrame:
        return self.table.read().drop("bucket")


def value_summary(state: DataFrame, by: Sequence[str]) -> DataFrame:
    """The columns of the full quarterly and annual aggregates."""
    return state.select(*by, (F.col("total").cast("double") / F.col("values")).alias("avg_value"),
                        F.col("least").alias("min_value"), F.col("most").alias("max_value"), F.col("rows").alias("series_count"))


def sums(state: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    return state.select(*by, F.when(F.col("values") > 0, F.col("total").cast("double")).alias(name))


def deviation(state: DataFrame) -> Column:
    """Population standard deviation from a state's sums."""
    n, total = F.col("values"), F.col("total").cast("double")
    return F.when(n > 0, F.sqrt(F.greatest(F.lit(0.0), F.col("squares").cast("double") / n - (total / n) * (total / n))))
