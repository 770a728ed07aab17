"""Gold aggregates that follow the incremental silver tables batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import aggregates, joins, maintained
from ..operators.maintained import MaintainedAggregate, state_schema
from ..operators.quality import expect_all_or_drop
from ..sources.buckets import BucketedTable
from ..streaming import incremental
from . import specs

_SECTOR_MEASURE = {c: "string" for c in aggregates.SECTOR_MEASURE}
QUARTERLY = {**_SECTOR_MEASURE, "year": "int", "period": "string", "period_num": "int"}
ANNUAL = {**_SECTOR_MEASURE, "year": "int"}
ANNUAL_SUMS = {"series_id": "string", "series_label": "string", "year": "int"}
POPULATION = {"nation_id": "string", "nation": "string"}


def _aggregate(spark: SparkSession, root: str, by: Mapping[str, str], value: str, facts: Callable[[DataFrame], DataFrame],
               buckets: int, extreme: str | None = None, **kept: bool) -> MaintainedAggregate:
    table = BucketedTable(spark, root, tuple(by), state_schema(by), buckets)
    return MaintainedAggregate(table, tuple(by), value, facts, extreme, **kept)


class ProductivityGold:
    """Quarterly and annual aggregates and annual sums over an incremental fact; dimensions are given and fixed.

    The series are enriched and written once, so a batch's changes meet one
    dimension and the periods. A changed dimension moves facts between
    groups: build the aggregates anew then.
    """

    def __init__(self, spark: SparkSession, root: str, dimensions: Mapping[str, DataFrame], buckets: int = 16):
        path = f"{root}/dimensions/enriched"
        joins.enriched_series(dimensions["series"], *[dimensions[f"lookup_{n}"] for n in (
            "measure", "sector", "class", "duration", "seasonal")]).write.mode("overwrite").parquet(path)
        self.enriched = spark.read.parquet(path)
        dimensions["lookup_period"].write.mode("overwrite").parquet(f"{root}/dimensions/period")
        self.period = spark.read.parquet(f"{root}/dimensions/period")

        def of(kind: str):
            return lambda facts: aggregates.of_kind(facts, kind)

        self.quarterly = _aggregate(spark, f"{root}/gold/quarterly", QUARTERLY, "value", of("quarterly"), buckets, squares=False)
        self.annual = _aggregate(spark, f"{root}/gold/annual", ANNUAL, "value", of("annual"), buckets, squares=False)
        self.annual_sums = _aggregate(spark, f"{root}/gold/annual_sums", ANNUAL_SUMS, "value", of("quarterly"), buckets,
                                      extremes=False, squares=False)

    def wide(self, facts: DataFrame) -> DataFrame:
        kept = expect_all_or_drop(facts, specs.WIDE_RULES, split=False)
        return joins.with_series_and_period(kept, joins.sized_broadcast(self.enriched), self.period)

    def follow(self, table: BucketedTable, batch: int) -> None:
        asked = dict.fromkeys((*QUARTERLY, *ANNUAL, *ANNUAL_SUMS, "period_type", "value", "change"))
        changed = maintained.cut(self.wide(incremental.changes(table, specs.DATA, batch)).select(*asked), "changes")
        for one in (self.quarterly, self.annual, self.annual_sums):
            one.apply(changed, lambda: self.wide(incremental.silver(table, specs.DATA)), batch)

    def tables(self) -> dict[str, DataFrame]:
        """The aggregates as the full ones give them."""
        return {"quarterly": maintained.value_summary(self.quarterly.state(), tuple(QUARTERLY)),
                "annual": maintained.value_summary(self.annual.state(), tuple(ANNUAL)),
                "annual_sums": maintained.sums(self.annual_sums.state(), tuple(ANNUAL_SUMS), "annual_sum")}


class PopulationGold:
    """Population statistics per nation over an incremental population table."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 4):
        self.stats = _aggregate(spark, f"{root}/gold/population", POPULATION, "population", lambda facts: facts, buckets, "year")

    def follow(self, table: BucketedTable, batch: int) -> None:
        self.stats.apply(incremental.changes(table, specs.POPULATION, batch),
                         lambda: incremental.silver(table, specs.POPULATION), batch)

    def table(self) -> DataFrame:
        state = self.stats.state()
        return state.select(*POPULATION, (F.col("total").cast("double") / F.col("values")).alias("mean_population"),
                            maintained.deviation(state).alias("stddev_population"), F.col("least").cast("int").alias("year_from"),
                            F.col("most").cast("int").alias("year_to"), F.col("rows").alias("year_count"))
