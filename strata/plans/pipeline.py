"""The medallion run: landed text -> bronze -> silver -> gold.

Each layer is written to the shared output folder and the next layer reads
the written files, so lineage is cut at every layer: a lost executor only
recomputes tasks of the layer being written, and a failed run restarts from
the last written layer (bronze streams resume from their checkpoints).

usage: python -m strata.plans.pipeline <landing_dir> <out_dir>
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators.quality import all_rules_pass, rule_passes
from ..sources import sinks
from ..streaming import ingest
from . import gold, specs
from .silver import build_silver

GOLD_CLUSTER = ("period_type", "year", "series_id")
EXPECTATION_SCHEMA = "table_name string, rule string, failed long, rows_in long, rows_out long"


def _keep(df: DataFrame, table: str, path: str, comment: str, layer: str, cluster_by: tuple[str, ...] = (),
          laid_out: bool = False) -> DataFrame:
    """Write one table with its comment, layer and column comments; return a read of its files."""
    described = sinks.annotate_columns(df, specs.COLUMN_COMMENTS)
    sinks.write_table(described, table, path, comment=comment, properties={"quality": layer},
                      cluster_by=cluster_by, laid_out=laid_out)
    return df.sparkSession.read.parquet(path)


def _write_gated(df: DataFrame, spec, obs: Observation, table: str, path: str) -> DataFrame:
    """Gate, cluster and write one silver table while observing its rules.

    Rule results are computed before the range exchange and observed above
    it: the exchange's sampling job runs the plan below it, so an observation
    placed there would count rows twice.
    """
    marked = df.withColumn("_pass", all_rules_pass(spec.rules))
    ranged = sinks.clustered(marked, spec.cluster_by)
    observed = ranged.observe(obs, F.count(F.lit(1)).alias("rows_in"),
                              F.count_if(F.col("_pass")).alias("rows_out"),
                              *[F.count_if(~rule_passes(e)).alias(f"failed_{n}") for n, e in spec.rules.items()])
    return _keep(observed.where(F.col("_pass")).drop("_pass"), table, path, spec.comment, "silver", spec.cluster_by,
                 laid_out=True)


def run(spark: SparkSession, landing: str, out: str, gate_first: bool = False,
        max_files_per_trigger: int | None = ingest.DEFAULT_MAX_FILES_PER_TRIGGER,
        prefix: str = "strata") -> dict[str, DataFrame]:
    """Run all layers; silver and gold tables are registered as ``<prefix>_<layer>_<name>``."""
    out = out.rstrip("/")
    bronze = ingest.ingest_all(spark, landing, f"{out}/bronze",
                               max_files_per_trigger=max_files_per_trigger)
    silver: dict[str, DataFrame] = {}
    metrics = []
    for spec in specs.ALL:
        obs = Observation(f"expectations_{spec.name}")
        silver[spec.name] = _write_gated(build_silver(bronze[spec.bronze], spec, gate_first=gate_first,
                                                      gate=False),
                                         spec, obs, f"{prefix}_silver_{spec.name}", f"{out}/silver/{spec.name}")
        m = obs.get                                   # filled by the write above
        metrics += [(spec.name, rule, int(m.get(f"failed_{rule}", 0)), int(m["rows_in"]), int(m["rows_out"]))
                    for rule in spec.rules]
    # one row per (table, rule): the expectation log of the run (a few dozen rows)
    spark.createDataFrame(metrics, EXPECTATION_SCHEMA).write.mode("overwrite").parquet(f"{out}/_expectations")
    wide = _keep(gold.gold_wide(silver), f"{prefix}_gold_wide", f"{out}/gold/wide", specs.GOLD_COMMENTS["wide"], "gold",
                 GOLD_CLUSTER)
    population = silver["lookup_population"]
    outputs = {
        "quarterly": gold.gold_quarterly(wide),
        "annual": gold.gold_annual(wide),
        "best_year": gold.gold_best_year(wide),
        "population_stats": gold.gold_population_stats(population),
        "q01_population": gold.gold_q01_population(wide, population),
    }
    result = {f"silver_{k}": v for k, v in silver.items()}
    result["expectations"] = spark.read.parquet(f"{out}/_expectations")
    result["gold_wide"] = wide
    for name, df in outputs.items():
        result[f"gold_{name}"] = _keep(df, f"{prefix}_gold_{name}", f"{out}/gold/{name}", specs.GOLD_COMMENTS[name], "gold")
    return result


def main(argv: list[str]) -> None:
    from ..session import build_session
    if len(argv) != 2:
        raise SystemExit(__doc__)
    spark = build_session(app="strata-pipeline")
    for name, df in run(spark, argv[0], argv[1]).items():
        print(name, df.count())


if __name__ == "__main__":
    main(sys.argv[1:])
