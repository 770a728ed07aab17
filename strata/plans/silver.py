"""Silver tables: rename -> clean -> upper-case -> type -> dedup -> gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from ..functions.strings import blank_to_null
from ..operators.dedup import deduplicate
from ..operators.quality import all_rules_pass, expect_all_or_drop
from ..sources import fixtures
from . import specs
from .specs import TableSpec


def _order(spec: TableSpec):
    cols = []
    for c, direction in spec.order:
        col = F.col(c)
        cols.append(col.desc_nulls_last() if direction == "desc" else col.asc_nulls_last())
    return cols


def typed(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """rename -> clean -> upper-case -> type, fused into ONE projection."""
    cols = {}
    for f in raw.schema.fields:
        name = spec.rename.get(f.name, f.name)
        e = F.col(f"`{f.name}`")
        if isinstance(f.dataType, StringType):
            e = blank_to_null(e)
        if name in spec.upper:
            e = F.upper(e)
        cols[name] = e
    if spec.typer is not None:
        cols = spec.typer(cols)
    return raw.select(*[e.alias(n) for n, e in cols.items()])


def preference(spec: TableSpec) -> dict:
    """How the spec chooses among rows of one key, as arguments of ``deduplicate``."""
    column, value = spec.prefer if spec.prefer else (None, None)
    return {"tiebreak_col": column, "prefer_value": value, "order_by": _order(spec)}


def winners(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """One typed row per key, the preferred one."""
    return deduplicate(rows, spec.key, **preference(spec))


def derived(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Adds the columns that the key decides: made for the survivors only, so they are neither shuffled nor sorted."""
    if spec.derived is None:
        return rows
    return rows.select(*[e.alias(n) for n, e in spec.derived({c: F.col(f"`{c}`") for c in rows.columns}).items()])


def build_silver(raw: DataFrame, spec: TableSpec, gate_first: bool = False,
                 gate: bool = True) -> DataFrame:
    """The silver recipe for any spec.

    By default the quality gate runs after dedup (a preferred row that fails
    the gate removes its key); ``gate_first=True`` gates before dedup so the
    best *valid* row survives instead. ``gate=False`` returns the rows that
    reach the (post-dedup) gate, for callers that gate themselves.
    """
    df = typed(raw, spec)
    if gate_first:
        return derived(winners(expect_all_or_drop(df, spec.rules), spec), spec)
    if not gate or not spec.rules:
        return derived(winners(df, spec), spec)
    if spec.derived is not None:
        # the rules as one predicate: it reads more than the key, so Catalyst keeps it above the window
        return derived(expect_all_or_drop(winners(df, spec), spec.rules, split=False), spec)
    # Rules are evaluated once, inside the projection above, and applied to the
    # dedup survivors. (A plain filter after the window would be pushed by
    # Catalyst below the window for its key-only rules, re-deriving the cleaned
    # keys from raw columns a second time just to filter.)
    marked = df.withColumn("_pass", all_rules_pass(spec.rules))
    return winners(marked, spec).where(F.col("_pass")).drop("_pass")


RAW_BUILDERS = {
    "data": fixtures.raw_data,
    "series": fixtures.raw_series,
    "lookup_measure": fixtures.raw_measure,
    "lookup_sector": fixtures.raw_sector,
    "lookup_class": fixtures.raw_class,
    "lookup_duration": fixtures.raw_duration,
    "lookup_footnote": fixtures.raw_footnote,
    "lookup_period": fixtures.raw_period,
    "lookup_seasonal": fixtures.raw_seasonal,
    "lookup_population": fixtures.raw_population,
}


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return RAW_BUILDERS[name](spark, sf_dir)


def silver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Silver table ``name`` built from the raw frames derived from ``sf_dir``."""
    return build_silver(raw_table(spark, sf_dir, name), specs.BY_NAME[name])


def silver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {s.name: silver_table(spark, sf_dir, s.name) for s in specs.ALL}
