"""Registered queries: one Spark plan per operator/table, each paired with
its DuckDB oracle SQL (see ``oracle.py``).

Every query reads the analytic tables (or data Spark derives from them) in
full. Results whose doubles depend on summation order are rounded (same
digits in the oracle) so independent engines can be compared by value.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.labels import series_label
from ..functions.strings import clean_strings, rename_columns, to_upper
from ..functions.typing_rules import schema_data, schema_population, schema_series
from ..operators import aggregates, bitmaps, dedup, joins, quality, quarantine, ranking, reconcile
from ..session import scratch_path, session_key
from ..sizing import estimated_bytes
from ..sources import colocated, fixtures, layout, manifest, sinks, tsv
from ..streaming import incremental, ingest
from . import ask, ask_sql, gold, gold_sql, maintained_gold, oracle, silver, specs
from .oracle import sround, with_ctes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rounded(df: DataFrame, **digits: int) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), d) for c, d in digits.items()})


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ---- shared builders (lazy plans) ----------------------------------------------

# Lazy plans shared by many queries are built once per session and input
# folder (plans only, no data); clear_plan_cache() after the inputs change.
_PLANS: dict[tuple, DataFrame] = {}


def clear_plan_cache() -> None:
    from ..sources.tables import clear_scan_cache
    _PLANS.clear()
    fixtures.clear_frame_cache()
    clear_scan_cache()


def _memo(spark, sf, name, build):
    key = (session_key(spark), sf.rstrip("/"), name)
    df = _PLANS.get(key)
    if df is None:
        df = _PLANS[key] = build()
    return df


def _silver(spark, sf, name):
    return _memo(spark, sf, f"silver:{name}", lambda: silver.silver_table(spark, sf, name))


class _SilverTables(dict):
    """Silver tables built on first access only."""

    def __init__(self, spark, sf):
        super().__init__()
        self._spark, self._sf = spark, sf

    def __missing__(self, name):
        df = self[name] = _silver(self._spark, self._sf, name)
        return df


def _silver_all(spark, sf):
    return _SilverTables(spark, sf)


def _wide(spark, sf):
    return _memo(spark, sf, "gold:wide", lambda: gold.gold_wide(_silver_all(spark, sf)))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _typed_fact(spark, sf):
    raw = fixtures.raw_data(spark, sf)
    return schema_data(to_upper(clean_strings(raw), *specs.DATA.upper))


def _listing(spark, sf):
    return manifest.parse_listing(fixtures.listing_html(spark, sf), keep=("page_id",))


def _pending(spark, sf):
    entries = _listing(spark, sf)
    state = fixtures.manifest_state(spark, sf, entries)
    return manifest.manifest_pending(entries, state), state


def _trimmed_sql(cte: str, cols) -> str:
    return with_ctes(f"SELECT {', '.join(f'{oracle.c(x)} AS {x}' for x in cols)} FROM {cte}", cte)


# ---- sources and sinks (S1–S17, B1–B10) --------------------------------------------

_BRONZE_COUNTS_SQL = with_ctes(" UNION ALL ".join(
    f"SELECT '{s.bronze}' AS table_name, count(*) AS rows FROM {s.bronze}" for s in specs.ALL),
    *[s.bronze for s in specs.ALL])


@register("bronze_stream_ingest", _BRONZE_COUNTS_SQL)
def bronze_stream_ingest(spark, sf):
    """All ten bronze tables landed as text and ingested by availableNow streams."""
    root = scratch_path(spark, "bronze-ingest")
    ingest.land_all(spark, sf, f"{root}/landing")
    tables = ingest.ingest_all(spark, f"{root}/landing", f"{root}/bronze")
    frames = [df.select(F.lit(name).alias("table_name")) for name, df in tables.items()]
    return _union(frames).groupBy("table_name").agg(F.count(F.lit(1)).alias("rows"))


@register("bronze_incremental_once", _trimmed_sql("raw_data", specs.DATA.raw_columns))
def bronze_incremental_once(spark, sf):
    """Files landing in two waves plus an idle run: every line ingested exactly once."""
    root = scratch_path(spark, "bronze-incremental")
    landing, bronze = f"{root}/landing", f"{root}/bronze"
    raw = fixtures.raw_data(spark, sf)
    early = F.coalesce(F.col("year") < "1998", F.lit(False))
    ingest.land(spark, raw.where(early), specs.DATA, landing)
    ingest.ingest(spark, specs.DATA, landing, bronze)
    ingest.land(spark, raw.where(~early), specs.DATA, landing)
    ingest.ingest(spark, specs.DATA, landing, bronze)
    return ingest.ingest(spark, specs.DATA, landing, bronze)


@register("source_positional_schema", _trimmed_sql("raw_population", specs.POPULATION.raw_columns))
def source_positional_schema(spark, sf):
    """Header names differ from the schema and an extra field trails: columns map by position."""
    root = scratch_path(spark, "positional")
    raw = fixtures.raw_population(spark, sf)
    headed = raw.select(F.col("nation_id").alias("Nation ID"), F.col("nation").alias("Nation"),
                        F.col("year").alias("Year"), F.col("population").alias("Population"),
                        F.lit("derived").alias("Source"))
    tsv.write_tsv(headed, f"{root}/enrichment")
    return tsv.read_tsv(spark, f"{root}/enrichment", specs.POPULATION.raw_columns)


@register("source_glob_filter", _trimmed_sql("raw_measure", specs.MEASURE.raw_columns))
def source_glob_filter(spark, sf):
    """Several lookup files share one folder; the name filter picks one."""
    root = scratch_path(spark, "glob")
    ingest.land_all(spark, sf, root, tables=(*specs.LOOKUPS, specs.POPULATION))
    return tsv.read_tsv(spark, f"{root}/enrichment", specs.MEASURE.raw_columns, glob=specs.MEASURE.file_name)


@register("sink_table_with_comment", with_ctes("SELECT * FROM s_data", "s_data"))
def sink_table_with_comment(spark, sf):
    path = scratch_path(spark, "table-silver-data")
    name = "strata_silver_data_" + path.rsplit("-", 1)[-1]
    return sinks.write_table(_silver(spark, sf, "data"), name, path, comment=specs.DATA.comment,
                             properties={"quality": "silver"}, cluster_by=specs.DATA.cluster_by)


@register("sink_clustered", with_ctes("SELECT * FROM wide", "wide"))
def sink_clustered(spark, sf):
    return sinks.write_clustered(_wide(spark, sf), scratch_path(spark, "wide-clustered"),
                                 ("period_type", "year", "series_id"))


@register("annotate_columns", with_ctes("SELECT * FROM s_series", "s_series"))
def annotate_columns(spark, sf):
    return sinks.annotate_columns(_silver(spark, sf, "series"), specs.COLUMN_COMMENTS)


@register("annotate_gold_columns", with_ctes("SELECT * FROM wide", "wide"))
def annotate_gold_columns(spark, sf):
    return sinks.annotate_columns(_wide(spark, sf), specs.COLUMN_COMMENTS)


_JSON_SQL = """
WITH counts AS (
  SELECT c_nationkey, year(o_orderdate) AS y, c_mktsegment, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3),
docs AS (
  SELECT c.*, CASE WHEN c_nationkey % 4 = 3 THEN NULL ELSE n_name END AS nation_name,
         CAST(c_nationkey * 10000 + y AS INTEGER) AS payload_id
  FROM counts c JOIN nation ON c_nationkey = n_nationkey)
SELECT DISTINCT payload_id, 0 AS line_no,
       'Segment' || chr(9) || 'Orders' || chr(9) || 'Nation' || chr(9) || 'Year' AS line FROM docs
UNION ALL
SELECT payload_id, CAST(row_number() OVER (PARTITION BY payload_id ORDER BY c_mktsegment) AS INTEGER),
       c_mktsegment || chr(9) || CAST(n AS VARCHAR) || chr(9) || coalesce(nation_name, '') || chr(9) || CAST(y AS VARCHAR)
FROM docs"""


@register("json_records_to_rows", _JSON_SQL)
def json_records_to_rows(spark, sf):
    return manifest.json_records_to_rows(fixtures.json_record_payloads(spark, sf))


@register("parse_listing", with_ctes("SELECT * FROM listing_expected", "listing_expected"))
def parse_listing(spark, sf):
    return _listing(spark, sf)


_CLASSIFY_SQL = with_ctes("""
SELECT *, CASE page_id % 6 WHEN 0 THEN 'current' WHEN 1 THEN 'backfill' WHEN 2 THEN 'series'
                           WHEN 3 THEN NULL ELSE 'enrichment' END AS category
FROM listing_expected""", "listing_expected")


@register("classify_files", _CLASSIFY_SQL)
def classify_files(spark, sf):
    return manifest.classify_files(_listing(spark, sf))


@register("manifest_pending", with_ctes("SELECT * FROM pending", "pending"))
def manifest_pending(spark, sf):
    return _pending(spark, sf)[0]


_UPSERT_SQL = with_ctes("""
SELECT url, last_modified FROM (
  SELECT url, last_modified, row_number() OVER (PARTITION BY url ORDER BY b DESC) AS rn
  FROM (SELECT url, last_modified, 0 AS b FROM manifest_state
        UNION ALL SELECT url, last_modified, 1 FROM pending)) WHERE rn = 1""", "manifest_state", "pending")


@register("manifest_upsert", _UPSERT_SQL)
def manifest_upsert(spark, sf):
    pending, state = _pending(spark, sf)
    return manifest.manifest_upsert(state, pending.select("url", "last_modified"))


_CHANGED_SQL = """
WITH stored AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN sha256(text) ELSE sha256(text || '#') END AS digest
                FROM documents)
SELECT d.doc_id, sha256(d.text) AS digest FROM documents d LEFT JOIN stored s ON d.doc_id = s.doc_id
WHERE s.digest IS NULL OR s.digest <> sha256(d.text)"""


@register("content_changed", _CHANGED_SQL)
def content_changed(spark, sf):
    from ..sources.tables import table
    return manifest.content_changed(table(spark, sf, "documents"), fixtures.stored_digests(spark, sf))


def _bronze_one(spark, sf, spec) -> DataFrame:
    root = scratch_path(spark, f"bronze-{spec.bronze}")
    ingest.land(spark, silver.raw_table(spark, sf, spec.name), spec, f"{root}/landing")
    return ingest.ingest(spark, spec, f"{root}/landing", f"{root}/bronze")


@register("bronze_raw_data", _trimmed_sql("raw_data", specs.DATA.raw_columns))
def bronze_raw_data(spark, sf):
    return _bronze_one(spark, sf, specs.DATA)


@register("bronze_raw_series", _trimmed_sql("raw_series", specs.SERIES.raw_columns))
def bronze_raw_series(spark, sf):
    return _bronze_one(spark, sf, specs.SERIES)


_LOOKUPS_SQL = with_ctes(" UNION ALL ".join(
    f"SELECT '{s.bronze}' AS table_name, {oracle.c(s.raw_columns[0])} AS code, "
    f"{oracle.c(s.raw_columns[1])} AS text FROM {s.bronze}" for s in specs.LOOKUPS),
    *[s.bronze for s in specs.LOOKUPS])


@register("bronze_lookups", _LOOKUPS_SQL)
def bronze_lookups(spark, sf):
    """(table, code, text) of the seven lookup tables, each streamed from its named file."""
    root = scratch_path(spark, "bronze-lookups")
    ingest.land_all(spark, sf, f"{root}/landing", tables=specs.LOOKUPS)
    tables = ingest.ingest_all(spark, f"{root}/landing", f"{root}/bronze", tables=specs.LOOKUPS)
    return _union([tables[s.bronze].select(F.lit(s.bronze).alias("table_name"), F.col(s.raw_columns[0]).alias("code"),
                                           F.col(s.raw_columns[1]).alias("text")) for s in specs.LOOKUPS])


@register("bronze_raw_population", _trimmed_sql("raw_population", specs.POPULATION.raw_columns))
def bronze_raw_population(spark, sf):
    return _bronze_one(spark, sf, specs.POPULATION)


# ---- projections (P1–P8) -------------------------------------------------------

@register("clean_strings", with_ctes("SELECT * FROM data_clean", "data_clean"))
def q_clean_strings(spark, sf):
    return clean_strings(fixtures.raw_data(spark, sf))


@register("to_upper", with_ctes("SELECT * FROM data_upper", "data_upper"))
def q_to_upper(spark, sf):
    return to_upper(clean_strings(fixtures.raw_data(spark, sf)), *specs.DATA.upper)


@register("schema_data", with_ctes("SELECT * FROM data_typed", "data_typed"))
def q_schema_data(spark, sf):
    return _typed_fact(spark, sf)


@register("schema_series", with_ctes("SELECT * FROM series_typed", "series_typed"))
def q_schema_series(spark, sf):
    raw = fixtures.raw_series(spark, sf)
    return schema_series(to_upper(clean_strings(raw), *specs.SERIES.upper))


_POP_TYPED_SQL = with_ctes(f"""
SELECT {oracle.cu('nation_id')} AS nation_id, {oracle.c('nation')} AS nation,
       TRY_CAST({oracle.c('year')} AS INTEGER) AS year,
       TRY_CAST(trunc(TRY_CAST({oracle.c('population')} AS DOUBLE)) AS BIGINT) AS population
FROM raw_population""", "raw_population")


@register("schema_population", _POP_TYPED_SQL)
def q_schema_population(spark, sf):
    raw = fixtures.raw_population(spark, sf)
    return schema_population(to_upper(clean_strings(raw), *specs.POPULATION.upper))


@register("rename_columns", with_ctes(
    "SELECT Seasonal_code AS seasonal_code, Seasonal_text AS seasonal_text FROM raw_seasonal", "raw_seasonal"))
def q_rename_columns(spark, sf):
    return rename_columns(fixtures.raw_seasonal(spark, sf), specs.SEASONAL.rename)


_LABEL_SQL = with_ctes(f"""
SELECT series_id, {oracle.LABEL} AS series_label FROM (
  SELECT s.series_id, sc.sector_name, m.measure_text, du.duration_text, s.seasonal
  FROM s_series s
  LEFT JOIN s_sector sc ON s.sector_code = sc.sector_code
  LEFT JOIN s_measure m ON s.measure_code = m.measure_code
  LEFT JOIN s_duration du ON s.duration_code = du.duration_code) t""",
    "s_series", "s_sector", "s_measure", "s_duration")


@register("series_label", _LABEL_SQL)
def q_series_label(spark, sf):
    """Label of every series in the dimension (orphan codes get 'Unknown …')."""
    s = _silver_all(spark, sf)
    df = s["series"].select("series_id", "sector_code", "measure_code", "duration_code", "seasonal")
    for dim, key, text in ((s["lookup_sector"], "sector_code", "sector_name"),
                           (s["lookup_measure"], "measure_code", "measure_text"),
                           (s["lookup_duration"], "duration_code", "duration_text")):
        df = df.join(joins.sized_broadcast(dim.select(key, text)), key, "left")
    return df.select("series_id", series_label(F.col("sector_name"), F.col("measure_text"),
                                               F.col("duration_text"), F.col("seasonal")).alias("series_label"))


# ---- filters and quality gates (F1–F7, E1–E3) ----------------------------------------

@register("filter_year_between", with_ctes("SELECT * FROM s_data WHERE year BETWEEN 1996 AND 1999", "s_data"))
def filter_year_between(spark, sf):
    return _silver(spark, sf, "data").where(F.col("year").between(1996, 1999))


@register("filter_period_rlike", with_ctes(
    "SELECT * FROM data_typed WHERE regexp_matches(period, '^(Q0[1-5]|A01)$')", "data_typed"))
def filter_period_rlike(spark, sf):
    return _typed_fact(spark, sf).where(F.col("period").rlike(r"^(Q0[1-5]|A01)$"))


@register("expect_all_or_drop", with_ctes(f"SELECT * FROM data_typed WHERE {oracle.RULES_DATA}", "data_typed"))
def q_expect_all_or_drop(spark, sf):
    return quality.expect_all_or_drop(_typed_fact(spark, sf), specs.DATA_RULES)


_MEASURE_GATE_SQL = with_ctes(f"""
SELECT * FROM (SELECT {oracle.cu('measure_code')} AS measure_code, {oracle.c('measure_text')} AS measure_text,
       {oracle.c('display_level')} AS display_level, {oracle.cu('selectable')} AS selectable,
       {oracle.c('sort_sequence')} AS sort_sequence FROM raw_measure) t
WHERE measure_code IS NOT NULL""", "raw_measure")


@register("expect_or_drop", _MEASURE_GATE_SQL)
def q_expect_or_drop(spark, sf):
    typed = to_upper(clean_strings(fixtures.raw_measure(spark, sf)), *specs.MEASURE.upper)
    return quality.expect_or_drop(typed, "valid_measure_code", "measure_code IS NOT NULL")


def _failed(expr: str) -> str:
    return f"count(*) FILTER (WHERE NOT coalesce({expr}, false))"


_METRICS_SQL = with_ctes(f"""
SELECT count(*) AS rows_in, count(*) FILTER (WHERE {oracle.RULES_DATA}) AS rows_out,
       {_failed('series_id IS NOT NULL')} AS failed_valid_series_id,
       {_failed('year > 1900')} AS failed_valid_year_range,
       {_failed('value IS NOT NULL')} AS failed_valid_value,
       {_failed("regexp_matches(period, '^(Q0[1-5]|A01)$')")} AS failed_valid_period_format
FROM data_typed""", "data_typed")


@register("expectation_metrics", _METRICS_SQL)
def q_expectation_metrics(spark, sf):
    return quality.expectation_metrics(_typed_fact(spark, sf), specs.DATA_RULES)


# ---- reconciliation (V1–V6) --------------------------------------------------------

_RETENTION_SQL = with_ctes(f"""
SELECT b AS bronze_rows, s AS silver_rows, {sround('s / b', 6)} AS retention, s >= b * 0.95 AS passed
FROM (SELECT (SELECT count(*) FROM raw_data) AS b, (SELECT count(*) FROM s_data) AS s) t""",
    "raw_data", "s_data")


@register("check_retention", _RETENTION_SQL)
def check_retention(spark, sf):
    return reconcile.check_retention(fixtures.raw_data(spark, sf), _silver(spark, sf, "data"))


@register("check_no_growth", with_ctes("""
SELECT s AS silver_rows, w AS wide_rows, w <= s AS passed
FROM (SELECT (SELECT count(*) FROM s_data) AS s, (SELECT count(*) FROM wide) AS w) t""", "s_data", "wide"))
def check_no_growth(spark, sf):
    return reconcile.check_no_growth(_silver(spark, sf, "data"), _wide(spark, sf))


@register("check_null_keys", with_ctes("""
SELECT count(*) AS rows,
       count(*) FILTER (WHERE series_id IS NULL OR year IS NULL OR value IS NULL OR period IS NULL) AS null_key_rows,
       count(*) FILTER (WHERE series_id IS NULL OR year IS NULL OR value IS NULL OR period IS NULL) = 0 AS passed
FROM wide""", "wide"))
def check_null_keys(spark, sf):
    return reconcile.check_null_keys(_wide(spark, sf), ("series_id", "year", "value", "period"))


@register("check_unique_key", with_ctes("""
SELECT count(*) AS rows, count(DISTINCT ROW(series_id, year, period)) AS distinct_keys,
       count(*) = count(DISTINCT ROW(series_id, year, period)) AS passed FROM wide""", "wide"))
def check_unique_key(spark, sf):
    return reconcile.check_unique_key(_wide(spark, sf), ("series_id", "year", "period"))


@register("check_dim_coverage", with_ctes("""
SELECT series_id, count(*) AS rows, min(year) AS year_from, max(year) AS year_to,
       count(*) FILTER (WHERE sector_name IS NULL) AS missing_sector_name,
       count(*) FILTER (WHERE measure_text IS NULL) AS missing_measure_text,
       count(*) FILTER (WHERE duration_text IS NULL) AS missing_duration_text,
       count(*) FILTER (WHERE seasonal IS NULL) AS missing_seasonal,
       count(*) FILTER (WHERE series_label IS NULL) AS missing_series_label
FROM wide WHERE period = 'Q01' GROUP BY series_id""", "wide"))
def check_dim_coverage(spark, sf):
    return reconcile.check_dim_coverage(_wide(spark, sf))


def _q01pop(spark, sf):
    return gold.gold_q01_population(_wide(spark, sf), _silver(spark, sf, "lookup_population"))


@register("check_gap_year", with_ctes("""
SELECT year, count(*) AS rows, count(us_population) AS rows_with_population,
       count(us_population) > 0 AS has_population FROM q01pop GROUP BY year""", "q01pop"))
def check_gap_year(spark, sf):
    return reconcile.check_gap_year(_q01pop(spark, sf))


# ---- joins (J1–J9) -------------------------------------------------------------------

@register("build_wide_table", with_ctes("SELECT * FROM wide_built", "wide_built"))
def build_wide_table(spark, sf):
    s = _silver_all(spark, sf)
    return joins.build_wide_table(s["data"], s["series"], s["lookup_measure"], s["lookup_sector"],
                                  s["lookup_class"], s["lookup_duration"], s["lookup_seasonal"],
                                  s["lookup_period"])


@register("join_series", with_ctes("""
SELECT d.*, s.sector_code, s.class_code, s.measure_code, s.duration_code, s.seasonal
FROM s_data d LEFT JOIN s_series s ON d.series_id = s.series_id""", "s_data", "s_series"))
def join_series(spark, sf):
    return joins.join_series(_silver(spark, sf, "data"), _silver(spark, sf, "series"))


@register("q01_with_population", with_ctes("SELECT * FROM q01pop", "q01pop"))
def q01_with_population(spark, sf):
    return _q01pop(spark, sf)


# ---- aggregations and windows (A1–A5, W1, W2) ------------------------------------------

_AGG_COLS = "sector_code, sector_name, measure_code, measure_text, year"


@register("quarterly_aggregation", with_ctes(f"""
SELECT {_AGG_COLS}, period, period_num, {sround('avg_value', 6)} AS avg_value, min_value, max_value,
       series_count FROM quarterly""", "quarterly"))
def quarterly_aggregation(spark, sf):
    return rounded(gold.gold_quarterly(_wide(spark, sf)), avg_value=6)


@register("annual_aggregation", with_ctes(f"""
SELECT {_AGG_COLS}, {sround('avg_value', 6)} AS avg_value, min_value, max_value, series_count
FROM annual""", "annual"))
def annual_aggregation(spark, sf):
    return rounded(gold.gold_annual(_wide(spark, sf)), avg_value=6)


def _pop_stats_sql(src: str, where: str = "") -> str:
    return with_ctes(f"""
SELECT nation_id, nation, {sround('avg(population)', 6)} AS mean_population,
       {sround('stddev_pop(population)', 2)} AS stddev_population,
       min(year) AS year_from, max(year) AS year_to, count(*) AS year_count
FROM {src} {where} GROUP BY nation_id, nation""", src)


def _pop_by_nation(spark, sf):
    return silver.build_silver(fixtures.raw_population_by_nation(spark, sf), specs.POPULATION)


@register("population_stats", _pop_stats_sql("s_population_by_nation"))
def population_stats(spark, sf):
    return rounded(aggregates.population_stats(_pop_by_nation(spark, sf)),
                   mean_population=6, stddev_population=2)


WINDOW = (1996, 2000)


@register("population_stats_window",
          _pop_stats_sql("s_population", f"WHERE year BETWEEN {WINDOW[0]} AND {WINDOW[1]}"))
def population_stats_window(spark, sf):
    return rounded(gold.gold_population_stats(_silver(spark, sf, "lookup_population"), *WINDOW),
                   mean_population=6, stddev_population=2)


@register("annual_sums", with_ctes(
    f"SELECT series_id, series_label, year, {sround('annual_sum', 6)} AS annual_sum FROM annual_sums",
    "annual_sums"))
def annual_sums(spark, sf):
    return rounded(aggregates.annual_sums(_wide(spark, sf)), annual_sum=6)


@register("deduplicate_prefer", with_ctes("SELECT * FROM data_dedup", "data_dedup"))
def deduplicate_prefer(spark, sf):
    return dedup.deduplicate(_typed_fact(spark, sf), specs.DATA.key, "footnote_codes", "R",
                             order_by=[F.col("value").desc_nulls_last(), F.col("footnote_codes").asc_nulls_last()])


_PLAIN_ORDER = ", ".join(f"{x} ASC NULLS LAST" for x in
                         ("value", "footnote_codes", "period_start_date", "period_type", "period_num"))


@register("deduplicate_plain", with_ctes(oracle.dedup("data_typed", "series_id, year, period", _PLAIN_ORDER),
                                         "data_typed"))
def deduplicate_plain(spark, sf):
    return dedup.deduplicate(_typed_fact(spark, sf), specs.DATA.key)


@register("best_year_per_series", with_ctes(
    f"SELECT series_id, series_label, year, {sround('annual_sum', 6)} AS annual_sum FROM best_year", "best_year"))
def best_year_per_series(spark, sf):
    return rounded(ranking.best_year_per_series(_wide(spark, sf)), annual_sum=6)


# ---- analyst questions (Q1–Q6) ---------------------------------------------------------
# Parameters fit the derived data: sectors are region names, measures part names.
TREND = {"sector": "america", "measure": "widget"}
RANKING_MEASURE = "ring"
COMPARE = {"sectors": {"america": "america", "asia": "asia"}, "measure": "ring", "since": 1998}


@register("ask_annual_trend", with_ctes(f"""
SELECT year, {sround('avg_value', 2)} AS avg_value, series_count FROM annual
WHERE lower(sector_name) LIKE '%{TREND['sector']}%' AND lower(measure_text) LIKE '%{TREND['measure']}%'
ORDER BY year""", "annual"))
def ask_annual_trend(spark, sf):
    return ask.ask_annual_trend(gold.gold_annual(_wide(spark, sf)), **TREND)


@register("ask_latest_year_ranking", with_ctes(f"""
SELECT sector_name, {sround('avg_value', 2)} AS avg_value, series_count FROM annual
WHERE lower(measure_text) LIKE '%{RANKING_MEASURE}%'
  AND year = (SELECT max(year) FROM annual WHERE lower(measure_text) LIKE '%{RANKING_MEASURE}%')
ORDER BY avg_value DESC""", "annual"))
def ask_latest_year_ranking(spark, sf):
    return ask.ask_latest_year_ranking(gold.gold_annual(_wide(spark, sf)), RANKING_MEASURE)


def _compare_sql() -> str:
    cols = ", ".join(f"max(CASE WHEN lower(sector_name) LIKE '%{pat}%' THEN {sround('avg_value', 2)} END) AS {name}"
                     for name, pat in COMPARE["sectors"].items())
    return with_ctes(f"""
SELECT year, period, {cols} FROM quarterly
WHERE lower(measure_text) LIKE '%{COMPARE['measure']}%' AND period IN ('Q01', 'Q02', 'Q03', 'Q04')
  AND year >= {COMPARE['since']}
GROUP BY year, period ORDER BY year, period""", "quarterly")


@register("ask_sector_comparison", _compare_sql())
def ask_sector_comparison(spark, sf):
    return ask.ask_sector_comparison(gold.gold_quarterly(_wide(spark, sf)), **COMPARE)


@register("ask_population_stats", with_ctes(f"""
SELECT {sround('avg(population)', 6)} AS mean_population, {sround('stddev_pop(population)', 2)} AS stddev_population,
       min(year) AS year_from, max(year) AS year_to, count(*) AS year_count
FROM s_population WHERE year BETWEEN {WINDOW[0]} AND {WINDOW[1]} GROUP BY nation_id, nation""", "s_population"))
def ask_population_stats(spark, sf):
    stats = gold.gold_population_stats(_silver(spark, sf, "lookup_population"), *WINDOW)
    return rounded(ask.ask_population_stats(stats), mean_population=6, stddev_population=2)


@register("ask_population_by_year", with_ctes("SELECT year, population FROM s_population ORDER BY year",
                                              "s_population"))
def ask_population_by_year(spark, sf):
    return ask.ask_population_by_year(_silver(spark, sf, "lookup_population"))


@register("ask_q01_population_corr", with_ctes(f"""
SELECT series_label,
       CASE WHEN count(*) > 1 THEN {sround('corr(value, CAST(us_population AS DOUBLE))', 6)} END
         AS corr_value_population,
       count(*) AS pairs
FROM q01pop WHERE us_population IS NOT NULL GROUP BY series_label""", "q01pop"))
def ask_q01_population_corr(spark, sf):
    return rounded(ask.ask_q01_population_corr(_q01pop(spark, sf)), corr_value_population=6)


# ---- composite tables (T1–T11) ----------------------------------------------------------

_SILVER_CTE = {"data": "s_data", "series": "s_series", "lookup_measure": "s_measure",
               "lookup_sector": "s_sector", "lookup_class": "s_class", "lookup_duration": "s_duration",
               "lookup_footnote": "s_footnote", "lookup_period": "s_period",
               "lookup_seasonal": "s_seasonal", "lookup_population": "s_population"}


def _silver_query(name: str) -> Query:
    def q(spark, sf):
        return _silver(spark, sf, name)
    q.__name__ = f"silver_{name}"
    return q


for _name, _cte in _SILVER_CTE.items():
    register(f"silver_{_name}", with_ctes(f"SELECT * FROM {_cte}", _cte))(_silver_query(_name))


@register("gold_wide", with_ctes("SELECT * FROM wide", "wide"))
def gold_wide(spark, sf):
    return _wide(spark, sf)


# ---- SQL twins (X1–X5) -----------------------------------------------------------------

@register("population_stats_sql", _pop_stats_sql("s_population_by_nation"))
def population_stats_sql(spark, sf):
    return rounded(gold_sql.population_stats(_pop_by_nation(spark, sf)),
                   mean_population=6, stddev_population=2)


@register("best_year_sql", with_ctes(
    f"SELECT series_id, series_label, year, {sround('annual_sum', 6)} AS annual_sum FROM best_year", "best_year"))
def best_year_sql(spark, sf):
    return rounded(gold_sql.best_year_per_series(_wide(spark, sf)), annual_sum=6)


@register("q01_with_population_sql", with_ctes("SELECT * FROM q01pop", "q01pop"))
def q01_with_population_sql(spark, sf):
    return gold_sql.q01_with_population(_wide(spark, sf), _silver(spark, sf, "lookup_population"))


# ---- analyst questions as SQL (same oracle as the DataFrame versions) ------------------

@register("ask_annual_trend_sql", ORACLE["ask_annual_trend"])
def ask_annual_trend_sql(spark, sf):
    return ask_sql.ask_annual_trend(gold.gold_annual(_wide(spark, sf)), **TREND)


@register("ask_latest_year_ranking_sql", ORACLE["ask_latest_year_ranking"])
def ask_latest_year_ranking_sql(spark, sf):
    return ask_sql.ask_latest_year_ranking(gold.gold_annual(_wide(spark, sf)), RANKING_MEASURE)


@register("ask_sector_comparison_sql", ORACLE["ask_sector_comparison"])
def ask_sector_comparison_sql(spark, sf):
    return ask_sql.ask_sector_comparison(gold.gold_quarterly(_wide(spark, sf)), **COMPARE)


# ---- incremental silver and maintained gold (S2 to T1, A1-A3, A5) ------------------------
WAVES = 3
#: Bytes of raw facts (by the optimizer's estimate) to a bucket, so that tasks and buckets stay of one size as facts grow.
BUCKET_BYTES, BUCKETS_LEAST, BUCKETS_MOST = 64 << 20, 8, 512


def _buckets(raw: DataFrame) -> int:
    size = estimated_bytes(raw) or 0
    return min(max(-(-size // BUCKET_BYTES), BUCKETS_LEAST), BUCKETS_MOST)


def _wave(raw: DataFrame, number: int) -> DataFrame:
    """One of the waves in which raw rows land: scattered, so revisions follow or precede what they revise."""
    return raw.where(F.pmod(F.xxhash64(*raw.columns), F.lit(WAVES)) == number)


def _fact_waves(spark, sf):
    """Silver data and its aggregates after all waves, each landed and refreshed by itself."""
    def build():
        root = scratch_path(spark, "incremental")
        raw = fixtures.raw_data(spark, sf)
        buckets = _buckets(raw)
        kept = maintained_gold.ProductivityGold(spark, root, _silver_all(spark, sf), buckets)
        for number in range(WAVES):
            ingest.land(spark, _wave(raw, number), specs.DATA, f"{root}/landing")
            table = incremental.refresh(spark, specs.DATA, f"{root}/landing", root, buckets, then=[kept.follow])
        return {"silver": incremental.silver(table, specs.DATA), **kept.tables()}
    return _memo(spark, sf, "incremental:data", build)


@register("silver_incremental", with_ctes("SELECT * FROM s_data", "s_data"))
def silver_incremental(spark, sf):
    return _fact_waves(spark, sf)["silver"]


@register("quarterly_maintained", ORACLE["quarterly_aggregation"])
def quarterly_maintained(spark, sf):
    return rounded(_fact_waves(spark, sf)["quarterly"], avg_value=6)


@register("annual_maintained", ORACLE["annual_aggregation"])
def annual_maintained(spark, sf):
    return rounded(_fact_waves(spark, sf)["annual"], avg_value=6)


@register("annual_sums_maintained", ORACLE["annual_sums"])
def annual_sums_maintained(spark, sf):
    return rounded(_fact_waves(spark, sf)["annual_sums"], annual_sum=6)


@register("population_stats_maintained", ORACLE["population_stats"])
def population_stats_maintained(spark, sf):
    root = scratch_path(spark, "incremental-population")
    kept = maintained_gold.PopulationGold(spark, root)
    raw = fixtures.raw_population_by_nation(spark, sf)
    for number in range(WAVES):
        ingest.land(spark, _wave(raw, number), specs.POPULATION, f"{root}/landing/{number}")
        table = incremental.refresh(spark, specs.POPULATION, f"{root}/landing/*", root, buckets=4, then=[kept.follow])
    return rounded(kept.table(), mean_population=6, stddev_population=2)


# ---- manifest in place, layout on several keys (S16, S9) ---------------------------------

@register("manifest_upsert_in_place", _UPSERT_SQL)
def manifest_upsert_in_place(spark, sf):
    """The stored manifest and the pending entries as two batches; the second writes the buckets it touches."""
    pending, state = _pending(spark, sf)
    kept = manifest.kept_manifest(spark, scratch_path(spark, "manifest"), buckets=16)
    manifest.upsert_in_place(kept, state, 0)
    manifest.upsert_in_place(kept, pending, 1)
    return kept.read().select("url", "last_modified")


#: Keys of the Z-ordered wide table, and what is asked of it: one key at a time, and all of them.
LAYOUT_KEYS = ("series_id", "year", "measure_code")
PROBES = {
    "series": {"series_id": ("PRS00000003", "PRS00000006")},
    "year": {"year": (1997, 1997)},
    "measure": {"measure_code": ("05", "07")},
    "all": {"series_id": ("PRS00000002", None), "year": (1996, 1999), "measure_code": (None, "12")},
}


def _probe_sql(conditions: dict) -> str:
    parts = [f"{k} {op} {v!r}" for k, ends in conditions.items() for op, v in zip((">=", "<="), ends) if v is not None]
    return " AND ".join(parts)


@register("layout_zorder_lookup", with_ctes(" UNION ALL ".join(
    f"SELECT '{name}' AS probe, * FROM wide WHERE {_probe_sql(conditions)}" for name, conditions in PROBES.items()), "wide"))
def layout_zorder_lookup(spark, sf):
    """The wide table in Z order of three keys; each probe opens only files whose zones can hold its rows."""
    path = scratch_path(spark, "wide-zorder")
    layout.write_z_ordered(_wide(spark, sf), path, LAYOUT_KEYS, files=32)
    return _union([layout.read_where(spark, path, conditions).select(F.lit(name).alias("probe"), "*")
                   for name, conditions in PROBES.items()])


# ---- population of several nations (J9) --------------------------------------------------
NATIONS = ("01000us", "07000us", "13000us", "99000us")


@register("q01_population_by_nation", with_ctes(f"""
SELECT n.nation_id, w.series_id, w.series_label, w.year, w.period, w.value, p.population AS us_population
FROM wide w CROSS JOIN (SELECT unnest({list(x.upper() for x in NATIONS)}) AS nation_id) n
LEFT JOIN s_population_by_nation p ON p.nation_id = n.nation_id AND p.year = w.year
WHERE w.period = 'Q01'""", "wide", "s_population_by_nation"))
def q01_population_by_nation(spark, sf):
    # written first, as the pipeline does: the size of files is known, that of a join behind a plan is only guessed
    people = _written(_pop_by_nation(spark, sf), scratch_path(spark, "population-by-nation"))
    return joins.q01_with_population(_wide(spark, sf), people, nations=[n.upper() for n in NATIONS])


# ---- gates that keep what they drop (E1-E3) ----------------------------------------------

def _split_fact(spark, sf):
    return quarantine.split_by_rules(_typed_fact(spark, sf), specs.DATA_RULES, scratch_path(spark, "quarantine"))


_RULE_SQL = {"valid_series_id": "series_id IS NOT NULL", "valid_year_range": "year > 1900", "valid_value": "value IS NOT NULL",
             "valid_period_format": "regexp_matches(period, '^(Q0[1-5]|A01)$')"}
_REASONS_SQL = ", ".join(f"CASE WHEN NOT coalesce({rule}, false) THEN '{name}' END" for name, rule in _RULE_SQL.items())


@register("expect_dropped_with_reasons", with_ctes(
    f"SELECT *, concat_ws(',', {_REASONS_SQL}) AS reasons FROM data_typed WHERE NOT ({oracle.RULES_DATA})", "data_typed"))
def expect_dropped_with_reasons(spark, sf):
    return (_split_fact(spark, sf).dropped.drop(quarantine.MASK)
            .withColumn("reasons", F.concat_ws(",", "reasons")))


@register("expect_kept_beside_dropped", ORACLE["expect_all_or_drop"])
def expect_kept_beside_dropped(spark, sf):
    return _split_fact(spark, sf).kept


@register("expectation_metrics_split", ORACLE["expectation_metrics"])
def expectation_metrics_split(spark, sf):
    return _split_fact(spark, sf).metrics()


# ---- run-time pruning, joins without exchange, bitmaps for keys (F7, J2, V4) -------------

@register("ask_latest_year_pruned", ORACLE["ask_latest_year_ranking"])
def ask_latest_year_pruned(spark, sf):
    """The ranking from a wide table partitioned by year: values of the latest year's files only."""
    by_year = sinks.write_partitioned(_wide(spark, sf), scratch_path(spark, "wide-by-year"), "year")
    return ask.ask_latest_year_of_wide(by_year, RANKING_MEASURE)


@register("join_series_colocated", ORACLE["join_series"])
def join_series_colocated(spark, sf):
    path = scratch_path(spark, "colocated")
    fact = _written(_silver(spark, sf, "data"), f"{path}/written")
    series = _silver(spark, sf, "series").select("series_id", *joins.SERIES_ATTRIBUTES)
    return colocated.lay_out(fact, series, "series_id", path, buckets=16).join()


@register("check_unique_key_bitmap", ORACLE["check_unique_key"])
def check_unique_key_bitmap(spark, sf):
    path = scratch_path(spark, "unique-key")
    keys = ("series_id", "year", "period")
    written = sinks.write_clustered(_wide(spark, sf).select(*keys), f"{path}/written", keys)
    return bitmaps.check_unique_key_bitmap(written, keys, path)
