"""DuckDB oracle SQL for every registered query.

Each query is the same derivation written independently in ANSI-style SQL
(CTEs over the pre-registered parquet views), then the operator itself.
Doubles that depend on summation order are rounded identically on both sides.
``sround`` rounds the way Spark rounds a double: half-up on the double's
shortest decimal string (DuckDB prints the same shortest string).
"""

from __future__ import annotations


def sround(expr: str, digits: int) -> str:
    exact = f"CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,18))"
    return f"CASE WHEN isfinite({expr}) THEN CAST(round({exact}, {digits}) AS DOUBLE) ELSE {expr} END"


def c(col: str) -> str:
    """Trim, blank -> NULL."""
    return f"nullif(trim({col}), '')"


def cu(col: str) -> str:
    return f"upper({c(col)})"


def pad(expr: str, n: int) -> str:
    return f"lpad(CAST({expr} AS VARCHAR), {n}, '0')"


RULES_DATA = ("coalesce(series_id IS NOT NULL, false) AND coalesce(year > 1900, false) "
              "AND coalesce(value IS NOT NULL, false) "
              "AND coalesce(regexp_matches(period, '^(Q0[1-5]|A01)$'), false)")

LABEL = ("coalesce(sector_name, 'Unknown sector') || ' — ' || coalesce(measure_text, 'Unknown measure') "
         "|| ', ' || coalesce(duration_text, 'Unknown duration') || ' (' || "
         "CASE WHEN seasonal = 'S' THEN 'Seasonally Adjusted' WHEN seasonal = 'U' "
         "THEN 'Not Seasonally Adjusted' ELSE 'Unknown' END || ')'")


def dedup(src: str, keys: str, order: str) -> str:
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
            f"ORDER BY {order}) AS _rn FROM {src}) WHERE _rn = 1")


def dirty(base: str, code: str, first: str, cols: list[str]) -> str:
    """base rows + a padded lower-case copy + a blank-key copy of one row."""
    rest = ", ".join(x for x in cols if x != code)
    sel = lambda e: f"SELECT {e} AS {code}, {rest} FROM {base} WHERE {code} = '{first}'"
    return (f"SELECT {', '.join(cols)} FROM {base} UNION ALL "
            f"{sel(f' chr(32) || lower({code}) || chr(32) ')} UNION ALL {sel(repr('  '))}")


TAIL = "'0' AS display_level, 't' AS selectable"
LOOKUP_ORDER = lambda text: f"{text} NULLS LAST, display_level NULLS LAST, selectable NULLS LAST, sort_sequence NULLS LAST"


def lookup_silver(raw: str, code: str, text: str) -> str:
    typed = (f"SELECT {cu(code)} AS {code}, {c(text)} AS {text}, {c('display_level')} AS display_level, "
             f"{cu('selectable')} AS selectable, {c('sort_sequence')} AS sort_sequence FROM {raw}")
    return f"SELECT * FROM ({dedup(f'({typed})', code, LOOKUP_ORDER(text))}) WHERE {code} IS NOT NULL"


# name -> (sql, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


# ---- raw frames --------------------------------------------------------------
cte("raw_data", f"""
SELECT '  prs' || {pad('l_suppkey', 8)} || '   ' AS series_id,
       CASE WHEN l_orderkey % 97 = 0 THEN 'n/a' ELSE CAST(year(l_shipdate) AS VARCHAR) END AS year,
       CASE WHEN l_linenumber = 7 THEN 'a01' WHEN l_linenumber = 6 THEN 'q05'
            WHEN l_linenumber = 5 AND l_orderkey % 50 = 0 THEN 'x99'
            ELSE 'q0' || CAST(quarter(l_shipdate) AS VARCHAR) END AS period,
       CASE WHEN l_orderkey % 89 = 0 THEN '-'
            ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS value,
       CASE WHEN l_returnflag = 'R' THEN ' r ' ELSE '  ' END AS footnote_codes
FROM lineitem""")

cte("raw_series", f"""
SELECT 'PRS' || {pad('s_suppkey', 8)} || '  ' AS series_id,
       CAST(n_regionkey AS VARCHAR) AS sector_code,
       ' ' || CAST(s_nationkey AS VARCHAR) AS class_code,
       {pad('s_suppkey % 22 + 1', 2)} AS measure_code,
       CAST(s_suppkey % 3 + 1 AS VARCHAR) AS duration_code,
       CASE WHEN s_suppkey % 5 = 0 THEN '' WHEN s_suppkey % 2 = 0 THEN 's' ELSE 'u' END AS seasonal,
       CASE WHEN s_suppkey % 3 = 2 THEN '2017' ELSE '-' END AS base_year,
       '' AS footnote_codes,
       CASE WHEN s_suppkey % 50 = 3 THEN '-' ELSE '1995' END AS begin_year,
       'q01' AS begin_period, '2001' AS end_year, 'q04' AS end_period
FROM supplier JOIN nation ON s_nationkey = n_nationkey
WHERE s_suppkey % 20 <> 7""")



def lk_cols(code: str, text: str) -> list[str]:
    return [code, text, "display_level", "selectable", "sort_sequence"]


cte("measure_base", f"""
SELECT {pad('k', 2)} AS measure_code, measure_text, {TAIL}, CAST(k AS VARCHAR) AS sort_sequence
FROM (SELECT k, arg_min(p_name, h) || ' to ' || arg_max(p_name, h) || ', no. ' || {pad('k', 2)} AS measure_text
      FROM (SELECT p_name, p_partkey % 22 + 1 AS k, p_partkey * 7919 % 104729 * 1000000000000 + p_partkey AS h FROM part) t
      GROUP BY k) WHERE k <= 20""")
cte("raw_measure", dirty("measure_base", "measure_code", "01", lk_cols("measure_code", "measure_text")), "measure_base")
cte("supplier_nations", "SELECT DISTINCT s_nationkey FROM supplier")
cte("sector_base", f"""
SELECT CAST(r_regionkey AS VARCHAR) AS sector_code, r_name AS sector_name, {TAIL},
       CAST(r_regionkey + 1 AS VARCHAR) AS sort_sequence
FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM supplier_nations JOIN nation ON s_nationkey = n_nationkey)""",
    "supplier_nations")
cte("raw_sector", dirty("sector_base", "sector_code", "0", lk_cols("sector_code", "sector_name")), "sector_base")
cte("class_base", f"""
SELECT CAST(n_nationkey AS VARCHAR) AS class_code, n_name AS class_text, {TAIL},
       CAST(n_nationkey AS VARCHAR) AS sort_sequence
FROM supplier_nations JOIN nation ON s_nationkey = n_nationkey WHERE n_nationkey % 7 <> 0""", "supplier_nations")
cte("raw_class", dirty("class_base", "class_code", "1", lk_cols("class_code", "class_text")), "class_base")
cte("duration_base", f"""
SELECT code AS duration_code,
       CASE code WHEN '1' THEN '% Change same quarter 1 year ago' WHEN '2' THEN '% Change from previous quarter'
                 WHEN '3' THEN 'Index (2017=100)' END AS duration_text, {TAIL}, code AS sort_sequence
FROM (SELECT DISTINCT CAST(s_suppkey % 3 + 1 AS VARCHAR) AS code FROM supplier)""")
cte("raw_duration", dirty("duration_base", "duration_code", "1", lk_cols("duration_code", "duration_text")), "duration_base")
cte("period_base", """
SELECT period,
       CASE period WHEN 'Q01' THEN 'QTR1' WHEN 'Q02' THEN 'QTR2' WHEN 'Q03' THEN 'QTR3' WHEN 'Q04' THEN 'QTR4'
                   WHEN 'Q05' THEN 'AN AV' END AS period_abbr,
       CASE period WHEN 'Q01' THEN '1st Quarter' WHEN 'Q02' THEN '2nd Quarter' WHEN 'Q03' THEN '3rd Quarter'
                   WHEN 'Q04' THEN '4th Quarter' WHEN 'Q05' THEN 'Annual Average' END AS period_name
FROM (SELECT DISTINCT upper(trim(period)) AS period FROM raw_data)
WHERE period IN ('Q01', 'Q02', 'Q03', 'Q04', 'Q05')""", "raw_data")
cte("raw_period", dirty("period_base", "period", "Q01", ["period", "period_abbr", "period_name"]), "period_base")
cte("seasonal_base", """
SELECT Seasonal_code, CASE Seasonal_code WHEN 'S' THEN 'Seasonal Adjusted'
                                         WHEN 'U' THEN 'Not Seasonally Adjusted' END AS Seasonal_text
FROM (SELECT DISTINCT upper(trim(seasonal)) AS Seasonal_code FROM raw_series)
WHERE Seasonal_code IN ('S', 'U')""", "raw_series")
cte("raw_seasonal", dirty("seasonal_base", "Seasonal_code", "S", ["Seasonal_code", "Seasonal_text"]), "seasonal_base")
cte("footnote_base", """
SELECT footnote_code, CASE upper(footnote_code) WHEN 'R' THEN 'revised' END AS footnote_text
FROM (SELECT DISTINCT lower(l_returnflag) AS footnote_code FROM lineitem WHERE l_returnflag = 'R')""")
cte("raw_footnote", dirty("footnote_base", "footnote_code", "r", ["footnote_code", "footnote_text"]), "footnote_base")
cte("pop_years", "SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1")
cte("raw_population", """
SELECT '01000us ' AS nation_id, 'United States' AS nation, CAST(y AS VARCHAR) AS year,
       CAST(n * 100000 AS VARCHAR) || '.0' AS population FROM pop_years WHERE y <> 2000
UNION ALL SELECT '01000us ', 'United States', 'n/a', CAST(n * 100000 AS VARCHAR) || '.0' FROM pop_years WHERE y = 2000
UNION ALL SELECT '01000us ', 'United States', '1990', 'N/A' FROM pop_years WHERE y = 2000""", "pop_years")
cte("raw_population_by_nation", f"""
SELECT {pad('c_nationkey', 2)} || '000us' AS nation_id, n_name AS nation, CAST(y AS VARCHAR) AS year,
       CAST(n * 1000 AS VARCHAR) || '.0' AS population
FROM (SELECT c_nationkey, year(o_orderdate) AS y, count(*) AS n
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) t
JOIN nation ON c_nationkey = n_nationkey""")

# ---- silver ------------------------------------------------------------------
cte("data_clean", f"""
SELECT {c('series_id')} AS series_id, {c('year')} AS year, {c('period')} AS period,
       {c('value')} AS value, {c('footnote_codes')} AS footnote_codes FROM raw_data""", "raw_data")
cte("data_upper", """
SELECT upper(series_id) AS series_id, year, upper(period) AS period, value,
       upper(footnote_codes) AS footnote_codes FROM data_clean""", "data_clean")
cte("data_typed", """
SELECT series_id, y AS year, period, TRY_CAST(value AS DOUBLE) AS value, footnote_codes,
       CASE WHEN y BETWEEN 1 AND 9999 AND period = 'Q01' THEN make_date(y, 1, 1)
            WHEN y BETWEEN 1 AND 9999 AND period = 'Q02' THEN make_date(y, 4, 1)
            WHEN y BETWEEN 1 AND 9999 AND period = 'Q03' THEN make_date(y, 7, 1)
            WHEN y BETWEEN 1 AND 9999 AND period = 'Q04' THEN make_date(y, 10, 1)
            WHEN y BETWEEN 1 AND 9999 AND period = 'A01' THEN make_date(y, 1, 1) END AS period_start_date,
       CASE WHEN starts_with(period, 'Q') THEN 'quarterly' WHEN starts_with(period, 'A') THEN 'annual'
            ELSE 'other' END AS period_type,
       TRY_CAST(nullif(regexp_extract(period, '\\d+', 0), '') AS INTEGER) AS period_num
FROM (SELECT *, TRY_CAST(year AS INTEGER) AS y FROM data_upper) t""", "data_upper")
DATA_ORDER = ("CASE WHEN footnote_codes = 'R' THEN 0 ELSE 1 END, value DESC NULLS LAST, "
              "footnote_codes ASC NULLS LAST")
cte("data_dedup", dedup("data_typed", "series_id, year, period", DATA_ORDER), "data_typed")
cte("s_data", f"SELECT * FROM data_dedup WHERE {RULES_DATA}", "data_dedup")

cte("series_typed", f"""
SELECT {c('series_id')} AS series_id, {cu('sector_code')} AS sector_code, {cu('class_code')} AS class_code,
       {cu('measure_code')} AS measure_code, {cu('duration_code')} AS duration_code, {cu('seasonal')} AS seasonal,
       TRY_CAST({c('base_year')} AS INTEGER) AS base_year, {cu('footnote_codes')} AS footnote_codes,
       TRY_CAST({c('begin_year')} AS INTEGER) AS begin_year, {cu('begin_period')} AS begin_period,
       TRY_CAST({c('end_year')} AS INTEGER) AS end_year, {cu('end_period')} AS end_period
FROM raw_series""", "raw_series")
SERIES_ORDER = ", ".join(f"{x} NULLS LAST" for x in (
    "sector_code", "class_code", "measure_code", "duration_code", "seasonal", "base_year",
    "footnote_codes", "begin_year", "begin_period", "end_year", "end_period"))
cte("s_series", f"""
SELECT * FROM ({dedup('series_typed', 'series_id', SERIES_ORDER)})
WHERE series_id IS NOT NULL AND coalesce(begin_year > 1900, false) AND coalesce(end_year > 1900, false)""",
    "series_typed")
cte("s_measure", lookup_silver("raw_measure", "measure_code", "measure_text"), "raw_measure")
cte("s_sector", lookup_silver("raw_sector", "sector_code", "sector_name"), "raw_sector")
cte("s_class", lookup_silver("raw_class", "class_code", "class_text"), "raw_class")
cte("s_duration", lookup_silver("raw_duration", "duration_code", "duration_text"), "raw_duration")
cte("s_footnote", f"""
SELECT * FROM ({dedup(f"(SELECT {cu('footnote_code')} AS footnote_code, {c('footnote_text')} AS footnote_text FROM raw_footnote)", 'footnote_code', 'footnote_text NULLS LAST')})
WHERE footnote_code IS NOT NULL""", "raw_footnote")
cte("s_period", f"""
SELECT * FROM ({dedup(f"(SELECT {cu('period')} AS period, {c('period_abbr')} AS period_abbr, {c('period_name')} AS period_name FROM raw_period)", 'period', 'period_abbr NULLS LAST, period_name NULLS LAST')})
WHERE period IS NOT NULL""", "raw_period")
cte("s_seasonal", f"""
SELECT * FROM ({dedup(f"(SELECT {cu('Seasonal_code')} AS seasonal_code, {c('Seasonal_text')} AS seasonal_text FROM raw_seasonal)", 'seasonal_code', 'seasonal_text NULLS LAST')})
WHERE seasonal_code IS NOT NULL""", "raw_seasonal")


def population_silver(raw: str) -> str:
    typed = (f"(SELECT {cu('nation_id')} AS nation_id, {c('nation')} AS nation, "
             f"TRY_CAST({c('year')} AS INTEGER) AS year, "
             f"TRY_CAST(trunc(TRY_CAST({c('population')} AS DOUBLE)) AS BIGINT) AS population FROM {raw})")
    return (f"SELECT * FROM ({dedup(typed, 'nation_id, year', 'nation NULLS LAST, population NULLS LAST')}) "
            f"WHERE coalesce(year > 1900, false) AND coalesce(population IS NOT NULL AND population > 0, false)")


cte("s_population", population_silver("raw_population"), "raw_population")
cte("s_population_by_nation", population_silver("raw_population_by_nation"), "raw_population_by_nation")

# ---- gold --------------------------------------------------------------------
cte("wide_joined", """
SELECT d.series_id, d.year, d.period, d.value, d.footnote_codes, d.period_start_date, d.period_type,
       d.period_num, s.sector_code, sc.sector_name, s.measure_code, m.measure_text, s.class_code,
       cl.class_text, s.duration_code, du.duration_text, s.seasonal, se.seasonal_text,
       p.period_abbr, p.period_name
FROM s_data d
LEFT JOIN s_series s ON d.series_id = s.series_id
LEFT JOIN s_measure m ON s.measure_code = m.measure_code
LEFT JOIN s_sector sc ON s.sector_code = sc.sector_code
LEFT JOIN s_class cl ON s.class_code = cl.class_code
LEFT JOIN s_duration du ON s.duration_code = du.duration_code
LEFT JOIN s_seasonal se ON s.seasonal = se.seasonal_code
LEFT JOIN s_period p ON d.period = p.period""",
    "s_data", "s_series", "s_measure", "s_sector", "s_class", "s_duration", "s_seasonal", "s_period")
cte("wide_built", f"SELECT *, {LABEL} AS series_label FROM wide_joined", "wide_joined")
cte("wide", """
SELECT * FROM wide_built WHERE series_id IS NOT NULL AND coalesce(year > 1900, false)
  AND value IS NOT NULL AND period IS NOT NULL""", "wide_built")
AGG = "avg(value) AS avg_value, min(value) AS min_value, max(value) AS max_value, count(*) AS series_count"
cte("quarterly", f"""
SELECT sector_code, sector_name, measure_code, measure_text, year, period, period_num, {AGG}
FROM wide WHERE period_type = 'quarterly'
GROUP BY sector_code, sector_name, measure_code, measure_text, year, period, period_num""", "wide")
cte("annual", f"""
SELECT sector_code, sector_name, measure_code, measure_text, year, {AGG}
FROM wide WHERE period_type = 'annual'
GROUP BY sector_code, sector_name, measure_code, measure_text, year""", "wide")
cte("annual_sums", """
SELECT series_id, series_label, year, sum(value) AS annual_sum FROM wide
WHERE period_type = 'quarterly' GROUP BY series_id, series_label, year""", "wide")
cte("best_year", """
SELECT series_id, series_label, year, annual_sum FROM (
  SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY annual_sum DESC NULLS LAST, year ASC) AS rn
  FROM annual_sums) WHERE rn = 1""", "annual_sums")
cte("q01pop", """
SELECT w.series_id, w.series_label, w.year, w.period, w.value, p.population AS us_population
FROM wide w LEFT JOIN s_population p ON w.year = p.year WHERE w.period = 'Q01'""", "wide", "s_population")

# ---- landing -----------------------------------------------------------------
cte("listing_expected", """
SELECT page_id,
       'https://download.bls.gov/pub/time.series/pr/p' || CAST(page_id AS VARCHAR) || '/' || fname AS url,
       fname AS filename,
       CAST(page_id % 12 + 1 AS VARCHAR) || '/6/2026  8:30 ' || CASE WHEN page_id % 2 = 0 THEN 'AM' ELSE 'PM' END
         AS last_modified,
       CAST(length(html) AS BIGINT) AS size_bytes
FROM (SELECT page_id, html, 'pr.' || CASE page_id % 6
        WHEN 0 THEN 'data.' || CAST(page_id AS VARCHAR) || '.Current'
        WHEN 1 THEN 'data.' || CAST(page_id AS VARCHAR) || '.AllData'
        WHEN 2 THEN 'series' WHEN 3 THEN 'contacts'
        WHEN 4 THEN 'lookup' || CAST(page_id AS VARCHAR) ELSE 'data.x' END AS fname FROM pages) t""")
cte("manifest_state", """
SELECT url, CASE WHEN page_id % 3 = 1 THEN 'old' WHEN page_id % 10 = 0 THEN NULL ELSE last_modified END
       AS last_modified
FROM listing_expected WHERE page_id % 3 <> 2""", "listing_expected")
cte("pending", """
SELECT e.* FROM listing_expected e
WHERE NOT EXISTS (SELECT 1 FROM manifest_state m
                  WHERE m.url IS NOT DISTINCT FROM e.url AND m.last_modified IS NOT DISTINCT FROM e.last_modified)""",
    "listing_expected", "manifest_state")


def with_ctes(final: str, *needed: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    if not order:
        return final.strip()
    body = ",\n".join(f"{n} AS ({CTES[n][0].strip()})" for n in order)
    return f"WITH {body}\n{final.strip()}"
