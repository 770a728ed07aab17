"""Raw, all-string inputs derived from the analytic tables.

The engine's native input is landed delimited text for a coded time series.
These functions derive equivalent raw frames from the parquet tables, with the
defects the silver rules exist for (padding, lower case, unparsable numbers,
unknown period codes, revised duplicates, orphan keys, a missing year).
Every frame is a lazy Spark plan over the tables, so it scales with them.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joins import sized_broadcast
from ..session import session_key
from .tables import table

_FRAMES: dict[tuple[str, str, str], DataFrame] = {}


def clear_frame_cache() -> None:
    _FRAMES.clear()


def memo_frame(fn):
    """Build a derived frame's (lazy) plan once per session and input folder."""
    @functools.wraps(fn)
    def wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (session_key(spark), sf_dir.rstrip("/"), fn.__name__)
        df = _FRAMES.get(key)
        if df is None:
            df = _FRAMES[key] = fn(spark, sf_dir)
        return df
    return wrapper


def _s(c: Column) -> Column:
    return c.cast("string")


def _pad(c: Column, n: int) -> Column:
    return F.lpad(_s(c), n, "0")


@memo_frame
def raw_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact lines from lineitem: series = supplier, period = ship quarter."""
    li = table(spark, sf_dir, "lineitem")
    ok, ln = F.col("l_orderkey"), F.col("l_linenumber")
    quarter_code = F.concat(F.lit("q0"), _s(F.quarter("l_shipdate")))
    return li.select(
        F.concat(F.lit("  prs"), _pad(F.col("l_suppkey"), 8), F.lit("   ")).alias("series_id"),
        F.when(ok % 97 == 0, F.lit("n/a")).otherwise(_s(F.year("l_shipdate"))).alias("year"),
        F.when(ln == 7, F.lit("a01")).when(ln == 6, F.lit("q05"))
         .when((ln == 5) & (ok % 50 == 0), F.lit("x99")).otherwise(quarter_code).alias("period"),
        F.when(ok % 89 == 0, F.lit("-"))
         .otherwise(_s(F.col("l_extendedprice").cast("decimal(18,2)"))).alias("value"),
        F.when(F.col("l_returnflag") == "R", F.lit(" r ")).otherwise(F.lit("  ")).alias("footnote_codes"),
    )


@memo_frame
def raw_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series dimension from supplier ⋈ nation; every 20th supplier (7 mod 20)
    has no series row, so its facts are orphans."""
    sup = table(spark, sf_dir, "supplier").where(F.col("s_suppkey") % 20 != 7)
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    sk = F.col("s_suppkey")
    j = sup.join(sized_broadcast(nat), sup.s_nationkey == nat.n_nationkey)
    return j.select(
        F.concat(F.lit("PRS"), _pad(sk, 8), F.lit("  ")).alias("series_id"),
        _s(F.col("n_regionkey")).alias("sector_code"),
        F.concat(F.lit(" "), _s(F.col("s_nationkey"))).alias("class_code"),
        _pad(sk % 22 + 1, 2).alias("measure_code"),
        _s(sk % 3 + 1).alias("duration_code"),
        F.when(sk % 5 == 0, F.lit("")).when(sk % 2 == 0, F.lit("s")).otherwise(F.lit("u")).alias("seasonal"),
        F.when(sk % 3 == 2, F.lit("2017")).otherwise(F.lit("-")).alias("base_year"),
        F.lit("").alias("footnote_codes"),
        F.when(sk % 50 == 3, F.lit("-")).otherwise(F.lit("1995")).alias("begin_year"),
        F.lit("q01").alias("begin_period"),
        F.lit("2001").alias("end_year"),
        F.lit("q04").alias("end_period"),
    )


def with_dirty_copies(df: DataFrame, code_col: str, first_code: str) -> DataFrame:
    """Add a padded lower-case copy of the row with ``first_code`` and a
    blank-key copy of it, so both dedup and the NULL-key rule act."""
    # One pass over the source: the chosen row explodes into three variants.
    code = F.col(code_col)
    variant = F.explode(F.when(code == first_code, F.array(F.lit(0), F.lit(1), F.lit(2)))
                         .otherwise(F.array(F.lit(0)))).alias("_variant")
    v = F.col("_variant")
    dirty = (F.when(v == 1, F.concat(F.lit(" "), F.lower(code), F.lit(" ")))
              .when(v == 2, F.lit("  ")).otherwise(code))
    return (df.select("*", variant).withColumn(code_col, dirty)
              .select(*[F.col(f"`{c}`") for c in df.columns]))


def _lookup_tail(sort_seq: Column) -> list[Column]:
    return [F.lit("0").alias("display_level"), F.lit("t").alias("selectable"),
            _s(sort_seq).alias("sort_sequence")]


@memo_frame
def raw_measure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One measure per remainder of the part key: an aggregate over all parts. Its text names the
    first and the last of its parts in a scattered order, and its code, so measures stay distinct
    however many parts there are. Codes 21 and 22 are no measures, so series that carry them stay unmatched."""
    key = F.col("p_partkey")
    scattered = key * 7919 % 104729 * F.lit(10 ** 12) + key
    p = (table(spark, sf_dir, "part").groupBy((key % 22 + 1).alias("k"))
         .agg(F.min_by("p_name", scattered).alias("low"), F.max_by("p_name", scattered).alias("high")).where("k <= 20"))
    code = _pad(F.col("k"), 2)
    df = p.select(code.alias("measure_code"), F.concat("low", F.lit(" to "), "high", F.lit(", no. "), code).alias("measure_text"),
                  *_lookup_tail(F.col("k")))
    return with_dirty_copies(df, "measure_code", "01")


def _supplier_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation keys actually used by suppliers: a distinct over the growing
    supplier table (partial aggregation before the shuffle)."""
    return table(spark, sf_dir, "supplier").select("s_nationkey").distinct()


@memo_frame
def raw_sector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sectors = regions that have suppliers."""
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    used = (_supplier_nations(spark, sf_dir).join(sized_broadcast(nat), F.col("s_nationkey") == F.col("n_nationkey"))
            .select("n_regionkey").distinct())
    r = table(spark, sf_dir, "region")
    j = used.join(sized_broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))
    df = j.select(_s(F.col("r_regionkey")).alias("sector_code"), F.col("r_name").alias("sector_name"),
                  *_lookup_tail(F.col("r_regionkey") + 1))
    return with_dirty_copies(df, "sector_code", "0")


@memo_frame
def raw_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes = supplier nations, without every 7th nation (their series stay unmatched)."""
    n = table(spark, sf_dir, "nation").where(F.col("n_nationkey") % 7 != 0).select("n_nationkey", "n_name")
    j = _supplier_nations(spark, sf_dir).join(sized_broadcast(n), F.col("s_nationkey") == F.col("n_nationkey"))
    df = j.select(_s(F.col("n_nationkey")).alias("class_code"), F.col("n_name").alias("class_text"),
                  *_lookup_tail(F.col("n_nationkey")))
    return with_dirty_copies(df, "class_code", "1")


# Duration, period, seasonal and footnote wording.
DURATION_TEXT = {
    "1": "% Change same quarter 1 year ago",
    "2": "% Change from previous quarter",
    "3": "Index (2017=100)",
}
PERIOD_TEXT = {
    "Q01": ("QTR1", "1st Quarter"),
    "Q02": ("QTR2", "2nd Quarter"),
    "Q03": ("QTR3", "3rd Quarter"),
    "Q04": ("QTR4", "4th Quarter"),
    "Q05": ("AN AV", "Annual Average"),
}
SEASONAL_TEXT = {"S": "Seasonal Adjusted", "U": "Not Seasonally Adjusted"}
FOOTNOTE_TEXT = {"R": "revised"}


def _mapped(code: Column, mapping: dict[str, str]) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(code == k, v) if expr is None else expr.when(code == k, v)
    return expr


@memo_frame
def raw_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations used by the series (distinct codes over supplier)."""
    codes = (table(spark, sf_dir, "supplier").select(_s(F.col("s_suppkey") % 3 + 1).alias("duration_code"))
             .distinct())
    c = F.col("duration_code")
    df = codes.select(c, _mapped(c, DURATION_TEXT).alias("duration_text"), *_lookup_tail(c))
    return with_dirty_copies(df, "duration_code", "1")


@memo_frame
def raw_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarter codes present in the fact (Q01–Q05; A01 has no row, as upstream)."""
    codes = (raw_data(spark, sf_dir).select(F.upper(F.trim("period")).alias("period"))
             .where(F.col("period").isin(*PERIOD_TEXT)).distinct())
    c = F.col("period")
    abbr = _mapped(c, {k: v[0] for k, v in PERIOD_TEXT.items()})
    name = _mapped(c, {k: v[1] for k, v in PERIOD_TEXT.items()})
    df = codes.select(c, abbr.alias("period_abbr"), name.alias("period_name"))
    return with_dirty_copies(df, "period", "Q01")


@memo_frame
def raw_seasonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seasonal codes used by the series; raw headers are mixed case."""
    codes = (raw_series(spark, sf_dir).select(F.upper(F.trim("seasonal")).alias("Seasonal_code"))
             .where(F.col("Seasonal_code").isin(*SEASONAL_TEXT)).distinct())
    c = F.col("Seasonal_code")
    df = codes.select(c, _mapped(c, SEASONAL_TEXT).alias("Seasonal_text"))
    return with_dirty_copies(df, "Seasonal_code", "S")


@memo_frame
def raw_footnote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Footnote codes carried by the fact lines (the revised flag)."""
    codes = (table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
             .select(F.lower("l_returnflag").alias("footnote_code")).distinct())
    c = F.col("footnote_code")
    df = codes.select(c, _mapped(F.upper(c), FOOTNOTE_TEXT).alias("footnote_text"))
    return with_dirty_copies(df, "footnote_code", "r")


POPULATION_NATION_ID = "01000us "
POPULATION_NATION = "United States"
GAP_YEAR = 2000


@memo_frame
def raw_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nation's yearly population from order counts; the gap year has no
    row, but yields one line with an unparsable year and one with an
    unparsable population."""
    per_year = (table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("y"))
                .agg(F.count(F.lit(1)).alias("n")))
    pop = F.concat(_s(F.col("n") * 100000), F.lit(".0"))
    base = [F.lit(POPULATION_NATION_ID).alias("nation_id"), F.lit(POPULATION_NATION).alias("nation")]
    good = per_year.where(F.col("y") != GAP_YEAR).select(*base, _s(F.col("y")).alias("year"), pop.alias("population"))
    gap = per_year.where(F.col("y") == GAP_YEAR)
    bad_year = gap.select(*base, F.lit("n/a").alias("year"), pop.alias("population"))
    bad_pop = gap.select(*base, F.lit("1990").alias("year"), F.lit("N/A").alias("population"))
    return good.unionByName(bad_year).unionByName(bad_pop)


@memo_frame
def raw_population_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several nations: customers' order counts per nation and year."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    counts = (orders.join(cust, orders.o_custkey == cust.c_custkey)
              .groupBy("c_nationkey", F.year("o_orderdate").alias("y"))
              .agg(F.count(F.lit(1)).alias("n")))
    j = counts.join(sized_broadcast(nat), counts.c_nationkey == nat.n_nationkey)
    return j.select(F.concat(_pad(F.col("c_nationkey"), 2), F.lit("000us")).alias("nation_id"),
                    F.col("n_name").alias("nation"), _s(F.col("y")).alias("year"),
                    F.concat(_s(F.col("n") * 1000), F.lit(".0")).alias("population"))


# ---- landing inputs: listing pages, manifest, digests, JSON records ---------

LISTING_NAMES = ("data.{id}.Current", "data.{id}.AllData", "series", "contacts", "lookup{id}", "data.x")


@memo_frame
def listing_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One directory-listing fragment per page row: a parent link plus one
    file line whose size is the page's length and whose name cycles through
    every landing category."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    pid = F.col("page_id")
    sid = _s(pid)
    k = pid % 6
    name = (F.when(k == 0, F.concat(F.lit("data."), sid, F.lit(".Current")))
             .when(k == 1, F.concat(F.lit("data."), sid, F.lit(".AllData")))
             .when(k == 2, F.lit("series")).when(k == 3, F.lit("contacts"))
             .when(k == 4, F.concat(F.lit("lookup"), sid)).otherwise(F.lit("data.x")))
    fname = F.concat(F.lit("pr."), name)
    line = F.concat(
        F.lit('<A HREF="/pub/time.series/">[To Parent Directory]</A><br><br>  '),
        _s(pid % 12 + 1), F.lit("/6/2026  8:30 "),
        F.when(pid % 2 == 0, F.lit("AM")).otherwise(F.lit("PM")),
        F.lit("   "), _s(F.length("html")),
        F.lit(' <A HREF="/pub/time.series/pr/p'), sid, F.lit("/"), fname, F.lit('">'), fname,
        F.lit("</A><br>"))
    return pages.select("page_id", line.alias("html"))


def manifest_state(spark: SparkSession, sf_dir: str, entries: DataFrame) -> DataFrame:
    """Previously recorded (url, last_modified): a third of the files were never
    fetched, a third changed since, a few were recorded without a timestamp."""
    pid = F.col("page_id")
    lm = (F.when(pid % 3 == 1, F.lit("old")).when(pid % 10 == 0, F.lit(None).cast("string"))
           .otherwise(F.col("last_modified")))
    return entries.where(pid % 3 != 2).select("url", lm.alias("last_modified"))


@memo_frame
def stored_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest recorded at the last load: current for even documents, stale for odd."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.sha2("text", 256))
                       .otherwise(F.sha2(F.concat(F.col("text"), F.lit("#")), 256)).alias("digest"))


JSON_COLUMNS = ("Segment", "Orders", "Nation", "Year")


@memo_frame
def json_record_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``{"columns": [...], "data": [{...}, ...]}`` document per nation and
    year: order counts per market segment (some nation names NULL).

    The counts are a partial aggregate over orders ⋈ customer; each document
    then holds one record per segment, a fixed small domain, so the
    per-document collect is bounded however large the tables grow.
    """
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    counts = (orders.join(cust, orders.o_custkey == cust.c_custkey)
              .groupBy("c_nationkey", F.year("o_orderdate").alias("y"), "c_mktsegment")
              .agg(F.count(F.lit(1)).alias("n")))
    j = counts.join(sized_broadcast(nat), counts.c_nationkey == nat.n_nationkey)
    rec = F.struct(F.col("c_mktsegment").alias("Segment"), F.col("n").alias("Orders"),
                   F.when(F.col("c_nationkey") % 4 == 3, F.lit(None).cast("string"))
                    .otherwise(F.col("n_name")).alias("Nation"),
                   F.col("y").alias("Year"))
    grouped = j.groupBy("c_nationkey", "y").agg(F.array_sort(F.collect_list(rec)).alias("data"))
    doc = F.struct(F.array(*[F.lit(c) for c in JSON_COLUMNS]).alias("columns"), F.col("data"))
    return grouped.select((F.col("c_nationkey") * 10000 + F.col("y")).alias("payload_id"),
                          F.to_json(doc, {"ignoreNullFields": "false"}).alias("payload"))
