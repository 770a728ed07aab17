"""Every registered query against its DuckDB oracle on the smallest tables
(the full gate runs the same comparison at sf0.01: tools/compare.py)."""

import datetime as dt
import math

import pytest

import __spark_entry__ as entry
from strata.plans import registry
from tests.conftest import SF_SMALL

KEYS = sorted(registry.QUERIES)  # the training-data package tests its own queries


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return repr(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(registry.ORACLE) == set(registry.QUERIES)
    assert set(KEYS) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert len(KEYS) >= 66


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, key):
    df = entry.queries()[key](spark, SF_SMALL)
    rel = duck.sql(entry.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    want = rel.fetchall()
    assert want  # empty against empty shows nothing
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(rel.columns, want)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_measures_are_distinct_and_questions_have_rows(sf):
    import duckdb

    from strata.plans.oracle import with_ctes
    from strata.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/{sf}/{t}.parquet')")
    texts = con.execute(with_ctes("SELECT measure_text FROM s_measure", "s_measure")).fetchall()
    assert len(set(texts)) == len(texts) == 20
    for key in KEYS:
        if key.startswith("ask_"):
            assert con.execute(registry.ORACLE[key]).fetchall(), key


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["series_id", "series_label", "year", "annual_sum"]
    assert df.count() > 0


def test_no_query_plans_python_nested_loops_or_sort_merge(spark):
    """The plan properties PLANS.md reports, asserted for every registered query."""
    bad = {}
    for key in KEYS:
        plan = entry.queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        found = [n for n in ("NestedLoopJoin", "SortMergeJoin", "CartesianProduct", "ArrowEvalPython",
                             "BatchEvalPython", "FlatMapGroupsInPandas") if n in plan]
        if found:
            bad[key] = found
    assert bad == {}
