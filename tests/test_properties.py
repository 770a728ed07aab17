"""Property tests: dedup and the quality gate against brute force in Python."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from strata.operators.dedup import deduplicate
from strata.operators.quality import expect_all_or_drop

ROWS = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(1899, 1902),
                          st.one_of(st.none(), st.sampled_from([1.0, 2.5, -3.0])),
                          st.sampled_from(["R", "X", None])), min_size=0, max_size=25)
SCHEMA = "k string, y int, v double, f string"


def _sort_key(row):
    """preference R first, then v DESC NULLS LAST, then f ASC NULLS LAST."""
    k, y, v, f = row
    return (0 if f == "R" else 1, v is None, -(v or 0.0), f is None, f or "")


def _brute(rows):
    best = {}
    for r in rows:
        key = (r[0], r[1])
        if key not in best or _sort_key(r) < _sort_key(best[key]):
            best[key] = r
    return sorted(best.values(), key=repr)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS)
def test_dedup_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    out = deduplicate(df, ["k", "y"], "f", "R", order_by=[F.col("v").desc_nulls_last(), F.col("f").asc_nulls_last()])
    assert sorted((tuple(r) for r in out.collect()), key=repr) == _brute(rows)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS)
def test_gate_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    out = expect_all_or_drop(df, {"k": "k IS NOT NULL", "y": "y > 1900", "v": "v IS NOT NULL"})
    expected = sorted((r for r in rows if r[0] is not None and r[1] > 1900 and r[2] is not None), key=repr)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == expected
