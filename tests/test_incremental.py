"""Silver and gold kept up to date by batches: equal to full builds, exactly once, untouched files kept."""

import glob

import pytest
from pyspark.sql import functions as F

from strata.operators import aggregates, maintained
from strata.plans import gold, maintained_gold, specs
from strata.plans.silver import build_silver
from strata.session import local_dir, scratch_path
from strata.sources import fixtures, manifest
from strata.streaming import incremental, ingest
from tests.conftest import SF_SMALL

DIMENSIONS = ("series", "lookup_measure", "lookup_sector", "lookup_class", "lookup_duration", "lookup_seasonal", "lookup_period")


def rows(df, **digits):
    for c, d in digits.items():
        df = df.withColumn(c, F.round(c, d))
    return sorted(map(str, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


def files(root):
    return {f: open(f, "rb").read() for f in glob.glob(f"{local_dir(root) or root}/data/*/bucket=*/*.parquet")}


def fact(spark, *lines):
    return spark.createDataFrame(lines, ", ".join(f"{c} string" for c in specs.DATA.raw_columns))


@pytest.fixture(scope="module")
def dimensions(spark):
    from strata.plans.silver import silver_table
    out = {}
    for name in DIMENSIONS:
        path = scratch_path(spark, f"test-{name}")
        silver_table(spark, SF_SMALL, name).write.parquet(path)
        out[name] = spark.read.parquet(path)
    return out


def test_each_wave_equals_a_full_build(spark, dimensions):
    root = scratch_path(spark, "test-incremental")
    raw = fixtures.raw_data(spark, SF_SMALL)
    wave = F.pmod(F.xxhash64(*raw.columns), F.lit(3))
    kept = maintained_gold.ProductivityGold(spark, root, dimensions, buckets=4)
    for number in range(3):
        ingest.land(spark, raw.where(wave == number), specs.DATA, f"{root}/landing")
        table = incremental.refresh(spark, specs.DATA, f"{root}/landing", root, buckets=4, then=[kept.follow])
        full = build_silver(raw.where(wave <= number), specs.DATA)
        assert rows(incremental.silver(table, specs.DATA)) == rows(full)
        wide = gold.gold_wide({**dimensions, "data": full})
        found = kept.tables()
        for name, want in {"quarterly": aggregates.quarterly_aggregation(wide), "annual": aggregates.annual_aggregation(wide)}.items():
            assert rows(found[name], avg_value=6) == rows(want, avg_value=6), (name, number)
        assert rows(found["annual_sums"], annual_sum=6) == rows(aggregates.annual_sums(wide), annual_sum=6)
    before = files(table.root), table.last()
    incremental.refresh(spark, specs.DATA, f"{root}/landing", root, buckets=4, then=[kept.follow])  # nothing new
    assert (files(table.root), table.last()) == before


def test_replayed_batch_changes_nothing_and_untouched_buckets_keep_their_files(spark):
    table = incremental.merged_table(spark, specs.DATA, scratch_path(spark, "test-buckets"), buckets=16)
    many = fact(spark, *[(f"s{n}", "2001", "q01", str(n), "") for n in range(200)])
    assert incremental.merge_batch(table, specs.DATA, many, 0)
    first = files(table.root)
    one = fact(spark, ("s7", "2001", "q01", "70", "r"))
    assert incremental.merge_batch(table, specs.DATA, one, 1)
    after = files(table.root)
    assert first.items() <= after.items() and len(after) == len(first) + 1
    placed = table.placed()
    assert sorted(placed.values()).count(1) == 1 and len(placed) == 16
    assert not incremental.merge_batch(table, specs.DATA, many, 1) and files(table.root) == after
    got = {r.series_id: r.value for r in incremental.silver(table, specs.DATA).collect()}
    assert got["S7"] == 70.0 and len(got) == 200
    changed = [(r.series_id, r.value, r.change) for r in incremental.changes(table, specs.DATA, 1).collect()]
    assert sorted(changed) == [("S7", 7.0, -1), ("S7", 70.0, 1)]
    table.vacuum()
    assert len(files(table.root)) == 16 and incremental.silver(table, specs.DATA).count() == 200


def test_a_failed_write_is_not_seen_and_is_repeated(spark):
    table = incremental.merged_table(spark, specs.DATA, scratch_path(spark, "test-failure"), buckets=2)
    incremental.merge_batch(table, specs.DATA, fact(spark, ("a", "2001", "q01", "1", "")), 0)
    # files of a batch whose commit never came
    table.with_bucket(incremental.merged_table(spark, specs.DATA, "x").spark.createDataFrame(
        [("A", 2001, "Q01", 9.0, None, 1, True)], table.schema)).write.partitionBy("bucket").parquet(f"{table.root}/data/batch=1")
    assert [r.value for r in incremental.silver(table, specs.DATA).collect()] == [1.0]
    incremental.merge_batch(table, specs.DATA, fact(spark, ("a", "2001", "q01", "2", "r")), 1)
    assert [r.value for r in incremental.silver(table, specs.DATA).collect()] == [2.0]


def test_revisions_gate_and_odd_rows(spark):
    """A revision wins whether it comes before or after; one that fails the gate hides its key; NULL keys and repeats don't crash."""
    table = incremental.merged_table(spark, specs.DATA, scratch_path(spark, "test-revisions"), buckets=3)
    waves = [[("a", "2001", "q01", "5", "r"), ("b", "2001", "q01", "1", ""), (None, "2001", "q01", "3", ""), ("c", None, None, None, None)],
             [("a", "2001", "q01", "9", ""), ("b", "2001", "q01", "-", "r"), (None, "2001", "q01", "4", ""), ("d", "2001", "q01", "1", "")],
             [("b", "2001", "q01", "2", "r"), ("d", "2001", "q01", "1", ""), ("d", "2001", "q01", "1", "")],
             []]
    seen, counts = [], []
    for number, lines in enumerate(waves):
        seen += lines
        incremental.merge_batch(table, specs.DATA, fact(spark, *lines), number)
        assert rows(incremental.silver(table, specs.DATA)) == rows(build_silver(fact(spark, *seen), specs.DATA))
        counts.append(sorted((r.series_id, r.value, r.change) for r in incremental.changes(table, specs.DATA, number).collect()))
    assert counts == [[("A", 5.0, 1), ("B", 1.0, 1)], [("B", 1.0, -1), ("D", 1.0, 1)], [("B", 2.0, 1)], []]


def test_retracted_extremes_are_looked_up_again(spark):
    by = {"g": "string"}
    from strata.sources.buckets import BucketedTable
    table = BucketedTable(spark, scratch_path(spark, "test-extremes"), ("g",), maintained.state_schema(by), 2)
    one = maintained.MaintainedAggregate(table, ("g",), "value", lambda facts: facts)
    facts, asked = [], []

    def step(batch, added, gone):
        for row in gone:
            facts.remove(row)
        facts.extend(added)
        changes = spark.createDataFrame([(*r, 1) for r in added] + [(*r, -1) for r in gone], "g string, value double, change int")

        def silver():
            asked.append(batch)
            return spark.createDataFrame(facts, "g string, value double")

        assert one.apply(changes, silver, batch)
        assert not one.apply(changes, silver, batch)  # again: nothing
        got = {r.g: (r.rows, r["values"], float(r.total), r.least, r.most) for r in one.state().collect()}
        groups = {g for g, _ in facts}
        want = {g: (len(v), len(v), sum(v), min(v), max(v)) for g in groups for v in [[x for h, x in facts if h == g]]}
        assert got == want
        for r in one.state().select("g", maintained.deviation(one.state()).alias("sd")).collect():
            v = [x for h, x in facts if h == r.g]
            mean = sum(v) / len(v)
            assert abs(r.sd - (sum((x - mean) ** 2 for x in v) / len(v)) ** 0.5) < 1e-6

    step(0, [("a", 1.0), ("a", 5.0), ("a", 9.0), (None, 2.5), ("b", 4.0)], [])
    step(1, [("a", 6.0)], [("a", 5.0)])            # an inner value: nothing to look up
    step(2, [("a", 0.5)], [("a", 1.0)])            # the minimum goes, a smaller value comes
    assert asked == []
    step(3, [("a", 2.0)], [("a", 0.5)])            # the minimum goes
    step(4, [], [("a", 9.0), ("b", 4.0)])          # the maximum goes, a group ends
    assert asked == [3, 4]


def test_manifest_upsert_in_place_equals_upsert(spark):
    old = spark.createDataFrame([(f"u{n}", "8/6/2026  8:30 AM") for n in range(100)] + [("x", None)], manifest.MANIFEST_SCHEMA)
    new = spark.createDataFrame([("u3", "8/7/2026  8:30 AM"), ("u3", "8/6/2026  9:30 AM"), ("y", None)], manifest.MANIFEST_SCHEMA)
    kept = manifest.kept_manifest(spark, scratch_path(spark, "test-manifest"), buckets=16)
    manifest.upsert_in_place(kept, old, 0)
    before = files(kept.root)
    manifest.upsert_in_place(kept, new, 1)
    assert not manifest.upsert_in_place(kept, old, 1)
    after = files(kept.root)
    assert before.items() <= after.items() and 1 <= len(after) - len(before) <= 2
    assert rows(kept.read().drop("bucket")) == rows(manifest.manifest_upsert(old, new))


def test_sums_never_read_the_facts_again(spark):
    from strata.sources.buckets import BucketedTable
    by = {"g": "string"}
    table = BucketedTable(spark, scratch_path(spark, "test-sums"), ("g",), maintained.state_schema(by), 2)
    one = maintained.MaintainedAggregate(table, ("g",), "value", lambda facts: facts, extremes=False, squares=False)
    facts = lambda *lines: spark.createDataFrame(lines, "g string, value double, change int")

    def unread():
        raise AssertionError("facts read")

    one.apply(facts(("a", 1.5, 1), ("a", 4.0, 1), (None, 2.0, 1), ("b", 3.0, 1)), unread, 0)
    one.apply(facts(("a", 1.5, -1), ("b", 3.0, -1), (None, None, 1)), unread, 1)  # the minimum of one group, all of another
    found = {r.g: r.total for r in maintained.sums(one.state(), ("g",), "total").collect()}
    assert found == {"a": 4.0, None: 2.0}


def test_buckets_grow_with_the_facts(monkeypatch):
    from strata.plans import registry
    for size, want in ((None, 8), (1 << 20, 8), (100 << 30, 512), (64 * (64 << 20) + 1, 65)):
        monkeypatch.setattr(registry, "estimated_bytes", lambda raw, size=size: size)
        assert registry._buckets(None) == want
