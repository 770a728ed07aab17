import math

import numpy as np
from pyspark.sql import functions as F

from strata.llm import topk


def brute(rows, queries, k):
    good = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, own in {(i, tuple(v)) for i, v in good if i in queries}:
        scores = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in good if i != q)
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])}
    return out


def got(frame):
    return {(r.query_id, r.rank, r.vec_id, r.score) for r in frame.collect()}


def test_against_brute_force_and_bad_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=24) * (8 if i % 7 else 0.01) * np.r_[np.ones(4), np.full(20, .05)]])
            for i in range(900)]
    rows += [(900, None), (901, [1.0, None]), (902, [float("nan")] * 24), (903, [float("inf")] * 24), (904, []),
             (905, rows[5][1]), (906, [1e9, -1e9]), (None, [1.0] * 24)]
    frame = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, width int, ids string")
    asked = frame.where(F.col("vec_id") % 100 == 0)
    assert got(topk.search(frame, asked, 10)) == brute(rows, set(range(0, 901, 100)), 10)
    few = frame.where("vec_id < 4")
    assert got(topk.search(few, few, 10)) == brute(rows[:4], {0, 1, 2, 3}, 10)
    assert topk.search(frame.where("false"), asked, 10).count() == 0
    assert topk.search(frame, asked.where("false"), 10).count() == 0


def test_maxscore_prunes_and_stays_exact():
    rng = np.random.default_rng(1)
    rows = rng.integers(-50, 50, (4000, 40))
    rows[:, :3] *= 60  # a few components decide, so most lists are non-essential
    shard = topk.Shard(np.arange(4000), rows)
    for own in (0, 17, 3999):
        ids, scores = shard.top(own, rows[own], 10)
        want = sorted((-int(s), i) for i, s in enumerate(rows @ rows[own]) if i != own)[:10]
        assert [(-s, i) for i, s in zip(ids.tolist(), scores.tolist())] == want


def test_no_table_is_broadcast_or_repeated(spark, monkeypatch):
    """Queries times shards once went to the driver in one broadcast: its size grew with the square of the input."""
    monkeypatch.setattr(topk, "SHARD_BYTES", 2048)
    monkeypatch.setattr(topk, "QUERY_BYTES", 1024)
    monkeypatch.setattr(topk, "LANE_RESULTS", 50, raising=False)
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 6) / 1024]) for i in range(400)]  # with many ties
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = topk.search(frame, frame.where("vec_id % 20 = 0"), 5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan and "Generate" not in plan
    assert "RoundRobinPartitioning(2)" in plan  # 20 queries with 5 results each in lanes of 50
    assert got(found) == brute(rows, set(range(0, 400, 20)), 5)


def test_best_carried_through_shards():
    rng = np.random.default_rng(2)
    for _ in range(30):
        top, width, k = int(rng.choice([1, 40, 1 << 22, 1 << 26])), int(rng.integers(0, 20)), int(rng.integers(1, 9))
        ids, queries = rng.integers(0, 60, 7), topk.narrow(rng.integers(-top, top + 1, (7, int(rng.integers(0, 20)))))
        best, all_rows = topk.Best(ids, queries, k), []
        for n in rng.integers(1, 300, 4):
            names, rows = rng.integers(0, 500, n), rng.integers(-top, top + 1, (n, width))
            if rng.random() < 0.3:
                rows[:] = rows[0]
            best.meet(topk.Shard(names, topk.narrow(rows)))
            all_rows += zip(names.tolist(), rows.tolist())
        for at, (own, q) in enumerate(zip(ids.tolist(), queries.tolist())):
            want = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in all_rows if i != own)[:k]
            mine = best.of == at
            assert sorted(zip((-best.scores[mine]).tolist(), best.found[mine].tolist())) == want


def test_blocks_hold_the_smallest_integers():
    for top, size in ((127, 1), (128, 2), (1 << 20, 4), (1 << 40, 8)):
        m = np.array([[top, -top, 0], [1, 2, 3]])
        ids, back = topk.unpack(3, np.array([4, 5]).tobytes(), topk.narrow(m).tobytes())
        assert ids.tolist() == [4, 5] and back.itemsize == size and (back == m).all()
    assert topk.unpack(0, np.array([4, 5]).tobytes(), b"")[1].shape == (2, 0)
