import hashlib
import math

import numpy as np
import pytest

from strata.llm import intvec, zonemap

COLUMNS = "vec_id long, embedding array<double>, cluster int, ids string, distance string"


def good(vector, width):
    return vector is not None and len(vector) == width and all(x is not None and math.isfinite(x) for x in vector)


def brute(rows, k, rounds, width, scale, seed):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if good(v, width)]
    start = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    centroids = [v for _, v in start]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        centroids = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else c
                     for n, c in enumerate(centroids)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    return sorted(found, key=str), centroids


def run(frame, **how):
    found, centroids = zonemap.clusters(frame, **how)
    return sorted(((r.id, r.cluster, r.distance) for r in found.collect()), key=str), centroids


@pytest.mark.parametrize("bits,dims", [(4, 2), (3, 3), (2, 4)])
def test_hilbert_neighbours_differ_by_one_step(bits, dims):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
    keys = [k.tobytes() for k in zonemap.hilbert(cells, bits)]
    assert len(set(keys)) == len(cells)
    walk = cells[sorted(range(len(keys)), key=keys.__getitem__)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_boxes_never_lose_the_nearest_centroid():
    rng = np.random.default_rng(0)
    pruned = 0
    for _ in range(300):
        centre = rng.integers(-300, 300, 6)
        rows = centre + rng.integers(-40, 41, (20, 6))
        centroids = rng.integers(-300, 300, (12, 6))
        centroids[3] = centroids[9]  # a tie
        among = zonemap.candidates(rows.min(axis=0), rows.max(axis=0), centroids)
        best = intvec.distances(rows, centroids).argmin(axis=1)
        assert (among[intvec.distances(rows, centroids[among]).argmin(axis=1)] == best).all()
        pruned += len(centroids) - len(among)
    assert pruned > 1000


def test_against_brute_force_with_odd_rows(spark):
    rng = np.random.default_rng(7)
    rows = [(int(i), [float(x) for x in rng.normal(rng.integers(0, 5), 0.3, 8)]) for i in range(400)]
    rows += [(500 + i, rows[0][1]) for i in range(300)]  # a hot vector
    rows += [(5, rows[9][1]), (5, rows[5][1]), (None, rows[3][1]), (900, None), (901, [1.0] * 7), (902, [1.0] * 9),
             (903, [None] + [1.0] * 7), (904, [float("nan")] * 8), (905, [float("-inf")] + [0.0] * 7), (906, []),
             (907, [-1e4] * 8), (908, [0.0] * 8)]
    frame = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], COLUMNS)
    how = {"k": 6, "rounds": 4, "width": 8, "scale": 1024, "seed": 3}
    want, centroids = brute(rows, **how)
    got, found = run(frame, **how)
    assert got == want and found.tolist() == centroids
    report = zonemap.report(*zonemap.clusters(frame, **how)).collect()
    assert len(report) == len(want) and {r.inertia for r in report} == {sum(d for _, _, d in want)}
    for n, c in enumerate(centroids):
        mine = [r for r in report if r.cluster == n]
        assert {r.cluster_inertia for r in mine} <= {sum(d for _, k, d in want if k == n)}
        assert {r.centroid_sha256 for r in mine} <= {hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()}
    few = frame.where("vec_id < 3")
    assert run(few, **how)[0] == brute(rows[:3], **how)[0]  # fewer vectors than centroids
    assert zonemap.report(*zonemap.clusters(frame.where("false"), **how)).count() == 0
    assert run(frame.where("vec_id IS NULL"), **how)[0] == []  # no id, no centroid
    with pytest.raises(Exception, match="a component beyond"):
        run(spark.createDataFrame([(1, [1e30] * 8, 1, "", "")], COLUMNS), **how)
