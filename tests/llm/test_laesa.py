import hashlib
import math

import numpy as np
import pytest

from strata.llm import intvec, laesa

COLUMNS = "vec_id long, embedding array<double>, label int, code string, far string, id long"


def brute(rows, parts, entries, rounds, scale):
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((i, v) for i, v, _ in kept if i is not None)
    width = len(named[0][1])
    size = width // parts
    whole = [k for k in kept if len(k[1]) == width]
    cut = lambda v, p: v[p * size:(p + 1) * size]
    books = [[cut(v, p) for _, v in named if len(v) == width][:entries] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in whole:
                groups.setdefault(near(cut(v, p), books[p])[1], []).append(cut(v, p))
            books[p] = [[sum(x) // len(groups[n]) for x in zip(*groups[n])] if n in groups else e
                        for n, e in enumerate(books[p])]
    out, by_label = [], {}
    for i, v, label in whole:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, "".join(f"{n:02x}" for _, n in found), error, label))
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    coded = [(i, code, error, by_label[label], digest) for i, code, error, label in out]
    return sorted(coded + [(i, None, None, by_label.get(label), digest) for i, v, label in kept if len(v) != width], key=str)


def run(frame, **how):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256)
                   for r in laesa.report(*laesa.compressed(frame, **how)).collect()), key=str)


def test_pivots_prune_and_stay_exact():
    rng = np.random.default_rng(3)
    entries = rng.integers(-3000, 3000, (24, 5))
    entries[20] = entries[4]  # equal entries: the lower index wins
    rows = np.concatenate([entries[rng.integers(0, 24, 3000)] + rng.integers(-60, 61, (3000, 5)), entries])
    fixed = laesa.pivots(entries)
    code, best, tried = laesa.nearest(rows, laesa.from_pivots(rows, fixed), entries, laesa.from_pivots(entries, fixed))
    d = intvec.distances(rows, entries)
    assert (code == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()
    assert tried.mean() < 6  # of 24


def test_large_components_stay_exact():
    entries = np.array([[1 << 27, 0], [(1 << 27) - 1, 0]])
    rows = np.array([[-(1 << 27), 1], [(1 << 27), 1]])
    fixed = laesa.pivots(entries)
    code, best, _ = laesa.nearest(rows, laesa.from_pivots(rows, fixed), entries, laesa.from_pivots(entries, fixed))
    assert code.tolist() == [1, 0] and best.tolist() == [((1 << 28) - 1) ** 2 + 1, 1]


def test_against_brute_force_with_odd_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in rng.normal(0, 1, 12)], int(i) % 3 if i % 4 else None) for i in range(3, 300)]
    rows += [(1000 + i, rows[0][1], 1) for i in range(150)]  # a hot vector
    rows += [(4, rows[7][1], 2), (None, rows[1][1], None), (2000, None, 1), (2001, [1.0] * 11, 7), (2002, [], None),
             (2003, [None] + [1.0] * 11, 1), (2004, [float("nan")] * 12, 1), (2005, [float("inf")] * 12, 1)]
    frame = spark.createDataFrame([(i, v, label, "c", "f", 1) for i, v, label in rows], COLUMNS)
    how = {"parts": 4, "entries": 6, "rounds": 3, "scale": 4096}
    assert run(frame, **how) == brute(rows, **how)
    assert run(frame.where("vec_id < 6"), **how) == brute([r for r in rows if r[0] and r[0] < 6], **how)
    assert run(frame.where("false"), **how) == []
    with pytest.raises(ValueError, match="equal parts"):
        laesa.compressed(frame, parts=5)
