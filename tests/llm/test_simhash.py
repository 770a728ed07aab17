from collections import defaultdict

import numpy as np
import xxhash

from strata.llm import simhash


def plain_fingerprint(text, size=4):
    words = (text or "").encode()
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in words).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, max_bits):
    """rows: (id, fingerprint) -> smallest id of the component of each fingerprint."""
    marks = np.array(sorted({f for _, f in rows}), np.uint64)
    group = list(range(len(marks)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i
    for i, m in enumerate(marks):
        for j in np.flatnonzero(np.bitwise_count(marks ^ m) <= max_bits):
            a, b = root(i), root(int(j))
            group[max(a, b)] = min(a, b)
    place = {int(m): root(i) for i, m in enumerate(marks)}
    ids = defaultdict(set)
    for i, f in rows:
        if i is not None:
            ids[place[f]].add(i)
    return {f: min(ids[p], default=None) for f, p in place.items()}


def check(found, rows, max_bits):
    want = brute(rows, max_bits)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found), key=str) == sorted(
        ((i, f"{f:016x}", want[f]) for i, f in rows), key=str)


def test_documents_against_brute_force(docs):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    check(simhash.near_duplicates(docs).collect(), rows, 4)


def test_odd_rows(odd, nothing):
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in odd.collect()]
    check(simhash.near_duplicates(odd).collect(), rows, 4)
    assert simhash.near_duplicates(nothing).count() == 0
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    # 1 to 3 have fingerprint zero, 4 and 8 are copies, 5 is a repeated row, the row without an id stays
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "4", "5", "6", "7", "None"]


def test_links_of_dense_and_chained_fingerprints(spark):
    rng = np.random.default_rng(3)
    marks = []
    for _ in range(30):  # clusters around a centre, and chains that drift away from it
        centre = int(rng.integers(0, 2**63))
        marks.append(centre)
        for _ in range(25):
            at = centre if rng.random() < 0.5 else marks[-1]
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                at ^= 1 << int(b)
            marks.append(at)
    signed = np.array(marks, np.uint64).view(np.int64).tolist()
    for bits in (2, 3, 4, 6):
        frame = spark.createDataFrame([(s, 1) for s in set(signed)], "fp long, n long")
        from strata.llm.common import components
        label = {r.node: r.label for r in components(simhash.links(frame, bits), "t").collect()}
        groups = defaultdict(set)
        for s in set(signed):
            groups[label.get(s, s)].add(s)
        want = defaultdict(set)
        place = brute([(i, m) for i, m in enumerate(marks)], bits)
        for m, s in zip(marks, signed):
            want[place[m]].add(s)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
