import random

from strata.llm import substring


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(n))


def test_planted_passages_are_cut_and_clean_texts_stay(spark):
    rng = random.Random(6)
    passages = [prose(rng, 80) for _ in range(12)]
    rows, holds = [], {}
    for i in range(200):
        text = prose(rng, rng.randint(30, 400))
        if i % 3 == 0:
            words, p = text.split(), i % 12
            at = rng.randint(0, len(words))
            text = " ".join(words[:at] + [passages[p]] + words[at:])
            holds.setdefault(p, []).append(i)
        rows.append((i, text))
    frame = spark.createDataFrame([(i, t, len(t), "c", i) for i, t in rows], "doc_id long, text string, n_chars long, hash string, idx long")
    found = substring.repeats(frame).collect()
    repeated = {i for own in holds.values() for i in own[1:]}
    assert {r.doc_id for r in found} == repeated
    assert all(r.kept_doc_id < r.doc_id and r.n_words >= 35 for r in found)
    after = {r.doc_id: r for r in substring.without_repeats(frame).collect()}
    for p, own in holds.items():
        assert [i for i in own if passages[p] in after[i].text] == own[:1]
    assert all(after[i].text == t for i, t in rows if i not in repeated)
    assert all(r.n_chars == len(r.text) and r.idx == i for i, r in after.items())


def test_near_copies_link_by_jaccard(spark):
    rng = random.Random(1)
    texts = [prose(rng, 60) for _ in range(40)]
    near = [" ".join(w if k != 3 else "changed" for k, w in enumerate(t.split())) for t in texts]
    frame = spark.createDataFrame(list(enumerate(texts + near)), "doc_id long, text string")
    found = {r.doc_id: r.kept_doc_id for r in substring.repeats(frame).collect()}
    assert all(found.get(40 + i) == i for i in range(40))


def test_words_repeated_over_and_over_are_a_passage(spark):
    rng = random.Random(3)
    rows = [(period * 20 + i, " ".join([prose(rng, rng.randint(5, 60))] + [" ".join(unit)] * (60 // period + i) + [prose(rng, rng.randint(5, 60))]))
            for period in (1, 2, 3, 5) for unit in [prose(rng, period).split()] for i in range(12)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in substring.repeats(frame).collect()}
    assert set(found) == {i for i, _ in rows if i % 20}
    assert all(r.n_words >= 40 for r in found.values())
    left = {r.doc_id: r.text.split() for r in substring.without_repeats(frame).collect()}
    for i, words in left.items():
        runs = [w for w in range(len(words) - 50) if len(set(words[w:w + 51])) <= 5]
        assert bool(runs) == (i % 20 == 0)


def test_bands_find_similar_sets():
    rng = random.Random(2)
    hit = []
    for _ in range(300):
        words = prose(rng, 64).split()
        tool = substring.Cutter()
        pair = []
        for own in (words, words[:2] + ["other"] + words[3:]):  # three shingles of 60 differ
            h, _ = tool.words([" ".join(own)])
            pair.append(tool.keys(h, substring.np.array([0]))[0])
        hit.append(bool((pair[0] == pair[1]).any()))
    assert sum(hit) / len(hit) > 0.97


def test_odd_rows(odd, nothing):
    found = substring.repeats(odd).collect()
    assert {(r.doc_id, r.kept_doc_id) for r in found} == {(4, 4), (8, 4)}
    after = substring.without_repeats(odd)
    assert after.columns == odd.columns
    ids = sorted(str(r.doc_id) for r in after.collect())
    assert ids == sorted(["1", "2", "3", "4", "5", "5", "None", "6", "7"])  # of 8, a copy of 4, nothing is left
    assert substring.without_repeats(nothing).count() == 0


def test_texts_that_share_an_id_are_cut_each_by_itself(spark):
    rng = random.Random(11)
    long, short, own = prose(rng, 120), prose(rng, 3), prose(rng, 90)
    rows = [(1, long), (2, long), (2, short), (2, None), (3, own), (3, own + " " + long), (3, own)]
    after = substring.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    left = sorted((r.doc_id, r.text or "") for r in after)
    assert (1, long) in left and (2, short) in left and (2, "") in left and (2, long) not in left
    assert sum(long in t for _, t in left) == 1
    assert any(own in t for i, t in left if i == 3)


def test_crowded_buckets_lose_no_link(spark):
    """Prefix tokens against all pairs: many sets that share most shingles, few of them similar."""
    rng = random.Random(5)
    common = [rng.getrandbits(62) for _ in range(12)]
    sets = {}
    for n in range(300):
        own = set(rng.sample(common, rng.randint(4, 12))) | {rng.getrandbits(62) for _ in range(rng.choice((0, 1, 2, 4)))}
        sets[n] = sorted(own)
    frame = spark.createDataFrame(list(sets.items()), "hash long, shingles array<long>")
    buckets = spark.createDataFrame([(7, n, 5 if n == 0 else 1) for n in sets] + [(8, n, 1) for n in range(20)],
                                    "key long, hash long, n long")
    found = substring.near_links(buckets, frame).collect()
    alike = lambda a, b: len(set(sets[a]) & set(sets[b])) >= 0.8 * len(set(sets[a]) | set(sets[b])) - 1e-12
    assert all(alike(r.a, r.b) for r in found)
    head = {n for n in sets if alike(n, 0)}
    linked = {frozenset((r.a, r.b)) for r in found}
    for a in sets:
        for b in range(a):
            if alike(a, b) and not (a in head and b in head):
                assert frozenset((a, b)) in linked, (a, b)
