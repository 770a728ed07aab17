"""Language, quality and toxicity: held-out accuracy, odd rows, and the models' own arithmetic."""

from collections import Counter

import numpy as np
import pytest

from strata.llm import langid, quality, queries, toxicity

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    found = queries.op1_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert len(found) == 1000 and len(held) > 200
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in found) and sum(not r.rejected for r in found) > 950


def test_language_odd_rows(odd, nothing):
    rows = {str(r.doc_id): r for r in langid.predict(odd, langid.train(odd)).collect()}
    assert {i for i, r in rows.items() if r.lang_pred == "und"} == {"1", "2", "3"}
    assert all(r.lang_pred == "en" for i, r in rows.items() if i not in "123")
    none = langid.predict(odd, langid.train(nothing)).collect()
    assert {r.lang_pred for r in none} == {"und"} and len(none) == odd.count()


def test_kneser_ney_sums_to_one_and_matches_a_plain_version():
    words = ["the", "then", "hat", "tea", "eat", "the", "at"] * 3 + ["heath"]
    keys, sizes = langid.grams(words)
    assert sizes.tolist() == [len(w) + 1 for w in words]
    found, n = np.unique(keys, return_counts=True)
    model = langid.Model({"xx": (found, n)})

    counts = {4: Counter(keys.tolist())}
    for k in (3, 2, 1):
        counts[k] = Counter(g & ((1 << 16 * k) - 1) for g in counts[k + 1])
    alphabet = len(counts[1]) + 1

    def plain(gram, k):
        if k == 0:
            return 1 / alphabet
        once, twice = (sum(v == m for v in counts[k].values()) for m in (1, 2))
        cut = once / (once + 2 * twice) if once else 0.5
        same = [v for g, v in counts[k].items() if g >> 16 == gram >> 16]
        lower = plain(gram & ((1 << 16 * (k - 1)) - 1), k - 1)
        if not same:
            return lower
        return max(counts[k].get(gram, 0) - cut, 0) / sum(same) + min(1, cut * len(same) / sum(same)) * lower

    chars = [g for g in counts[1]]
    for history in {int(k) >> 16 for k in found.tolist()[::3]} | {0x7A007A007A}:
        p = np.exp(model.logs(np.array([history << 16 | c for c in chars], np.uint64))[:, 0])
        assert p == pytest.approx([plain(history << 16 | c, 4) for c in chars])
        assert p.sum() == pytest.approx(1 - (1 - p.sum()), abs=1) and p.sum() < 1.0001


def random_texts(n_words):
    rng = np.random.default_rng(3)
    letters = {"aa": list("abcdefghijklmnopqrstuvwxyz"), "bb": list("ghijklmnopqrstuvwxyzäöüßéè"), "cc": [chr(0x4E00 + i) for i in range(300)]}
    return [(lang, " ".join("".join(rng.choice(own, 8)) for _ in range(500))) for lang, own in letters.items() for _ in range(n_words // 500)]


def test_language_model_keeps_every_gram(spark):
    texts = random_texts(80_000)
    docs = spark.createDataFrame(texts, "lang string, text string")
    learned = langid.train(docs).models[0].value
    keys = [langid.grams(" ".join(t for x, t in texts if x == lang).split())[0] for lang in learned.langs]
    assert min(len(np.unique(k)) for k in keys) > 200_000
    assert np.array_equal(learned.levels[-1].keys, np.unique(np.concatenate(keys)))


def test_split_language_models_equal_one(spark):
    texts = random_texts(1000)
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(texts + [(None, "unseen words ünd 丁七"), ("aa", None)])],
                                 "doc_id long, lang string, text string")
    one, many = langid.train(docs), langid.train(docs, cells=5000)
    assert len(one.models) == 1 and len(many.models) > 5
    keys = langid.grams(" ".join(t for _, t in texts).split() + ["zzzßzq", "丁abc", "x"])[0]
    assert np.allclose(one.logs(keys), many.logs(keys), rtol=1e-12, atol=0)
    assert sorted(map(str, langid.predict(docs, one).collect())) == sorted(map(str, langid.predict(docs, many).collect()))


def test_quality_held_out(spark):
    found = queries.op8_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)


def test_quality_odd_rows_and_missing_labels(spark, odd, nothing):
    rows = quality.statistics(odd)
    assert rows.count() == odd.count() and all(np.isfinite(r.x).all() for r in rows.collect())
    labels = spark.createDataFrame([(4, 1), (5, 1), (6, None)], "doc_id long, label int")
    one = quality.scored(rows, quality.fit(rows.join(labels, "doc_id"))).collect()
    assert len(one) == odd.count() and {round(r.score, 3) for r in one} == {0.8}  # (3 + 1) / (3 + 2)
    assert {r.score for r in quality.scored(rows, quality.fit(rows.join(labels, "doc_id").where("false"))).collect()} == {0.5}
    assert quality.scored(quality.statistics(nothing), quality.Discriminant({})).count() == 0


def test_discriminant_matches_the_gaussian_densities():
    rng = np.random.default_rng(2)
    x = {c: rng.normal(c, 1 + c, (500, 5)) @ rng.normal(size=(5, 5)) for c in (0, 1)}
    moments = {c: (len(v), v.sum(axis=0), v.T @ v) for c, v in x.items()}
    model = quality.Discriminant(moments, pool=0.0, ridge=0.0, temper=1.0)
    at = np.vstack((x[0][:20], x[1][:20]))
    logs = []
    for c in (0, 1):
        mean, cov = x[c].mean(axis=0), np.cov(x[c].T, bias=True)
        d = at - mean
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) - 0.5 * np.log(np.linalg.det(cov)) + np.log(0.5))
    assert model.score(at) == pytest.approx(1 / (1 + np.exp(logs[0] - logs[1])))


def plain_kernel(s, t):
    """Sum over common subsequences of decay to the spans, by enumeration."""
    from itertools import combinations
    spots = {}
    for word, side in ((s, 0), (t, 1)):
        for at in combinations(range(len(word)), toxicity.LENGTH):
            key = "".join(word[i] for i in at)
            spots.setdefault(key, ([], []))[side].append(toxicity.DECAY ** (at[-1] - at[0] + 1))
    return sum(sum(a) * sum(b) for a, b in spots.values())


def test_string_kernel():
    words = ["^idiot", "^id.iot"[:7], "^idxiot", "^moron", "^the", "^idiotic"]
    for a in words:
        for b in words:
            got = toxicity.kernel(toxicity.coded([a], 10), toxicity.coded([b], 9))[0]
            assert got == pytest.approx(plain_kernel(a, b), rel=1e-5)


def test_kernels_of_masked_and_broken_words():
    marks = toxicity.Landmarks(["^stup", "^idio", "^tras", "^idiotic", "^nnana"])
    words = ["st*pid", "stvpid", "tr4sh", "idi0t", "idiot", "iditoic", "nanana", "banana", "the", "started", "plain", "x" * 30 + "idiot", ""]
    rows, values = marks([toxicity.plain(w) for w in words])
    found = np.zeros((len(words), len(marks.words)))
    found[rows] = values
    size = [plain_kernel(m, m) ** 0.5 for m in marks.words]
    for i, word in enumerate(words):
        if len(word) < toxicity.WINDOW:
            assert found[i] == pytest.approx([plain_kernel(toxicity.plain(word), m) / z for m, z in zip(marks.words, size)], rel=1e-5)
    assert (found[:4].max(axis=1) > 0).all() and found[-2].max() > 0 and not found[-1].any()

    for text in ("you id iot there", "such i  d\ti\no t", "an i d-i o t.", "of an (id iot), maybe", "you idi ot!", "an i . d * i . o t"):
        joined, number = toxicity.sentences(text)
        assert "idiot" in joined and len(joined) == len(number) and (np.diff(number) >= 0).all()
    assert toxicity.sentences("longer words only. nothing joined")[0] == ["longer", "words", "only.", "nothing", "joined"]


def test_toxicity_held_out_gaps_and_odd_rows(spark, odd, nothing):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = queries.toxicity_model(spark, SF, docs)
    found = queries.toxicity.scored(docs, model).join(labels, "doc_id").where(
        "crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0").collect()  # rows whose labels were not learned
    clean = [r.score >= 0.5 for r in found if r.toxic == 0]
    assert np.mean(clean) < 0.03 and np.mean([r.score >= 0.5 for r in found if r.toxic == 1]) > 0.65
    texts = ["You idiot.", "You i.d.i.o.t!", "You idxiot.", "such a i d i o t", "Nothing to see in this plain line."]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scores = {r.doc_id: r.score for r in toxicity.scored(rows, model).collect()}
    assert min(scores[i] for i in (0, 1, 3)) >= 0.5 and scores[2] > 2 * scores[4] and scores[4] < 0.5
    assert toxicity.scored(odd, model).count() == odd.count()
    assert toxicity.scored(nothing, model).count() == 0
    empty = toxicity.fit(docs, labels.where("false"), label_col="toxic")
    assert {r.score for r in toxicity.scored(odd, empty).collect()} == {0.5}


def test_toxicity_learns_rare_insults_and_ignores_chance(spark):
    rng = np.random.default_rng(5)
    vocabulary = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(3, 10))) for _ in range(2000)]
    insults, share = ["blorgnak", "snivelwit", "crudfaced", "zogmutt", "dreckhole", "fumblewump"], [0.5, 0.25, 0.15, 0.07, 0.02, 0.01]
    rows = []
    for i in range(4000):
        words = rng.choice(vocabulary, 40).tolist()
        if i % 4 == 0:
            words[rng.integers(40)] = rng.choice(insults, p=share)
        rows.append((i, int(i % 4 == 0), " ".join(map(str, words))))
    texts = spark.createDataFrame(rows, "doc_id long, label int, text string")
    model = toxicity.fit(texts, texts)
    assert sorted(w[1:5] for w in model.landmarks.words) == sorted(w[:4] for w in insults)
    probe = spark.createDataFrame([(i, f"some clean words and {w} more") for i, w in enumerate(insults + ["nothing"])],
                                  "doc_id long, text string")
    scores = [r.score for r in toxicity.scored(probe, model).orderBy("doc_id").collect()]
    assert min(scores[:-1]) > 0.5 and scores[-1] < 0.1


def test_near_copies_are_one_family():
    text = " ".join(f"word{i}" for i in range(60))
    copy = text.replace("word30", "other")
    alone = " ".join(f"thing{i}" for i in range(60))
    a, b, c, d = toxicity.families([toxicity.sketch(t) for t in (text, alone, copy, "")])
    assert a == c and len({a, b, d}) == 3


def test_kernels_are_gathered_a_few_sentences_at_once(monkeypatch):
    import tracemalloc
    landmarks = toxicity.Landmarks([f"^{a}{b}idiot" for a in "abcdefgh" for b in "klmnopqr"])
    texts = ["You idiot. What a moronic idiot and an idiotic banana! Fine day.", None, "", "no words of them", "i d i o t s, 1d1ots " * 3] * 3
    whole = toxicity.Tester(landmarks).features(texts)
    monkeypatch.setattr(toxicity, "GATHERED", 2)
    found = toxicity.Tester(landmarks).features(texts)
    assert (found[0] == whole[0]).all() and (found[1] == whole[1]).all() and len(whole[0])
    monkeypatch.undo()
    tester, long = toxicity.Tester(landmarks), "idiot " * 99_999 + "idiot"  # one sentence to a text, many words
    tester.features(["idiot"])
    tracemalloc.start()
    tester.features([long.replace("idiot idiot ", "idiot idiot. ")])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100_000 * len(landmarks.words) * 8  # less than all words' kernels


def test_known_words_cost_no_python_call_each():
    import sys
    tester, calls = toxicity.Tester(toxicity.Landmarks(["^idio", "^stup"])), []
    texts = ["You idiot, is it so? No i d i o t of 2 am! Plain longer words, stupid ones. " * 50] * 4
    tester.features(texts)
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event == "call" else None)
    try:
        owner, kernels = tester.features(texts)
    finally:
        sys.setprofile(None)
    assert len(kernels) and len(calls) < sum(len(t.split()) for t in texts) / 2


def test_words_and_sentences_of_many_texts_are_those_of_each():
    import re
    rng = np.random.default_rng(4)
    few = r"(?=\S)(?:[^\w\s]*\w){0,3}[^\w\s]*"
    runs = re.compile(rf"(?<!\S){few}(?:\s+{few})+(?!\S)")
    letters = list("abdiIost.!?,-_12\u00b2\u00bd\u00df\u0130\u00e9\u4e2d\u200b") + [" "] * 12 + ["\n", "\t", "\x1c", "\x85", "\u3000", "\xa0"]
    texts = ["".join(rng.choice(letters, size)) for size in (0, 1, 2, 5, 40, 80, 300, 900) for _ in range(6)] + [None, " ", ".", "a b"]
    landmarks = toxicity.Landmarks([f"^{a}{b}{c}o" for a in "abi" for b in "dst" for c in "iot"] + ["^sotsabtistoabdiostabiso"])
    tester = toxicity.Tester(landmarks)
    owner, kernels = tester.features(texts)
    assert len(landmarks.packed) > 2 and len(owner) > 50 and (np.diff(owner) >= 0).all()
    for i, text in enumerate(texts):
        low = (text or "").lower()
        parts = [(0, w) for w in low.split()]
        for at in range(1, len(parts)):
            parts[at] = (parts[at - 1][0] + (parts[at - 1][1][-1] in ".!?"), parts[at][1])
        behind = parts[-1][0] + 1 if parts else 0
        for n, m in enumerate(runs.finditer(low)):
            own = [toxicity.plain(w)[1:] for w in m.group().split()]
            parts += [(behind + n, "".join(own[k:k + 24])[:23]) for k in range(len(own) - 1) if own[k]]
        words, number = toxicity.sentences(low)
        assert list(zip(number, words)) == parts
        rows, values = landmarks([toxicity.plain(w) for _, w in parts])
        best: dict[int, np.ndarray] = {}
        for r, v in zip(rows, values):
            best[parts[r][0]] = np.maximum(best.get(parts[r][0], 0), v)
        assert np.allclose(np.array([best[n] for n in sorted(best)]).reshape(len(best), len(landmarks.words)),
                           kernels[owner == i], rtol=1e-6)


def test_shared_letters_are_those_of_the_longest_common_subsequence():
    rng = np.random.default_rng(3)
    words = sorted({"^" + "".join(rng.choice(list("abcde"), rng.integers(1, 22))) for _ in range(80)})
    landmarks = toxicity.Landmarks(sorted({w[:24] for w in words[::8]}))

    def longest(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            before = row[:]
            for j, y in enumerate(b):
                row[j + 1] = before[j] + 1 if x == y else max(row[j], before[j + 1])
        return row[-1]

    rows, values = landmarks(words)
    found = {(words[r], landmarks.words[k]) for r, k in zip(rows[np.nonzero(values)[0]], np.nonzero(values)[1])}
    assert found == {(w, m) for w in words for m in landmarks.words if longest(w, m) >= toxicity.LENGTH}
