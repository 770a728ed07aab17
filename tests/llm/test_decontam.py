import numpy as np

from strata.llm import decontam

SF = "/root/testdata/sf0.001"


def brute(docs, items):
    parts = {i: decontam.parts(t or "") for i, t in items if i is not None}
    out = set()
    for d, text in docs:
        words = decontam.words_of(text or "")
        out |= {(d, i) for i, (q, a) in parts.items() if (q or a) and decontam.covered(q, words) >= 0.8
                and decontam.covered(a, words) >= 0.8}
    return out


def pairs(rows):
    return {(r.doc_id, r.item_id) for r in rows}


def test_documents_against_brute_force(spark, docs, odd, nothing):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    listed = [(r.item_id, r.text) for r in items.collect()]
    planted = [(9000 + i, f"Some words before it {t} and after") for i, t in listed]
    words = [t.split() for _, t in listed]
    planted += [(9500 + i, " ".join(w[:len(w) // 2])) for i, w in enumerate(words)]  # half an item is no leak
    more = docs.select("doc_id", "text").union(spark.createDataFrame(planted, "doc_id long, text string"))
    found = pairs(decontam.leaks(more, items).collect())
    assert found == brute(rows + planted, listed)
    assert {(9000 + i, i) for i, _ in listed} <= found
    kept = {r.doc_id for r in decontam.without_leaks(more, items).collect()}
    assert kept == {d for d, _ in rows + planted} - {d for d, _ in found}
    assert decontam.leaks(odd, items).count() == 0 and decontam.leaks(nothing, items).count() == 0
    assert decontam.leaks(docs, items.where("false")).count() == 0
    assert decontam.without_leaks(odd, items).count() == odd.count()


def test_given_answers_long_items_and_nulls(spark):
    long = " ".join(f"word{i}" for i in range(400))
    items = spark.createDataFrame([(1, long, "the answer is forty two of course"), (2, None, None), (None, long, None), (1, long, "x")][:3],
                                  "item_id long, text string, answer string")
    texts = spark.createDataFrame([(1, f"{long} the answer is forty two of course"), (2, long), (None, f"a {long} the answer is forty two of course")],
                                  "doc_id long, text string")
    assert pairs(decontam.leaks(texts, items, answer_col="answer").collect()) == {(1, 1), (None, 1)}


def test_block_max_search_is_exact():
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(60)]
    pieces = [(n, list(rng.choice(words, rng.integers(5, 30)))) for n in range(70)]
    df = {w: sum(w in p for _, p in pieces) for w in words}
    index = decontam.Index(pieces, df, len(pieces), 15.0)
    queries = [sorted({index.terms[w] for w in rng.choice(words, 25) if w in index.terms}) for _ in range(40)]
    passages = np.repeat(np.arange(40), [len(q) for q in queries])
    for threshold in (0.3, 0.5, 0.7):
        got = {(p, i): s for p, i, s in index.search(passages, np.concatenate(queries), threshold)}
        want = {}
        for p, q in enumerate(queries):
            scores = np.zeros(70)
            which, at = index.pieces.of(np.array(q))
            np.add.at(scores, index.pieces.numbers[at], index.pieces.values[at])
            want |= {(p, int(i)): scores[i] for i in np.flatnonzero(scores >= threshold)}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_one_changed_word_in_an_invented_answer(spark):
    first = "the old harbour town keeps its records of every ship and cargo in a long hall beside the northern gate tower"
    answer = "clerks copied seven ledgers by lamplight every winter"
    short = "which river feeds the mill pond below grey abbey? the slow water of the brindle feeds it"
    texts = {1: f"{first}. {answer}.", 2: f"{short}.", 3: "what lies beyond the zanzibarian hill?"}
    items = spark.createDataFrame(list(texts.items()), "item_id long, text string")
    near = [(1, texts[1].replace("seven", "eight")), (2, texts[2].replace("slow", "cold")), (3, texts[2].replace("slow ", "")),
            (4, texts[2].replace("slow", "very slow")), (5, texts[3].replace("zanzibarian", "green")), (6, f"{first}."),
            (7, texts[2].replace("slow", "cold").replace("mill", "fish")), (8, texts[2].replace("brindle", "zanzibarian"))]
    docs = spark.createDataFrame([(i, f"Some words before it. {t} And some after.") for i, t in near], "doc_id long, text string")
    assert pairs(decontam.leaks(docs, items).collect()) == {(1, 1), (2, 2), (3, 2), (4, 2), (5, 3), (8, 2)}
    given = spark.createDataFrame([(1, first, answer)], "item_id long, text string, answer string")
    assert not pairs(decontam.leaks(docs, given, answer_col="answer").collect())


def test_edits_against_brute_force():
    rng = np.random.default_rng(6)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j - 1] + (x != y), old[j] + 1, row[-1] + 1))
        return row[-1]

    for _ in range(60):
        part, region = (list(rng.choice(list("abcd"), n)) for n in (rng.integers(1, 7), rng.integers(0, 9)))
        want = min(distance(part, region[i:j]) for i in range(len(region) + 1) for j in range(i, len(region) + 1))
        assert decontam.edits(part, region) == want


def test_shards_and_reused_addresses(spark, docs, monkeypatch):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    listed = [(r.item_id, r.text) for r in items.collect()]
    planted = spark.createDataFrame([(9000 + i, f"Some words before it {t} and after") for i, t in listed], "doc_id long, text string")
    some = docs.select("doc_id", "text").limit(100).union(planted)
    whole = pairs(decontam.leaks(some, items).collect())
    monkeypatch.setattr(decontam, "SHARD_ITEMS", -(-len(listed) // 3))
    assert pairs(decontam.leaks(some, items).collect()) == whole

    # one process searches both indexes, and the second's broadcast lies where the first's was
    runs = []
    monkeypatch.setattr(decontam, "mapped", lambda df, run, schema: runs.append(run))
    monkeypatch.setattr(decontam, "id", lambda value: 7, raising=False)
    for word in ("river", "castle"):
        item = spark.createDataFrame([(len(word), [word] * 3, [], False, [[word] * 3])],
                                     "item_id long, question array<string>, answer array<string>, given boolean, pieces array<array<string>>")
        decontam.searched(planted, item, spark.createDataFrame([(word, 1)], "word string, df long"), 2, 3.0)
    batch = spark.createDataFrame([(1, "river " * 3), (2, "castle " * 3)], "doc_id long, text string").toArrow().to_batches()
    assert [[r["doc_id"] for out in run(iter(batch)) for r in out.to_pylist()] for run in runs] == [[1], [2]]
