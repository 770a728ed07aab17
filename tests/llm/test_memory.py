"""What a worker holds: one operator's memory at a time, and the words of few texts at once."""

import numpy as np
import pyarrow as pa
import public_tokenizers

from strata.llm import common, spm, toxicity


def test_a_worker_forgets_what_another_operator_remembers(spark):
    rows = spark.range(64, numPartitions=32)

    @common.holding("first")
    def first(batches):
        import os
        built = []
        common.held("first", lambda: built.append(1))
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"pid": pa.array([os.getpid()], pa.int64()), "n": pa.array([len(built)], pa.int64())})

    def second(batches):
        kept = "token" in common._HELD
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"kept": pa.array([kept])})

    once = common.mapped(rows, first, "pid long, n long").collect()
    again = common.mapped(rows, first, "pid long, n long").collect()
    builds = {}
    for r in once + again:
        builds[r.pid] = builds.get(r.pid, 0) + r.n
    assert max(builds.values()) == 1  # its own memory stays from task to task
    assert not any(r.kept for r in common.mapped(rows, second, "kept boolean").collect())


def caught(monkeypatch, module, call):
    """The function that ``call`` gives to ``mapped``."""
    runs = []
    with monkeypatch.context() as patch:
        patch.setattr(module, "mapped", lambda df, run, schema: runs.append(run))
        call()
    return runs[0]


def test_texts_are_read_a_few_at_once_with_equal_results(spark, monkeypatch):
    texts = [f"word{i} idiot{i % 7} plain. you stupid{i % 3} thing, " * 40 for i in range(700)]
    model = toxicity.Model(toxicity.Landmarks(["^idio", "^stup"]), 0.5)
    model.weights = np.linalg.lstsq(model.map, np.ones(len(model.map)), rcond=None)[0]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    chosen = docs.selectExpr("text", "1 AS label")
    seen, features, encode = [], toxicity.Tester.features, spm.Codec.encode
    watched = lambda plain: lambda self, own: seen.append(sum(map(len, own))) or plain(self, own)
    monkeypatch.setattr(toxicity.Tester, "features", watched(features))
    monkeypatch.setattr(spm.Codec, "encode", watched(encode))
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(700), pa.int64()), "text": texts})
    learn = pa.RecordBatch.from_pydict({"text": texts, "label": pa.array([1] * 700, pa.int32())})
    owner, kernels = features(toxicity.Tester(model.landmarks), texts)
    score = model.score(owner, kernels, 700)

    run = caught(monkeypatch, toxicity, lambda: toxicity.scored(docs, model))
    found = pa.Table.from_batches(run(iter([batch])))
    assert np.allclose(found["score"].to_numpy(), score, rtol=0, atol=1e-12)
    run = caught(monkeypatch, toxicity, lambda: toxicity.without_toxic(docs, model, float(np.median(score))))
    assert sum(out.num_rows for out in run(iter([batch]))) == (score < np.median(score)).sum()
    run = caught(monkeypatch, toxicity, lambda: toxicity.examples(chosen, model))
    assert pa.Table.from_batches(run(iter([learn]))).num_rows == 700
    path = public_tokenizers.path("piece_bpe_32k.model")
    run = caught(monkeypatch, spm, lambda: spm.encoded(docs, path))
    assert all(r["parity"] and r["round_trip"] for out in run(iter([batch])) for r in out.to_pylist())
    assert max(seen) <= 256 << 10 and len(seen) > 12
