import corpus_pipeline

SF = "/root/testdata/sf0.01"


def test_stages_take_effect_and_keep_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, SF)
        assert after.columns == docs.columns, name
        assert {r.doc_id for r in after.select("doc_id").collect()} <= {r.doc_id for r in kept.select("doc_id").collect()}
        kept = after
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} == ids and all(r.parity and r.round_trip for r in out)


def test_filters_decide_by_row_and_take_odd_rows(spark, odd, nothing):
    """Null and repeated ids: a toxic or leaking row goes by its own text, clean rows of its id stay."""
    from pyspark.sql import functions as F
    from strata.llm import toxicity
    from strata.llm.queries import toxicity_model
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = toxicity.scored(docs, toxicity_model(spark, SF, docs)).where("score > 0.6").select("doc_id")
    toxic = docs.join(found, "doc_id").orderBy("doc_id").select("text").limit(3).collect()
    assert len(toxic) == 3
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 150").limit(2).collect()
    clean = "a quiet afternoon by the river with nothing else to report at all"
    rows = [(None, r.text) for r in toxic] + [(7, toxic[0].text), (7, clean), (None, clean), (8, leak[0].text), (8, clean),
                                              (None, leak[1].text), (9, None), (9, "")]
    mixed = docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "n_chars": F.lit(0)}), allowMissingColumns=True)
    kept = corpus_pipeline.drop_toxic(spark, mixed, SF).where("lang = 'xx'")
    left = sorted((str(r.doc_id), r.text or "") for r in kept.collect())
    assert left == sorted([("7", clean), ("None", clean), ("8", leak[0].text), ("8", clean), ("None", leak[1].text), ("9", ""), ("9", "")])
    kept = corpus_pipeline.drop_leaks(spark, mixed, SF).where("lang = 'xx'")
    left = sorted((str(r.doc_id), r.text or "") for r in kept.collect())
    assert [r for r in left if r[1] in (leak[0].text, leak[1].text)] == [] and ("8", clean) in left and left.count(("9", "")) == 2
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).count() == 0, name
        out = stage(spark, odd, SF)
        assert out.count() <= odd.count() and (name == "sentencepiece" or out.columns == odd.columns), name
