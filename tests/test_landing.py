from pyspark.sql import functions as F

from strata.sources import manifest

PAGE = """<pre>
 <A HREF="/pub/time.series/">[To Parent Directory]</A><br>
 12/31/2019 11:59 PM           77 <A HREF="/pub/time.series/pr/xx.tiny">xx.tiny</A><br>
   1/2/2031  1:05 AM      9000001 <a href="/pub/time.series/pr/xx.data.12.AllData">xx.data.12.AllData</a><br>
  2/29/2024 12:00 PM            0   <A HREF="/pub/time.series/pr/odd name.txt"> odd name.txt  </A><br></pre>"""


def _entries(spark, *pages):
    return manifest.parse_listing(spark.createDataFrame([(p,) for p in pages], "html string"))


def test_parse_listing(spark):
    rows = {r.filename: (r.url.rpartition("/pub")[2], r.last_modified, r.size_bytes) for r in _entries(spark, PAGE).collect()}
    assert rows == {"xx.tiny": ("/time.series/pr/xx.tiny", "12/31/2019 11:59 PM", 77),
                    "xx.data.12.AllData": ("/time.series/pr/xx.data.12.AllData", "1/2/2031  1:05 AM", 9000001),
                    "odd name.txt": ("/time.series/pr/odd name.txt", "2/29/2024 12:00 PM", 0)}


def test_parse_listing_empty(spark):
    assert _entries(spark, "", "<html></html>").count() == 0


#: The rule: skipped names; ``pr.data.<n>.<kind>`` of four parts or more by its last part; ``pr.series``; all else is enrichment.
CASES = {f"pr.data.{n}.{kind}": folder for n in ("7", "31", "x.y") for kind, folder in (("Current", "current"), ("AllData", "backfill"), ("all", "enrichment"))}
CASES |= {"pr.data.AllData": "enrichment", "xx.data.7.Current": "enrichment", "pr.series": "series", "PR.SERIES": "enrichment",
          "pr.contacts": None, "pr.txt": None, "anything": "enrichment", "": "enrichment", None: None}


def test_classify(spark):
    df = spark.createDataFrame([(n,) for n in CASES], "filename string")
    assert {r.filename: r.category for r in manifest.classify_files(df).collect()} == CASES


def _m(spark, rows):
    return spark.createDataFrame(rows, "url string, last_modified string")


def test_pending_rules(spark):
    entries = _m(spark, [("a", "t1"), ("b", "t2"), ("c", None), ("d", None), ("e", "t5")])
    state = _m(spark, [("a", "t1"), ("b", "old"), ("c", None), ("d", "t4")])
    assert sorted(r.url for r in manifest.manifest_pending(entries, state).collect()) == ["b", "d", "e"]


def test_upsert(spark):
    state = _m(spark, [("a", "t1"), ("b", "old")])
    out = {r.url: r.last_modified for r in manifest.manifest_upsert(state, _m(spark, [("b", "t2"), ("c", None)])).collect()}
    assert out == {"a": "t1", "b": "t2", "c": None}


def test_content_changed(spark):
    cur = spark.createDataFrame([(1, "same"), (2, "new text"), (3, "never stored")], "doc_id long, text string")
    prev = cur.where("doc_id < 3").select("doc_id", F.sha2(F.when(F.col("doc_id") == 2, "old text")
                                                           .otherwise(F.col("text")), 256).alias("digest"))
    assert sorted(r.doc_id for r in manifest.content_changed(cur, prev).collect()) == [2, 3]


def test_json_records_to_rows(spark):
    payload = '{"columns": ["Year", "Nation", "Population"], "data": [' \
              '{"Year": 2013, "Nation": "United States", "Population": 316128839}, ' \
              '{"Year": 2014, "Nation": null, "Population": 318857056}]}'
    df = spark.createDataFrame([(7, payload)], "payload_id int, payload string")
    lines = [r.line for r in manifest.json_records_to_rows(df).orderBy("line_no").collect()]
    assert lines == ["Year\tNation\tPopulation", "2013\tUnited States\t316128839", "2014\t\t318857056"]


def test_records_tsv_sink_and_category_filter(spark):
    import glob

    from strata.session import local_dir, scratch_path
    payload = '{"columns": ["a", "b"], "data": [{"a": 1, "b": "x"}, {"a": 2, "b": null}]}'
    lines = manifest.json_records_to_rows(spark.createDataFrame([(3, payload)], "payload_id int, payload string"))
    path = scratch_path(spark, "test-records")
    manifest.write_records_tsv(lines, path)
    files = glob.glob(f"{local_dir(path) or path}/payload_id=3/*.txt")
    text = "".join(open(f).read() for f in sorted(files))
    assert text == "a\tb\n1\tx\n2\t\n"
    entries = spark.createDataFrame([("pr.series",), ("pr.class",), ("pr.txt",)], "filename string")
    assert [r.filename for r in manifest.entries_of_category(entries, "enrichment").collect()] == ["pr.class"]
