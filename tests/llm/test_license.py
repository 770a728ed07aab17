from pyspark.sql import functions as F

from strata.llm import license


def test_planted_notices_and_clean_lines(spark, docs):
    lines = ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.",
             "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.",
             "SPDX-License-Identifier: MIT", "All rights reserved."]
    want = ["Apache-2.0", "MIT", "GPL", "CC-BY-NC", "MIT", "Proprietary"]
    other = "She renewed her driving licence after the summer fair had closed."
    rows = [(i, f"Some first line.\n{t}\nAnd a last one.") for i, t in enumerate(lines)] + [(90, other), (91, None), (None, lines[0])]
    both = docs.select("doc_id", "text").where("doc_id < 150").withColumn("doc_id", docs.doc_id + 1000).union(
        spark.createDataFrame(rows, "doc_id long, text string"))
    found = {(r.doc_id, r.paragraph): r for r in license.scan(both).collect()}
    for i, family in enumerate(want):
        assert found[i, 1].family == family and found[i, 1].confirmed
    assert not any(r.confirmed for r in found.values() if r.doc_id == 90) and found[None, 0].family == "Apache-2.0"
    planted = {(i, 1) for i in range(len(lines))} | {(None, 0)}
    assert all(r.confirmed for r in found.values() if (r.doc_id, r.paragraph) in planted)


def test_notices_of_other_wordings(spark, docs):
    lines = ["Available under CC BY-SA 4.0.", "Distributed under the GNU GPL v3.", "Creative Commons Attribution 4.0 International",
             "Permission is hereby granted, free of charge, to any person obtaining a copy"]
    prose = "one day the men went down to the river and "
    rows = [(i, t) for i, t in enumerate(lines)] + [(10, prose * 6 + "Available under CC BY-SA 4.0. " + prose * 6)]
    both = docs.select("doc_id", "text").where("doc_id < 300").withColumn("doc_id", docs.doc_id + 1000).union(
        spark.createDataFrame(rows, "doc_id long, text string"))
    found = {(r.doc_id, r.family) for r in license.scan(both).where("confirmed").collect() if r.doc_id < 100}
    assert found == {(0, "CC-BY-SA"), (1, "GPL"), (2, "CC-BY"), (3, "MIT"), (10, "CC-BY-SA")}


def test_windows_cover_every_word(spark):
    rows = spark.range(0, 120).selectExpr("transform(sequence(1, cast(id as int) + 1), x -> cast(x as string)) AS tokens")
    for r in rows.select("tokens", license.windows(F.col("tokens")).alias("w")).collect():
        assert set().union(*r.w) == set(r.tokens) and max(map(len, r.w)) <= license.WINDOW


def test_odd_rows(odd, nothing):
    assert license.scan(odd).count() == 0
    assert license.scan(nothing).count() == 0


def test_every_window_of_the_corpus_is_counted(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", """CASE WHEN id % 2 = 0 THEN concat('number ', id, ' of the books')
        ELSE concat('nothing here ', id, '\nReleased under the MIT License.') END AS text""")
    rows = license.known_windows(docs, license.vocabulary(spark))
    assert rows.count() == 9000
    found = [(r.known, r.n) for r in license.no_licences(rows).collect()]
    assert sum(n for known, n in found if known is None) == 3000
    assert sum(n for known, n in found if known is not None) == 3000  # the notices resemble a form


def test_limit_comes_from_all_windows(spark):
    line = "Students like the public license of the library"
    docs = spark.range(5000).selectExpr("id AS doc_id", f"concat('{line} ', id) AS text")
    found = license.scan(docs).where("family <> 'unknown'").count()
    assert found <= 5  # a thousandth
