"""Registered queries of the operators; each applies one to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bitpack, decontam, laesa, langid, license, pii, quality, simhash, spm, substring, topk, toxicity, zonemap
from .common import remainder, table, written


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(True))
    model = langid.train(docs.where(~held_out))
    found = written(langid.predict(docs, model).withColumn("held_out", held_out), "languages")
    return langid.calibrated(found, found.where("NOT held_out")).select(
        "doc_id", "held_out", "lang_pred", "score", "cross_entropy", "rejected")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeats(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, max_bits=4)


def op5_bitpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitpack.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(True))
    rows = written(quality.statistics(table(spark, sf_dir, "documents")), "quality")
    labels = table(spark, sf_dir, "labels").where(~held_out).select("doc_id", F.col("quality").alias("label")).dropna()
    model = quality.fit(rows.join(labels, "doc_id").select("x", "label"))
    return quality.scored(rows, model).select("doc_id", held_out.alias("held_out"), "score",
                                              (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.Model:
    labels = table(spark, sf_dir, "labels").where(remainder(F.col("doc_id"), 5) != 0)
    return toxicity.fit(docs, labels, label_col="toxic")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(True))
    return toxicity.scored(docs, toxicity_model(spark, sf_dir, docs)).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.search(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.found(table(spark, sf_dir, "documents")))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zonemap.report(*zonemap.clusters(table(spark, sf_dir, "embeddings"), k=8, rounds=10, width=64, scale=1024, seed=3))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return laesa.report(*laesa.compressed(table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6, scale=4096))


OP10_SQL = """
WITH finite AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM finite q JOIN finite c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""

_FLOOR_MEAN = "(s - ((s % n) + n) % n) // n"


def _op12_sql(k: int = 8, rounds: int = 10) -> str:
    """Every round as two tables: each row's nearest centroid, and the centroids' floored means."""
    distance = "CAST(list_inner_product(r.v, r.v) - 2 * list_inner_product(r.v, c.v) + list_inner_product(c.v, c.v) AS BIGINT)"
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
  SELECT r.n, c.c, {distance} AS d FROM kept r CROSS JOIN c{n} c
  QUALIFY row_number() OVER (PARTITION BY r.n ORDER BY {distance}, c.c) = 1)""")
        if n < rounds:
            steps.append(f"""m{n} AS (
  SELECT c, pos, CAST(sum(x) AS HUGEINT) AS s, CAST(count(*) AS HUGEINT) AS n
  FROM (SELECT a.c, unnest(range(1, 65)) AS pos, unnest(r.v) AS x FROM a{n} a JOIN kept r USING (n)) GROUP BY c, pos),
c{n + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(any_value(m.v), any_value(c.v)) AS v FROM c{n} c
  LEFT JOIN (SELECT c, list(CAST({_FLOOR_MEAN} AS DOUBLE) ORDER BY pos) AS v FROM m{n} GROUP BY c) m USING (c) GROUP BY c.c)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER w - 1 AS INTEGER) AS c, v FROM kept WHERE vec_id IS NOT NULL
  WINDOW w AS (ORDER BY sha256('3:' || vec_id), v) QUALIFY row_number() OVER w <= {k}),
{", ".join(steps)}
SELECT r.vec_id, a.c AS cluster, a.d AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string([CAST(x AS BIGINT) FOR x IN c.v], ',')) AS centroid_sha256
FROM a{rounds} a JOIN kept r USING (n) JOIN c{rounds} c USING (c)
"""


def _op13_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """As _op12_sql, for each part position by itself."""
    distance = "CAST(list_inner_product(r.v, r.v) - 2 * list_inner_product(r.v, e.v) + list_inner_product(e.v, e.v) AS BIGINT)"
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (
  SELECT r.n, r.p, e.e, {distance} AS d FROM part r JOIN e{n} e USING (p)
  QUALIFY row_number() OVER (PARTITION BY r.n, r.p ORDER BY {distance}, e.e) = 1)""")
        if n < rounds:
            steps.append(f"""m{n} AS (
  SELECT p, e, pos, CAST(sum(x) AS HUGEINT) AS s, CAST(count(*) AS HUGEINT) AS n
  FROM (SELECT a.p, a.e, unnest(range(1, len(r.v) + 1)) AS pos, unnest(r.v) AS x FROM a{n} a JOIN part r USING (n, p))
  GROUP BY p, e, pos),
e{n + 1} AS MATERIALIZED (
  SELECT e.p, e.e, coalesce(any_value(m.v), any_value(e.v)) AS v FROM e{n} e
  LEFT JOIN (SELECT p, e, list(CAST({_FLOOR_MEAN} AS DOUBLE) ORDER BY pos) AS v FROM m{n} GROUP BY p, e) m USING (p, e)
  GROUP BY e.p, e.e)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, label, [floor(4096 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
part AS MATERIALIZED (
  SELECT n, p, v[p * len(v) // {parts} + 1:(p + 1) * len(v) // {parts}] AS v
  FROM kept CROSS JOIN (SELECT unnest(range({parts})) AS p)),
first AS (
  SELECT n, row_number() OVER w - 1 AS e FROM kept WHERE vec_id IS NOT NULL
  WINDOW w AS (ORDER BY vec_id, v) QUALIFY row_number() OVER w <= {entries}),
e0 AS MATERIALIZED (SELECT p, e, v FROM part JOIN first USING (n)),
{", ".join(steps)},
books AS (
  SELECT sha256(string_agg(array_to_string([CAST(x AS BIGINT) FOR x IN v], ','), ',' ORDER BY p, e)) AS codebooks_sha256
  FROM e{rounds}),
coded AS (
  SELECT n, string_agg(lpad(lower(hex(CAST(e AS BIGINT))), 2, '0'), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY n)
SELECT k.vec_id, c.code, c.error, CAST(sum(c.error) OVER (PARTITION BY k.label) AS BIGINT) AS label_error, b.codebooks_sha256
FROM coded c JOIN kept k USING (n) CROSS JOIN books b
"""


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_simhash": op4_simhash,
    "op5_bitpack": op5_bitpack,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_license_scan": op7_license_scan,
    "op8_quality": op8_quality,
    "op9_toxicity": op9_toxicity,
    "op10_topk": op10_topk,
    "op11_pii": op11_pii,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_vector_codes": op13_vector_codes,
}
ORACLE = {"op10_topk": OP10_SQL, "op12_centroid_clustering": _op12_sql(), "op13_vector_codes": _op13_sql()}
