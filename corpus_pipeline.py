"""Training-data pipeline: toxic documents go, copies go, repeated passages go, test leaks go, what is left is encoded.

``STAGES`` lists (name, function); each takes ``(spark, docs, sf_dir)`` and
returns the documents it keeps, the last one their tokens. Results between
stages are written as Parquet under the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontam, simhash, spm, substring, toxicity
from strata.llm.common import table, written
from strata.llm.queries import toxicity_model

#: Score from which a document counts as toxic.
TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose own text scores below TOXIC."""
    return toxicity.without_toxic(docs, toxicity_model(spark, sf_dir, docs), TOXIC)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return simhash.keep_one(docs, shingle_words=4, max_bits=4)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document, or place, has already."""
    return substring.without_repeats(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage that holds a benchmark item."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document left."""
    return spm.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_copies),
    ("substring_dedup", cut_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("sentencepiece", encode),
]
#: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is not STAGES[-1][1]:
            docs = written(docs, f"pipeline-{name}")
    return docs
