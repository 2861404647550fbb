"""A corpus from raw documents to packed sequences.

Each stage takes what its predecessor kept and returns the rows that it keeps,
with the columns of ``documents``; the last one returns the pieces of the
packed sequences. Stages are written as Parquet and read again, so no stage
repeats another's work when executors are lost.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleethealth.llm import exact_dedup, language_id, near_copies, packing, toxicity
from fleethealth.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, by a model of the table's own labels."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, model)


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of one main language; texts without a letter go, and those of which no language makes up half."""
    return language_id.accepted(docs, language_id.fit(table(spark, sf_dir, "documents")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one of the largest doc_id."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies, by five-word shingles with a Jaccard similarity of 0.8 or more, the one of the smallest doc_id."""
    return near_copies.deduplicated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of at most 1024 tokens."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_identified),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("best_fit_packing", pack),
]

#: Models, fingerprints and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
