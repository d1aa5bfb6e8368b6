"""Corpus pipeline: quality rules, near-duplicate removal, benchmark decontamination, secret redaction, packing.

Every stage takes what its predecessor kept and returns documents with the same columns; the last returns packed
pieces.  A stage's output is written as Parquet in the cluster's shared folder and read back as the next one's input, so a
lost executor costs one stage at most.  Stages accept NULLs, empty and repeated rows and empty tables as their operators do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, near_join, packing, quality_rules, secrets
from strata.llm.common import read_table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules (9)."""
    return quality_rules.keep_good(docs, quality_rules.train(docs, read_table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (4): a row of the id that names the component.

    A row is known by id and text together: rows that share a ``doc_id``, or have none, stay unless their texts are near copies.
    """
    return near_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window (8)."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with every secret replaced by a mark (10); ``n_chars`` follows the new text."""
    return secrets.redact(docs, secrets.train(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of at most 4096 tokens (2)."""
    return packing.pack(docs)


STAGES = [("quality_rules", quality), ("ngram_jaccard_join", near_duplicates), ("benchmark_decontamination", decontamination),
          ("secret_scan", secret_scan), ("packing", pack)]

# The classifier, the Markov models and the tokenizer have no SQL form; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        df = written(stage(spark, df, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, df, sf_dir)
