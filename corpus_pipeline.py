"""A corpus from raw documents to packed training sequences, in five stages.

Each stage is a function of (spark, docs, sf_dir) and works on all that the one before kept. Its
rows are written as Parquet to the cluster's shared folder and read again as the next one's
documents. All stages but the last return the columns of `documents`, unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleanframe.llm import decontaminate, grades, packing, partenum, rules
from gleanframe.llm.common import staged, table


def good_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no anomaly to the isolation forest."""
    return rules.keep(docs, rules.fit(docs, table(spark, sf_dir, "labels")))


def good_by_grade(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents likely enough to reach grade 1 (acceptable) of the ordinal classifier."""
    return grades.keep(docs, grades.fit(docs, grades.ratings_of(table(spark, sf_dir, "labels"))))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the least doc_id."""
    return partenum.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every remaining document in sequences of 4096 ids."""
    from public_tokenizers import path

    return packing.pack(docs, path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", good_by_rules),
    ("quality_classifier", good_by_grade),
    ("ngram_jaccard", one_of_each_group),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: SQL cannot express the learned stages; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
