"""A corpus pipeline over ``documents``: quality rules, toxicity, line dedup,
near-duplicate join, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows of its
predecessor; the first four return rows with the columns of ``documents``, the
last one returns packed pieces. ``run`` writes what each stage keeps to a table
in the shared checkpoint folder, from which the next one reads, so a lost
executor costs at most one stage's tasks.

What each stage decides: the quality rules drop documents that fail and remove
failing lines from the others; the toxicity stage drops documents that score 0.3
or more; the line dedup removes lines whose template occurred in a document with
a smaller id, and documents that are emptied by it; of each component of near
duplicates the document with the smallest id stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quillfeed.llm import line_dedup, ngram_join, packing, quality, toxicity
from quillfeed.session import cut_lineage

#: Near duplicates share NEAR_PERCENT % of their shingles of NEAR_WORDS words.
NEAR_WORDS = 5
NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.filter_documents(docs, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.filter_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.filter_documents(docs, size=NEAR_WORDS, percent=NEAR_PERCENT)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity_filter),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("packing", packing_stage),
]

#: SQL cannot train the classifier or run the tokeniser; the tests compare the
#: stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
