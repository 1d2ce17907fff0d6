"""A corpus from documents to packed sequences: each stage works on all that the stage before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame: the documents it keeps, with the columns of ``documents``;
the last one returns the pieces of the packed sequences.  Stages read nothing but ``docs``.

In every stage an empty table gives no rows, texts of any length are taken whole, and columns beside those of
``documents`` pass through, whatever their names.  Stages bound the batches that the session sends to Python.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import language_id, packing, quality, simhash, suffix_dedup
from corpusloom.llm.common import bound_batches, materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a rule, or whose host mostly does, go.  A null text goes; a null host is no reason to go; repeated rows share their fate."""
    bound_batches(spark)
    return quality.drop_rejected(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go.  Without any label to learn from all go, with a warning; repeated rows share their fate."""
    bound_batches(spark)
    return language_id.drop_unidentified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of smallest id: shingles of five words, similarity 0.8 or more.  Rows with a null id stay; of repeated rows one stays."""
    bound_batches(spark)
    return simhash.drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 50 bytes that also start in a document of smaller id go from the texts.  Null texts and rows with a null id stay as they are; rows that share an id get one text."""
    bound_batches(spark)
    return suffix_dedup.without_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens.  A null text is packed as its end token; repeated rows are documents of their own."""
    bound_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("language ID", language),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", substring_dedup),
    ("packing", pack),
]

#: The stages are beyond SQL; tests hold the two dedup stages here, and each operator by itself, against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
