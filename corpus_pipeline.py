"""Corpus pipeline: documents to packed training bins, one operator a stage.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's ``docs``. All but
the last return the columns of ``documents``; each works on every row it is given.

Defined results, beside those that each operator states: a null text has no words, so the
quality rules reject it, as they do an empty one; a null id is an id like any other, and
rows that share an id, or have none, are told apart by their texts; of rows equal in id and
text one is left after the near-duplicate stage; an empty table gives no bins; columns that
``documents`` does not have pass through the filtering stages, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import importance, packing, quality_rules, simhash, suffix_dedup
from ledgerline.llm.common import read_table, written


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without their failed lines."""
    return quality_rules.clean(docs)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling selects."""
    return importance.keep_selected(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_first(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without byte strings that stand earlier in the corpus."""
    return suffix_dedup.remove(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of the documents that are left."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", clean_lines),
    ("quality_classifier", classify),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("best_fit_packing", pack),
]

#: No SQL for Gumbel sampling, SimHash components and packing; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
