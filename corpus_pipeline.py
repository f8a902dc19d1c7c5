"""Quality rules, near-dedup, benchmark decontamination and encoding of a document table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents.

Edge cases are those of the operators: null and blank texts fail the quality rules; equal rows and ties
are one group of which one row stays; rows without an id are handled like any others; very long texts
are read whole; further columns of documents pass through, whatever their names; an empty table passes
through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.bpe_automaton import bpe_round_trip
from millrace.llm.common import delete, new_path, table, temporary
from millrace.llm.decontaminate import clean
from millrace.llm.near_copies import one_of_each
from millrace.llm.quality import passing
from millrace.llm.queries import tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their host's verdict."""
    return passing(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class, the one with the least id. Texts whose sets of 5-word shingles are 0.8
    similar or more are linked, and so are the texts that such links reach."""
    return one_of_each(docs, percent=80, shingle=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token count and digests of the ids and of the decoded text."""
    return bpe_round_trip(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("encode", encode)]

#: SQL cannot express the encoding or the hashes of the shingles; tests/llm holds brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each written and read again. What a stage makes on the way goes when it is
    written, and its input (a stage's output, not documents) with it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        with temporary(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
