"""A corpus pipeline over ``documents``.

Five stages, each one operator of posetide.llm over all that the stage before
it kept: quality rules, near-duplicates, repeated passages, secrets, packing.
All but the last return documents with the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from posetide.llm import near_dups, quality_lines, repeated_passages, secret_scan, slack_packing
from posetide.llm.common import documents, stored
from posetide.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; boilerplate lines go from the others."""
    return quality_lines.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return near_dups.without_near_duplicates(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated passages go."""
    return repeated_passages.without_repeats(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked."""
    return secret_scan.masked(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row a piece of a training sequence."""
    return slack_packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("passages", passages), ("secrets", secrets), ("packing", packing)]

#: No stage but the third can be put in SQL; tests/llm holds the whole against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
