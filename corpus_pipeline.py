"""The corpus pipeline: five stages, each over all that the one before kept.

Every stage takes null, empty and very long texts, null ids, ties, equal rows, empty tables and further
columns of any name; what each does with them is told there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ripplelog.llm import decontam, mixing, neardup, records, toxicity
from ripplelog.llm.catalog import tokenizer_path
from ripplelog.llm.frames import cut, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold, rows and columns as they come.

    Null and empty texts are scored like any other, equal texts equally, long ones by all their windows.
    """
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near duplicates.

    Null and blank texts are near to none, and rows with a null id take no part: all of them stay. Equal
    rows with one id are one document and stay or go together.
    """
    return neardup.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark.

    Null and empty texts share nothing and stay; equal rows stay or go together; with an empty benchmark
    all stay.
    """
    return decontam.remove_test_text(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the last copy of one per source may be a part.

    Texts without words, null and empty ones among them, have nothing to take and go. A null source is
    a source of its own, the last. Equal rows are taken one by one.
    """
    return mixing.repeat_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row (doc_id, start, n_tokens, ids_crc32) per document copy, from the record files.

    Null texts count as empty, which leaves the end id alone. Copies of one id have records of their
    own.
    """
    return records.token_table(docs, tokenizer_path()).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_records", token_stage),
]

#: The scores of a trained network and the tokenizer's ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
