"""A corpus pipeline over ``documents``: filter, deduplicate, decontaminate, redact and pack.

``STAGES`` holds (name, function) pairs. A function takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes each result as Parquet and reads it back as the next stage's ``docs``. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pensio.llm import decontaminate, jaccard, packing, pii, quality
from pensio.llm.common import documents, stage, table, without

#: Tokenizing, boosted trees and importance weights are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects.

    A row goes where its doc_id is not selected; one without doc_id cannot be selected and goes too.
    """
    judged = quality.resample(docs, table(spark, sf_dir, "labels"))
    return without(docs.where("doc_id is not null"), judged.where("not selected").select("doc_id"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more.

    The one with the smallest doc_id stays, with all rows that repeat it; texts without words stay.
    """
    return jaccard.deduplicate(docs, size=5, percent=80)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a test item. Each row is judged by its own text; null and empty texts stay."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind, row by row; null and empty texts stay as they are."""
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document left, each with its sequence and place.

    A null or empty text is a piece of one token; repeated rows are pieces of their own.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("quality", good),
    ("near_duplicates", distinct),
    ("decontamination", clean),
    ("personal_data", private),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
