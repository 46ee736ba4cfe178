"""Training-data pipeline over ``documents``: five stages, each by one operator of the library.

A stage takes (spark, docs, sf_dir) and returns the documents that go on, with the columns of
``documents``; the last returns where each piece of each document is packed. ``run`` applies
the stages one after the other, each to what its predecessor wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontamination, exact_dedup, near_dedup, packing, toxicity
from tidemark.llm.work import cut, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.reject(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id."""
    return exact_dedup.deduplicate(docs, keep="largest")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    return near_dedup.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontamination.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return packing.report(docs)


STAGES = [
    ("toxicity", toxic),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Tokenizers, trained scores and random trees are beyond SQL; tests hold a brute-force run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
