"""Cleaning and packing of a corpus: each stage reads what the one before it has kept.

Toxic documents go, one document of each near-duplicate group stays, personal data is replaced,
documents are repeated or left out so that domains reach their target weights, and what remains is
packed into bins. Every stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from joblattice.llm import mixing, packing, pii, simhash, toxicity
from joblattice.llm.shared import staged, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.replace_entities(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, table(spark, sf_dir, "labels"))


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("pii", replace_private),
    ("mixing", mix_domains),
    ("packing", pack_bins),
]

#: The learned stages have no SQL form; tests hold them against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
