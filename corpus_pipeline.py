"""The corpus pipeline: five stages over ``documents``, each written and read again by the next.

Toxic documents go, one document of each group of near duplicates stays,
documents that hold benchmark passages go, personal data get pseudonyms, and
what is left is packed into bins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from areatab.llm import decontaminate, packing, pii, simhash, toxicity
from areatab.llm.common import read_table, written
from areatab.session import ensure_checkpoint_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose toxicity score is 0.3 or more."""
    ensure_checkpoint_dir(spark)
    return toxicity.reject(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    ensure_checkpoint_dir(spark)
    return simhash.deduplicate(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that overlap a benchmark item."""
    return decontaminate.remove(docs, read_table(spark, sf_dir, "benchmark"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced in the texts."""
    return pii.pseudonymise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' words in bins: (bin_id, place, doc_id, start, n_words, source, cluster)."""
    return packing.pack(packing.measured(docs))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", pseudonymise),
    ("best_fit_packing", pack),
]

#: A chain trained on labels and Feistel networks have no SQL; tests hold run() against plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written to the shared folder."""
    ensure_checkpoint_dir(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
