"""A training-data pipeline over ``documents``: STAGES in order, each written
as Parquet and reread as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hemotab.llm import exact_dedup, jaccard, mixing, packing, toxicity
from hemotab.llm.common import documents, store


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    model = toxicity.train(docs, documents(spark, sf_dir, "labels"))
    return toxicity.clean_documents(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.distinct_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays (five words, similarity 0.8)."""
    return jaccard.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; no source is gone through more than twice."""
    return mixing.Mix(docs, most_repeats=2.0).documents()


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("temperature_mixing", mix_sources),
    ("complement_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = store(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# The stages learn a model, search near copies and tokenize, which SQL cannot
# express; tests/llm compares them with brute force.
ORACLE_SQL: str | None = None
