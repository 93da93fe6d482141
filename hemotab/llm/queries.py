"""The registered queries of this package: thin calls of the operators with
their production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemotab.llm import brown, cutstock, exact_dedup, fim, jaccard, knn, lexical, mixing, packing, quality, secrets, suffix_dedup, toxicity
from hemotab.llm.common import documents, fold


def op1_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.train(docs, documents(spark, sf_dir, "labels"), metadata=("n_chars",))
    return quality.score(docs, model, metadata=("n_chars",))


def op2_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    findings, _ = secrets.scan(documents(spark, sf_dir), ("doc_id",))
    return secrets.digest(findings, "doc_id")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, sf_dir), jaccard.Config(shingle=4, num=85, den=100))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op5_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, documents(spark, sf_dir, "labels")))


def op6_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown.score(documents(spark, sf_dir), fold("doc_id") == 1)


def op7_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.top_k(documents(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op8_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir), most_repeats=2.0)


def op9_complement_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir)).drop("kept")


def op11_block_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fim.restore(fim.transform(documents(spark, sf_dir), seed=1, plain_percent=10, spm_percent=20))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12_blocked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.top_documents(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op13_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cutstock.pack(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_factorisation_machine": op1_factorisation_machine,
    "op2_secret_ledger": op2_secret_ledger,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_kneser_ney_toxicity": op5_kneser_ney_toxicity,
    "op6_brown_classes": op6_brown_classes,
    "op7_voronoi_knn": op7_voronoi_knn,
    "op8_temperature_mixing": op8_temperature_mixing,
    "op9_complement_packing": op9_complement_packing,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_block_rotation": op11_block_rotation,
    "op12_blocked_search": op12_blocked_search,
    "op13_cutting_stock": op13_cutting_stock,
}
