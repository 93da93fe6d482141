"""Exact duplicates by skew-safe combining.

Texts are merged three times, each time on digest *and* full text, so two
texts with one digest never meet in a group: inside every map task (the
partial aggregate before the first shuffle), per salt (a group of copies is
spread over ``salts`` partial winners) and globally over the salt winners.
No list of members is built: a group is only its winner and its size.

Members then look their group up by digest.  Where several different texts
have one digest, those digests alone are looked up by digest and text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemotab.llm.common import store, text_or_empty

SALTS = 16


def _sha256(body: Column) -> Column:
    return F.sha2(body.cast("binary"), 256)


def _keyed(df: DataFrame, id_col: str, text_col: str, normalise, digest, salts: int) -> DataFrame:
    body = text_or_empty(text_col)
    body = normalise(body) if normalise else body
    return (df.select(F.col(id_col).alias("id"), body.alias("body"))
            .select("id", "body", digest(F.col("body")).alias("digest"),
                    F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt")))


def winners(keyed: DataFrame) -> DataFrame:
    """digest, body, keep_id, group_size of every distinct text."""
    salted = keyed.groupBy("salt", "digest", "body").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n"))
    return salted.groupBy("digest", "body").agg(F.max("top").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                normalise: Callable[[Column], Column] | None = None,
                digest: Callable[[Column], Column] = _sha256, salts: int = SALTS) -> DataFrame:
    """One row per input row: ``id_col``, keep_id, group_size, kept, text_sha256.

    The largest id of a group of equal (normalised) texts stays.  Null text
    counts as empty; a null id stays only where its whole group has none
    (keep_id null).  Rows that repeat the winning id with its text are all
    marked kept (``distinct_documents`` keeps one of them).  An empty table
    gives no rows; other columns are not read, whatever their names.
    """
    spark = df.sparkSession
    keyed = _keyed(df, id_col, text_col, normalise, digest, salts)
    texts = winners(keyed)
    groups = store(spark, texts.select("digest", "keep_id", "group_size"), "exact-dedup")
    members = keyed.select("id", "digest", _sha256(F.col("body")).alias("text_sha256"))
    clashing = groups.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest")
    if clashing.isEmpty():
        found = members.join(groups, "digest")
    else:
        by_text = (keyed.join(clashing, "digest", "left_semi")
                   .join(texts.join(clashing, "digest", "left_semi"), ["digest", "body"])
                   .select("digest", "id", _sha256(F.col("body")).alias("text_sha256"), "keep_id", "group_size"))
        found = (members.join(clashing, "digest", "left_anti").join(groups, "digest")
                 .unionByName(by_text))
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size",
                        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def distinct_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows that stay, with all their columns; of fully repeated winners
    (same id and text) one stays."""
    kept = (exact_dedup(df, id_col, text_col, **options).where("kept")
            .select(F.col(id_col).alias("__id"), F.col("text_sha256").alias("__sha")).distinct())
    body = text_or_empty(text_col)
    normalise = options.get("normalise")
    body = normalise(body) if normalise else body
    marked = df.withColumns({"__id": F.col(id_col), "__sha": _sha256(body)})
    cond = marked["__id"].eqNullSafe(kept["__id"]) & (marked["__sha"] == kept["__sha"])
    rows = marked.join(kept.hint("shuffle_hash"), cond, "left_semi")
    return rows.dropDuplicates(["__id", "__sha"]).drop("__id", "__sha")
