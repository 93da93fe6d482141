"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hemotab.session import checkpoint_dir

FOLDS = 5
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def text_or_empty(col: str) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def text_bytes(col: str) -> Column:
    """The text's UTF-8 bytes (null: none), so that Python reads any string."""
    return text_or_empty(col).cast("binary")


def fold(id_col: str, folds: int = FOLDS) -> Column:
    """crc32 of the id's text modulo ``folds`` (a null id counts as empty text)."""
    return (F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


def store(spark: SparkSession, df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """Write ``df`` to a new folder below the shared ``spark.checkpoint.dir``
    and read it back: lineage ends there, and a lost executor loses nothing.
    ``batch``: rows that go to Python at a time meanwhile, where the session allows more."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with batches(spark, batch):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batches(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """Within it, actions send Python at most so many rows at a time: both sides
    hold a few such batches, which are large where rows are wide."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if rows is None or 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words(text: bytes) -> list[bytes]:
    """Words of ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased: exactly what
    ``bytes.lower`` and ``bytes.split`` do."""
    return text.lower().split()


def sum_arrays(partial: DataFrame, size: int, chunk: int, dtype: str) -> np.ndarray:
    """Sum of the tasks' arrays of ``size`` numbers, dealt out in chunks: rows
    (chunk, part, counts), part being the task's number modulo a constant.
    Two steps, so that no group grows with the number of tasks; the result
    has a fixed size."""
    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(chunk, dtype)
        for c in rows["counts"]:
            total += np.frombuffer(c, dtype)
        return pd.DataFrame({"chunk": rows["chunk"][:1], "part": rows["part"][:1], "counts": [total.tobytes()]})

    kind = "chunk int, part int, counts binary"
    some = partial.groupBy("chunk", "part").applyInPandas(add, kind)
    out = np.zeros(size, dtype)
    for r in some.groupBy("chunk").applyInPandas(add, kind).select("chunk", "counts").collect():
        out[r["chunk"] * chunk:(r["chunk"] + 1) * chunk] = np.frombuffer(r["counts"], dtype)
    return out
