"""Joins with code tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemotab.sources.schema import DIMENSIONS
from hemotab.sources.tables import Tables

# A code list larger than this (by the planner's own size estimate: file sizes
# or inline rows) is joined by shuffle.
CODE_TABLE_BYTES = 16 << 20


def known_small(frame: DataFrame) -> bool:
    """Whether the planner knows ``frame`` to be small.  Its estimate is at hand
    without running a job; sources it knows nothing about count as large."""
    size = frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= CODE_TABLE_BYTES


def code_table(frame: DataFrame) -> DataFrame:
    """``frame`` with a broadcast hint if the planner knows it to be small.

    Only code lists and component batches are hinted; all other joins are planned
    as shuffles, which AQE turns into broadcasts by measured bytes.
    """
    return F.broadcast(frame) if known_small(frame) else frame


def dim_lookup(tables: Tables, fact: DataFrame, table: str, fact_key: str,
               columns: dict[str, str], how: str = "left") -> DataFrame:
    """Left-join a code list on its ``id`` and bring in ``columns`` (source -> alias).

    The list is reduced to its key and the needed labels before the join, so
    what is broadcast is only that.
    """
    if table not in DIMENSIONS:
        raise ValueError(f"{table} is no code list")
    key = f"__{table}_id"
    dim = tables[table].select(F.col("id").alias(key),
                               *[F.col(src).alias(alias) for src, alias in columns.items()])
    out = fact.join(code_table(dim), fact[fact_key] == dim[key], how)
    return out.drop(key)
