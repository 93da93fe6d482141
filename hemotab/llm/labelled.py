"""Bounded labelled samples for fitting classifiers, and text scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemotab.llm.common import fold, text_bytes


def sample(docs: DataFrame, labels: DataFrame, target: str, most: int, *, id_col: str = "doc_id",
           text_col: str = "text", per_class: bool = False, extra: tuple[str, ...] = ()) -> tuple[DataFrame, dict]:
    """(id, y, text, extra columns) of at most ``most`` labelled training rows
    (of each class, if ``per_class``), and the training rows per class.

    Rows of fold 0 are never read.  Of several labels of one id the largest
    counts; null labels and labels other than 0 and 1 don't.  The rows are
    the first by a hash of their id, so the sample is the same on every run.
    """
    known = (labels.where(F.col(target).isin(0, 1) & F.col(id_col).isNotNull() & (fold(id_col) != 0))
             .groupBy(F.col(id_col).alias("id")).agg(F.max(target).cast("int").alias("y")))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    parts = []
    for classes in ([[0], [1]] if per_class else [[0, 1]]):
        n = sum(counts.get(y, 0) for y in classes)
        share = 1.0 if n <= most else min(1.0, 1.2 * most / n + 0.001)
        parts.append(known.where(F.col("y").isin(*classes) & (order < F.lit(int(share * (1 << 30)))))
                     .orderBy(order, "id").limit(most))
    picked = parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])
    texts = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"),
                        *[F.col(c).alias(f"x_{c}") for c in extra])
    # picked has at most ``most`` (or twice that) rows of an id and a label.
    return texts.join(F.broadcast(picked), "id"), counts


def score_texts(docs: DataFrame, scorer: Callable[[], Callable[[pd.DataFrame], list[float]]], *,
                id_col: str = "doc_id", text_col: str = "text", extra: tuple[str, ...] = (),
                threshold: float = 0.5) -> DataFrame:
    """id, held_out, score, predicted for every row; one pass, no shuffle.

    ``scorer()`` is called once in each task and gives the function from a
    batch (columns text and extra) to scores.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        score = scorer()
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "held_out": b["held_out"], "score": score(b)})

    # The id travels as text: pandas would turn integers beside nulls into floats.
    rows = docs.select(F.col(id_col).cast("string").alias("id"), (fold(id_col) == 0).alias("held_out"),
                       text_bytes(text_col).alias("text"), *[F.col(c).alias(f"x_{c}") for c in extra])
    scored = rows.mapInPandas(run, "id string, held_out boolean, score double")
    return scored.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "held_out", "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
