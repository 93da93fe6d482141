from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
EDGE = [None, "", "   ", "word", "a b", "x" * 300, "idiot scum trash", "a  b\n c\td ", "ünïcödé wörds hére, très bién",
        "same text " * 40, "same text " * 40, "A b C d E"]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing extra columns."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(EDGE)]
    rows += [(None, "no id", None, None, None), (None, None, None, None, None), (3, "word", None, None, 4),
             (100, " ".join(f"w{k % 997}" for k in range(60_000)), "en", "big", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    clash = {c: "clash" for c in ("id", "score", "digest", "body", "salt", "n", "key", "block", "task", "row", "h", "word", "kept", "rep", "held_out")}
    from pyspark.sql import functions as F
    return df.withColumns({k: F.lit(v) for k, v in clash.items()})


@pytest.fixture(scope="session")
def none(spark, edge):
    return spark.createDataFrame([], edge.schema)


@pytest.fixture(scope="session")
def tiny_labels(spark):
    return spark.createDataFrame([(i, i % 2, int(i == 6)) for i in range(12)] + [(None, 1, 1), (2, None, None)],
                                 "doc_id long, quality int, toxic int")


def small_documents():
    """The rows of documents at sf0.001."""
    import duckdb

    return duckdb.sql("SELECT doc_id, text FROM read_parquet('/root/testdata/sf0.001/documents.parquet')").fetchall()
