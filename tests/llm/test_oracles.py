"""The registered queries with SQL, against DuckDB."""

from __future__ import annotations

import pytest
from harness import compare, duck

import corpus_pipeline
from hemotab.llm.oracle import ORACLE
from hemotab.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    ok, message = compare(QUERIES[name](spark, SMALL), ORACLE[name], duck(SMALL))
    assert ok, message


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "jaccard_join", "temperature_mixing", "complement_packing"]


def test_registered_only_if_present(monkeypatch):
    import importlib
    import sys

    import __spark_entry__ as entry

    assert "op1_factorisation_machine" in entry.queries() and "pipeline" in entry.queries()
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        with_out = importlib.reload(entry)
        assert not [n for n in with_out.queries() if n.startswith("op") or n == "pipeline"]
    finally:
        monkeypatch.undo()
        importlib.reload(entry)
