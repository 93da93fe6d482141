"""Views kept as SQL text in the catalog: same rows as the DataFrame views, in another session."""

from __future__ import annotations

import uuid
from collections import Counter

import pytest

from hemotab.plans import sqlviews as SV
from hemotab.plans import views as V
from hemotab.profile import PROFILES, fixture_profile
from hemotab.sources.colocated import write_colocated
from hemotab.sources.fixtures import fixture_tables

AS_OF = "1998-06-01"


def _views(tables, profile):
    for name, fn in V.VIEWS.items():
        more = {} if fn is V.batch_location else {"profile": profile}
        if fn not in (V.batch_location, V.discard_summary, V.issued_summary):
            more["as_of"] = AS_OF
        yield name, fn(tables, **more)


@pytest.mark.parametrize("release", [None, "1.0.0", "1.4.0"])
def test_same_rows_in_a_second_session(spark, tmp_path, release):
    profile = PROFILES[release] if release else fixture_profile()
    tables = fixture_tables(spark, "/root/testdata/sf0.001", PROFILES[release] if release else None)
    database = f"views_{uuid.uuid4().hex[:8]}"
    held = spark.catalog.currentDatabase()
    write_colocated(tables, database, 4, str(tmp_path))
    SV.create_views(spark, database, profile, AS_OF)
    SV.create_views(spark, database, profile, AS_OF)    # replaces them
    assert spark.catalog.currentDatabase() == held
    other = spark.newSession()
    for name, want in _views(tables, profile):
        got = other.table(f"{database}.{name}")
        assert got.columns == want.columns, name
        assert [f.dataType for f in got.schema.fields] == [f.dataType for f in want.schema.fields], name
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect())), name


def test_unused_columns_cost_no_join(spark, tmp_path):
    tables = fixture_tables(spark, "/root/testdata/sf0.001")
    database = f"views_{uuid.uuid4().hex[:8]}"
    write_colocated(tables, database, 4, str(tmp_path))
    SV.create_views(spark, database, fixture_profile())
    plan = spark.sql(f"SELECT count(*) FROM {database}.testingSummaryView")._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "bloodtestresult" not in plan
