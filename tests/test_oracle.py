"""Every registered query against its independent DuckDB SQL (the driver's gate).

All queries run on sf0.001; a representative subset also on sf0.01.
"""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from conftest import SF_CHECK, SF_SMALL
from harness import compare, duck

from hemotab.plans import catalog as C
from sqlcheck.catalog import TEXT_COLUMNS
from sqlcheck.catalog import oracle_sql as typed_oracle

QUERIES = C.queries()
ORACLE = typed_oracle()
TYPED = C.queries(text=False)
TYPED_ORACLE = typed_oracle(text=False)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries())
    assert set(ORACLE) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def duck_small():
    return duck(SF_SMALL)


@pytest.fixture(scope="module")
def duck_check():
    return duck(SF_CHECK)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_small(spark, duck_small, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), ORACLE[name], duck_small)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(TEXT_COLUMNS))
def test_query_small_typed(spark, duck_small, name):
    """The same detail queries with declared types (dates, decimals, ...)."""
    ok, msg = compare(TYPED[name](spark, SF_SMALL), TYPED_ORACLE[name], duck_small)
    assert ok, msg


def test_only_decimals_and_timestamps_are_rendered(spark):
    df = QUERIES["view_donation_summary"](spark, SF_SMALL)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert kinds["donationDate"] == "date" and kinds["age"] in ("int", "bigint") and kinds["released"] == "boolean"
    assert kinds["donorWeight"] == "string"


@pytest.mark.parametrize("name", ["xt_donorCounselling_by_site", "xt_ttiCoinfection_by_site",
                                  "xt_component_by_site", "view_issued_summary", "profile_100_donation", "xt_wide_discard",
                                  "xt_wide_donation"])
def test_query_check_scale(spark, duck_check, name):
    ok, msg = compare(QUERIES[name](spark, SF_CHECK), ORACLE[name], duck_check)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns


@pytest.mark.parametrize("crosstab,start,end", [
    ("donation_by_site", "1997-03-01", "1997-03-31"),
    ("hivPrevalence_by_site", "1999-12-15", "2000-01-14"),
    ("donorCounselling_all", "1998-07-15", "1998-07-15"),
])
def test_short_periods(spark, duck_check, check_tables, crosstab, start, end):
    """Short periods: the numbers-in-period pre-filter must not change results."""
    from hemotab.plans import reports as RP
    from hemotab.profile import fixture_profile
    from sqlcheck import crosstab_query

    spec, xt = RP.CROSSTABS[crosstab]
    df = RP.crosstab(check_tables, crosstab, start, end, as_of=C.AS_OF, profile=fixture_profile())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan
    sql = crosstab_query(spec.view, [g.field for g in xt.rows], [g.field for g in xt.cols], xt.measure,
                         spec.date_field, spec.period, start, end, C.AS_OF)
    ok, msg = compare(df, sql, duck_check)
    assert ok, msg


def test_empty_period_gives_no_rows(spark, check_tables):
    """No rows in the period: no cells and no totals (DuckDB would return a
    zero grand total; the reference's crosstab shows nothing)."""
    from hemotab.plans import reports as RP
    from hemotab.profile import fixture_profile

    df = RP.crosstab(check_tables, "donorCounselling_all", "1995-01-01", "1995-01-01",
                     as_of=C.AS_OF, profile=fixture_profile())
    assert df.count() == 0
