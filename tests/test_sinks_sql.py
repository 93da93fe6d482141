"""Sinks, registered views with bound parameters, and presentation order."""

from __future__ import annotations

import tempfile

from hemotab.operators import crosstab as X
from hemotab.plans import catalog as C
from hemotab.plans import reports as RP
from hemotab.plans.views import register_views
from hemotab.profile import fixture_profile
from hemotab.sources.sinks import export_view, write_report

P = fixture_profile()


def test_write_report_roundtrip(spark, small_tables):
    s, e = C.PERIODS["deferral"]
    out = RP.run_report(small_tables, "deferral", s, e, as_of=C.AS_OF, profile=P)
    root = tempfile.mkdtemp(prefix="hemotab-sink-", dir="/tmp")
    for fmt in ("parquet", "csv", "json"):
        write_report(out, f"{root}/{fmt}", "deferral", s, e, fmt=fmt)
    back = spark.read.parquet(f"{root}/parquet/crosstabs").where("crosstab = 'deferral_by_site'")
    assert back.count() == out["deferral_by_site"].count()
    assert spark.read.option("header", "true").csv(f"{root}/csv/crosstabs").count() == out["combined"].count()
    assert spark.read.json(f"{root}/json/metadata").first().title == "Deferral Summary Report"
    # a second period is added, a re-run of the first replaces it
    out2 = RP.run_report(small_tables, "deferral", "2024-01-03", "2024-01-04", as_of=C.AS_OF, profile=P)
    write_report(out2, f"{root}/parquet", "deferral", "2024-01-03", "2024-01-04")
    write_report(out, f"{root}/parquet", "deferral", s, e)
    all_runs = spark.read.parquet(f"{root}/parquet/crosstabs")
    assert all_runs.count() == out["combined"].count() + out2["combined"].count()
    assert spark.read.parquet(f"{root}/parquet/metadata").count() == 2


def test_sql_form_with_bound_parameters(spark, small_tables):
    register_views(small_tables, as_of=C.AS_OF, profile=P)
    s, e = C.PERIODS["donation"]
    via_sql = RP.dataset_sql(spark, "donation", s, e)
    via_df = RP.dataset(small_tables, "donation", s, e, as_of=C.AS_OF, profile=P)
    assert via_sql.columns == list(RP.REPORTS["donation"].fields)
    assert sorted(map(tuple, via_sql.collect()), key=str) == sorted(
        map(tuple, via_df.select(*via_sql.columns).collect()), key=str)
    ds, de = C.PERIODS["discard"]
    assert RP.dataset_sql(spark, "discard", ds, de).count() == RP.dataset(
        small_tables, "discard", ds, de, profile=P).count()


def test_report_order_totals_last_gender_descending(small_tables):
    spec, xt = RP.CROSSTABS["donation_all"]
    s, e = C.PERIODS["donation"]
    long = RP.crosstab(small_tables, "donation_all", s, e, as_of=C.AS_OF, profile=P)
    rows = X.ordered(long, xt).collect()
    first_type = rows[0].donationType
    block = [r for r in rows if r.donationType == first_type and r.g_donationType == 0 and r.g_ageGroup == 1]
    assert [r.gender for r in block if r.g_gender == 0][:2] == ["male", "female"]
    assert rows[-1].g_donationType == 1 and rows[-1].g_gender == 1 and rows[-1].g_ageGroup == 1


def test_export_view_sorted(spark, small_tables):
    from hemotab.plans.views import deferral_summary
    path = tempfile.mkdtemp(prefix="hemotab-export-", dir="/tmp") + "/v"
    export_view(deferral_summary(small_tables, as_of=C.AS_OF, profile=P), path, ["deferralDate"])
    assert spark.read.parquet(path).count() > 0


def test_wide_form_is_written(spark, small_tables):
    s, e = C.PERIODS["discard"]
    out = RP.run_report(small_tables, "discard", s, e, profile=P, wide=True)
    root = tempfile.mkdtemp(prefix="hemotab-sink-", dir="/tmp")
    write_report(out, root, "discard", s, e)
    back = spark.read.parquet(f"{root}/discard_by_site_wide")
    wide = out["discard_by_site_wide"]
    assert back.count() == wide.count()
    assert back.columns[:len(wide.columns)] == wide.columns and wide.columns[-1] == "Total"


def test_sql_form_follows_the_release(spark):
    from conftest import SF_SMALL
    from hemotab.profile import PROFILES
    from hemotab.sources.fixtures import fixture_tables

    for release in ("1.0.0", "1.4.0"):
        p = PROFILES[release]
        tables = fixture_tables(spark, SF_SMALL, p)
        register_views(tables, as_of=C.AS_OF, profile=p)
        via_sql = RP.dataset_sql(spark, "donation", *C.MONTH, profile=p).count()
        assert via_sql == RP.dataset(tables, "donation", *C.MONTH, as_of=C.AS_OF, profile=p).count()


def test_options_are_routed_by_view(small_tables):
    import pytest

    s, e = C.MONTH
    RP.run_reports(small_tables, None, s, e, as_of=C.AS_OF, profile=P, strict_gate=True, dedupe_returns=True)
    RP.run_report(small_tables, "donation", s, e, as_of=C.AS_OF, profile=P, strict_gate=True)
    for name in ("discard", "ttiCoinfection"):
        with pytest.raises(ValueError, match="nonsense"):
            RP.run_report(small_tables, name, s, e, profile=P, nonsense=1)


def test_release_rows_can_fail(spark):
    """All four TTI labels occur, and each release flag changes a result."""
    from dataclasses import replace

    from conftest import SF_CHECK
    from hemotab.profile import PROFILES
    from hemotab.sources.fixtures import fixture_tables

    old = PROFILES["1.0.0"]
    tables = fixture_tables(spark, SF_CHECK, old)

    def counts(profile, name="hivPrevalence_all"):
        return sorted(map(tuple, RP.crosstab(tables, name, *C.DONATION_PERIOD, as_of=C.AS_OF, profile=profile).collect()), key=str)

    labels = {r[0] for r in counts(old, "donorCounselling_all")}
    assert {"Reactive for HIV", "Reactive for Other TTIs", "TTI Unreactive", "Unknown"} <= labels
    right = counts(old)
    assert right != counts(replace(old, tti_unsafe="UNSAFE"))
    assert right != counts(replace(old, tests_exclude_deleted=True))
    assert right != counts(replace(old, test_ids=PROFILES["1.3.0"].test_ids | {"hiv": (21, 22)}))
