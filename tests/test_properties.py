"""Properties of the reports: totals add up, views keep their grain."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import functions as F

from hemotab.plans import catalog as C
from hemotab.plans import reports as RP
from hemotab.plans import views as V
from hemotab.profile import fixture_profile

P = fixture_profile()


def _xt(tables, name):
    spec, _ = RP.CROSSTABS[name]
    s, e = C.PERIODS[spec.name]
    return RP.crosstab(tables, name, s, e, as_of=C.AS_OF, profile=P)


def test_totals_equal_sum_of_members(check_tables):
    rows = [r.asDict() for r in _xt(check_tables, "donation_by_site").collect()]
    members = defaultdict(int)
    totals = {}
    for r in rows:
        if r["g_venue"] == 0 and r["g_gender"] == 0 and r["g_ageGroup"] == 0:
            key = (r["venue"], r["gender"], r["ageGroup"])
            if r["g_donationType"] == 0:
                members[key] += r["n"]
            else:
                totals[key] = r["n"]
    assert totals and all(members[k] == v for k, v in totals.items())


def test_by_site_summed_over_sites_equals_first(check_tables):
    by_site = _xt(check_tables, "hivPrevalence_by_site").where("g_venue = 0 AND g_hivPrevalence = 0")
    summed = by_site.groupBy("hivPrevalence", "gender", "ageGroup", "g_gender", "g_ageGroup").agg(
        F.sum("n").alias("n"))
    first = _xt(check_tables, "hivPrevalence_all").where("g_hivPrevalence = 0").drop("g_hivPrevalence")
    assert sorted(map(tuple, summed.collect()), key=str) == sorted(
        map(tuple, first.select(*summed.columns).collect()), key=str)


def test_donation_view_one_row_per_number(check_tables):
    v = V.donation_summary(check_tables, as_of=C.AS_OF, profile=P, columns=["donationIdentificationNumber"])
    assert v.count() == v.select("donationIdentificationNumber").distinct().count()


def test_testing_view_same_grain_as_donation_view(check_tables):
    a = V.donation_summary(check_tables, as_of=C.AS_OF, profile=P, columns=["donationIdentificationNumber"])
    b = V.testing_summary(check_tables, as_of=C.AS_OF, profile=P, columns=["donationIdentificationNumber"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_returns_fan_out_and_dedupe_option(check_tables):
    fan = V.inventory_summary(check_tables, as_of=C.EXPIRY_AS_OF, profile=P, columns=["componentCode"]).count()
    once = V.inventory_summary(check_tables, as_of=C.EXPIRY_AS_OF, profile=P, columns=["componentCode"],
                               dedupe_returns=True).count()
    live = check_tables["Component"].where(~F.col("isDeleted")).count()
    assert once == live < fan


def test_run_report_outputs(check_tables):
    s, e = C.PERIODS["donation"]
    out = RP.run_report(check_tables, "donation", s, e, as_of=C.AS_OF, profile=P)
    assert set(out) == {"metadata", "donation_all", "donation_by_site", "combined"}
    meta = out["metadata"].first()
    assert meta.title == "Donation Summary Report" and meta.period == f"Date Period:  {s}  to  {e}"
    combined = out["combined"].groupBy("crosstab").count().collect()
    assert {r["crosstab"]: r["count"] for r in combined} == {
        "donation_all": out["donation_all"].count(), "donation_by_site": out["donation_by_site"].count()}


def test_run_reports_batch_equals_single_reports(check_tables):
    s, e = C.DONATION_PERIOD
    names = ["donation", "donorCounselling", "hivPrevalence", "ttiCoinfection", "bloodGrouping"]
    batch = RP.run_reports(check_tables, names, s, e, as_of=C.AS_OF, profile=P).cache()
    for name in names:
        for xt in RP.REPORTS[name].crosstabs:
            single = RP.crosstab(check_tables, xt.name, s, e, as_of=C.AS_OF, profile=P)
            part = batch.where(F.col("crosstab") == xt.name).select(*single.columns)
            assert sorted(map(tuple, single.collect()), key=str) == sorted(map(tuple, part.collect()), key=str)
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") >= 1
    batch.unpersist()


def test_wide_form_every_report(small_tables):
    """Wide cells equal long cells, and row totals sit in the Total column."""
    for report, spec in RP.REPORTS.items():
        s, e = C.PERIODS[report]
        out = RP.run_report(small_tables, report, s, e, as_of=C.view_as_of(spec.view), profile=P, wide=True)
        for xt in spec.crosstabs:
            long = out[xt.name]
            wide = out[f"{xt.name}_wide"]
            assert wide.count() == long.where(" AND ".join(f"g_{g.field} = 1" for g in xt.cols)).count()
            grand = wide.where(" AND ".join(f"g_{g.field} = 1" for g in xt.rows)).first()
            total = long.where(" AND ".join(f"g_{k} = 1" for k in xt.keys)).first()
            if total is not None:
                assert grand["Total"] == total.n, xt.name
