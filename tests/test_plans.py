"""Plan shape: what Catalyst must (and must not) do with the report plans."""

from __future__ import annotations

from hemotab.plans import catalog as C
from hemotab.plans import reports as RP
from hemotab.profile import fixture_profile

P = fixture_profile()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _report(tables, name):
    s, e = C.PERIODS[name]
    return RP.run_report(tables, name, s, e, as_of=C.view_as_of(RP.REPORTS[name].view), profile=P)


def test_no_python_no_cartesian(small_tables):
    for name in RP.REPORTS:
        plan = _plan(_report(small_tables, name)["combined"])
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                    "Window"):
            assert bad not in plan, (name, bad)


def test_result_table_scanned_once_per_crosstab(small_tables):
    plan = _plan(_report(small_tables, "ttiCoinfection")["ttiCoinfection_all"])
    # the derived result table comes from lineitem; one scan for flags, one
    # for nothing else: the 22 joins became one conditional aggregate
    assert plan.count("l_returnflag") >= 1
    assert plan.count("FileScan parquet") == plan.count("FileScan parquet [o_") + plan.count(
        "FileScan parquet [c_") + plan.count("FileScan parquet [n_") + 1


def test_expand_sits_above_the_finest_aggregate(small_tables):
    plan = _plan(_report(small_tables, "donation")["donation_by_site"])
    lines = plan.splitlines()
    expand = next(i for i, l in enumerate(lines) if "Expand" in l)
    below = "\n".join(lines[expand + 1:])
    assert "count(" in below.split("Exchange")[0] or "count(" in below


def test_period_pushed_to_scan_for_event_views(small_tables):
    plan = _plan(_report(small_tables, "discard")["discard_all"])
    assert "PushedFilters" in plan and "l_shipdate" in plan.split("PushedFilters")[1].split("]")[0]


def test_choice_reads_all_donations_and_the_period_reaches_the_wide_scan(small_tables):
    """D1 must not see the period; the scan of the chosen donations must."""
    plan = _plan(_report(small_tables, "donation")["donation_all"])
    scans = [l for l in plan.splitlines() if "FileScan parquet" in l and "o_orderkey" in l]
    narrow = [l for l in scans if "o_orderdate" not in l]
    wide = [l for l in scans if "o_orderdate" in l]
    assert narrow and wide
    assert all("o_orderdate" not in l.split("PushedFilters")[1] for l in narrow)


def test_collapse_is_a_hash_aggregate(small_tables):
    from hemotab.plans import views as V

    plan = _plan(V.donation_numbers(small_tables, P))
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "partial_min(id" in plan


def test_no_job_runs_while_reports_are_built(spark, small_tables):
    from hemotab.sources.tables import Tables

    fresh = Tables(spark, {n: small_tables[n] for n in small_tables})
    sc = spark.sparkContext
    sc.setJobGroup("building", "plans only")
    try:
        for name in RP.REPORTS:
            _report(fresh, name)
        RP.run_reports(fresh, None, "1997-03-01", "1997-03-31", as_of=C.AS_OF, profile=P)
        assert not sc.statusTracker().getJobIdsForGroup("building")
    finally:
        sc.setJobGroup("other", "")


# Hash exchanges per report (both crosstabs) when every fact join must
# shuffle (no automatic broadcast) and code lists are broadcast: the shuffle
# budget at scale.  A new shuffle fails this test.  Two or three of a
# donation report's carry ids and keys only (the choice per number).
SHUFFLE_BUDGET = {
    "bloodGrouping": 11, "component": 8, "componentsIssued": 8, "deferral": 6, "discard": 8,
    "donation": 11, "donorCounselling": 13, "hbvPrevalence": 12, "hcvPrevalence": 12,
    "hivPrevalence": 12, "syphilisPrevalence": 12, "ttiCoinfection": 12,
}


def test_shuffle_budget_at_scale(spark, small_tables, tmp_path):
    from pyspark.sql import types as T
    from hemotab.sources.tables import Tables

    for name in small_tables:
        small_tables[name].write.parquet(str(tmp_path / name))
    stored = Tables.from_files(spark, str(tmp_path), test_id_type=T.LongType())
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = {name: _plan(_report(stored, name)["combined"]) for name in SHUFFLE_BUDGET}
        counted = {n: p.count("Exchange hashpartitioning") for n, p in found.items()}
        assert all(counted[n] <= most for n, most in SHUFFLE_BUDGET.items()), counted
        for name, plan in found.items():
            assert "ReusedExchange" in plan, name  # both crosstabs share the finest aggregate
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_batch_shares_one_collapse_per_view(small_tables):
    """Six testing-view reports in one job: one collapse, one test-result
    aggregate, reused by all twelve crosstabs."""
    names = ["bloodGrouping", "hbvPrevalence", "hcvPrevalence", "hivPrevalence", "syphilisPrevalence",
             "ttiCoinfection"]
    s, e = C.DONATION_PERIOD
    batch = RP.run_reports(small_tables, names, s, e, as_of=C.AS_OF, profile=P)
    batch.collect()
    plan = _plan(batch).split("== Initial Plan ==")[0]  # the plan that ran
    nodes = plan.splitlines()
    assert sum("partial_min(id" in n for n in nodes) == 1
    assert sum("partial_max(CASE WHEN" in n for n in nodes) == 1
    assert plan.count("ReusedExchange") >= 11
