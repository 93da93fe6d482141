"""The stored donation base gives the same reports as the on-the-fly plan."""

from __future__ import annotations

import tempfile

from hemotab.plans import catalog as C
from hemotab.plans import reports as RP
from hemotab.plans.materialize import use_donation_base, write_donation_base
from hemotab.profile import fixture_profile
from hemotab.sources.fixtures import fixture_tables
from conftest import SF_SMALL

P = fixture_profile()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stored_base_same_reports(spark, small_tables):
    path = tempfile.mkdtemp(prefix="hemotab-base-", dir="/tmp") + "/base"
    write_donation_base(small_tables, P, path=path)
    stored = use_donation_base(fixture_tables(spark, SF_SMALL), path, P)
    for report in ("donation", "donorCounselling", "ttiCoinfection", "hivPrevalence", "bloodGrouping"):
        s, e = C.PERIODS[report]
        for xt in RP.REPORTS[report].crosstabs:
            a = RP.crosstab(small_tables, xt.name, s, e, as_of=C.AS_OF, profile=P)
            b = RP.crosstab(stored, xt.name, s, e, as_of=C.AS_OF, profile=P)
            assert _rows(a) == _rows(b), xt.name
    plan = RP.crosstab(stored, "donation_all", "1997-03-05", "1997-04-20", as_of=C.AS_OF, profile=P)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(donationMonth" in text
    assert "min(struct(" not in text  # no collapse at read time


def test_all_stored_bases_same_reports(spark, small_tables):
    from hemotab.plans.materialize import use_all_bases, write_all_bases

    root = tempfile.mkdtemp(prefix="hemotab-bases-", dir="/tmp")
    paths = write_all_bases(small_tables, P, root=root)
    stored = use_all_bases(fixture_tables(spark, SF_SMALL), paths, P)
    for report, spec in RP.REPORTS.items():
        s, e = C.PERIODS[report]
        as_of = C.view_as_of(spec.view)
        a = RP.run_report(small_tables, report, s, e, as_of=as_of, profile=P)["combined"]
        b = RP.run_report(stored, report, s, e, as_of=as_of, profile=P)["combined"]
        assert _rows(a) == _rows(b), report
        plan = b._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(" in plan, report
        assert "Join" not in plan, report  # a stored report is a pruned scan and two aggregates


def test_hot_month_write_is_split(spark, tmp_path):
    """A month holding nearly every row is written by several tasks (rebalance)."""
    import glob

    from pyspark.sql import functions as F
    from hemotab.plans.materialize import _balanced_by_month

    # 16 map tasks: AQE splits a hot partition at map-output boundaries
    rows = spark.range(0, 200_000, 1, 16).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        F.when(F.col("id") % 100 == 0, F.lit("2000-02-01")).otherwise(F.lit("2000-01-01")).cast("date")
         .alias("month"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        _balanced_by_month(rows, "month").write.partitionBy("month").parquet(str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot = glob.glob(str(tmp_path / "out" / "month=2000-01-01" / "*.parquet"))
    assert len(hot) > 1
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200_000
