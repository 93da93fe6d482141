"""Published reports appear together; exports keep their order across files."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from hemotab.plans import catalog as C
from hemotab.plans import reports as RP
from hemotab.profile import fixture_profile
from hemotab.sources import sinks
from hemotab.sources.versions import Manifest

P = fixture_profile()
WHOLE, MARCH = ("1996-01-01", "2000-12-31"), ("1997-03-01", "1997-03-31")


def _run(tables, name, period, wide=False):
    return name, *period, RP.run_report(tables, name, *period, as_of=C.AS_OF, profile=P, wide=wide)


def _cells(df, report):
    keys = RP.REPORTS[report].keys
    rows = df.where(F.col("report") == report) if "report" in df.columns else df
    return sorted(str(tuple(r)) for r in rows.select("crosstab", *keys, *[f"g_{k}" for k in keys], "n").collect())


def test_a_failure_midway_leaves_the_old_reports_whole(spark, small_tables, tmp_path, monkeypatch):
    store = sinks.ReportStore(spark, str(tmp_path / "r"))
    with pytest.raises(ValueError):
        store.crosstabs()
    store.publish([_run(small_tables, "discard", WHOLE, wide=True), _run(small_tables, "component", WHOLE)])
    before = {r: _cells(store.crosstabs(), r) for r in ("discard", "component")}
    wide = sorted(map(str, store.wide("discard_all").drop("run").collect()))
    newer = [("discard", *WHOLE, _run(small_tables, "discard", MARCH, wide=True)[3]), _run(small_tables, "discard", MARCH)]

    def lost(self, parts):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:  # everything is written, nothing becomes visible
        m.setattr(Manifest, "publish", lost)
        with pytest.raises(RuntimeError):
            store.publish(newer)
    assert {r: _cells(store.crosstabs(), r) for r in before} == before and store.manifest.version() == 1
    assert sorted(map(str, store.wide("discard_all").collect())) == wide
    store.publish(newer)
    got = store.crosstabs().where(F.col("period_start") == F.lit("1996-01-01").cast("date"))
    assert _cells(got, "component") == before["component"]
    assert _cells(got, "discard") == _cells(newer[0][3]["combined"], "discard") != before["discard"]
    assert store.metadata().count() == 3 and store.metadata().where("report = 'component'").first()["title"] == "Component Summary Report"


def test_reports_without_rows_and_repeats(spark, small_tables, tmp_path):
    store = sinks.ReportStore(spark, str(tmp_path / "r"))
    never = ("1901-01-01", "1901-01-31")
    store.publish([_run(small_tables, "discard", never), _run(small_tables, "discard", MARCH)])
    assert store.crosstabs().where("period_start < DATE'1950-01-01'").count() == 0 < store.crosstabs().count()
    for bad in ([], [_run(small_tables, "discard", MARCH)] * 2):
        with pytest.raises(ValueError):
            store.publish(bad)


@pytest.mark.parametrize("alike", [False, True])
def test_a_hot_date_is_dealt_to_many_files(spark, tmp_path, alike):
    """Half of the rows share a date (or are all alike): order holds, no file has them all."""
    n = 40_000
    rows = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 2 == 0, F.lit("2000-06-15")).otherwise(F.date_add(F.lit("2000-01-01"), (F.col("id") % 300).cast("int")).cast("string"))
        .cast("date").alias("day"), F.lit("x").alias("body") if alike else F.sha2(F.col("id").cast("string"), 256).alias("body"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.export_view(rows, str(tmp_path / "v"), ["day"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    files = sorted(glob.glob(str(tmp_path / "v" / "*.parquet")))
    days = [[r[0] for r in spark.read.parquet(f).select("day").collect()] for f in files]
    assert [d for f in days for d in f] == sorted(d for f in days for d in f) and sum(map(len, days)) == n
    assert max(map(len, days)) < n / 4
    placed = sinks.places(spark, str(tmp_path / "v"), ["day"]).groupBy("day").agg(F.min("place").alias("a"), F.max("place").alias("b")).orderBy("day").collect()
    assert [(r["a"], r["b"]) for r in placed] == [(k, k) for k in range(1, len(placed) + 1)]


def test_places_shows_a_wrong_order(spark, tmp_path):
    spark.createDataFrame([(1,), (2,), (1,), (None,), (None,)], "k int").coalesce(1).write.parquet(str(tmp_path / "w"))
    assert [(r["k"], r["place"]) for r in sinks.places(spark, str(tmp_path / "w"), ["k"]).orderBy("place", "k").collect()] == \
        [(1, 1), (2, 2), (1, 3), (None, 4), (None, 4)]


def test_age_expression(spark):
    """Truncated towards zero before birth too."""
    from hemotab.functions import recodes as R

    births = ["1960-03-01", "1961-02-27", "1961-03-01", "1960-02-29", "1959-02-28", "1964-02-29", "1964-02-28", None]
    rows = spark.createDataFrame([(b,) for b in births], "b string").select(F.col("b").cast("date").alias("b"))
    assert [r[0] for r in rows.select(R.age_years("b", "1960-02-29")).collect()] == [0, 0, -1, 0, 1, -4, -3, None]
