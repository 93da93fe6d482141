"""Source tables read from a catalog database (``db.Table``)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T
import pytest

from hemotab.plans import catalog as C
from hemotab.plans import reports as RP
from hemotab.profile import fixture_profile
from hemotab.sources.tables import Tables, balanced_edges, range_predicates

P = fixture_profile()


def test_reports_from_catalog_database(spark, small_tables):
    spark.sql("CREATE DATABASE IF NOT EXISTS blood_service")
    for name in small_tables:
        small_tables[name].write.mode("overwrite").saveAsTable(f"blood_service.{name}")
    tables = Tables.from_catalog(spark, "blood_service", T.LongType())
    for report in ("deferral", "donation"):
        s, e = C.PERIODS[report]
        as_of = C.view_as_of(RP.REPORTS[report].view)
        a = RP.run_report(small_tables, report, s, e, as_of=as_of, profile=P)["combined"]
        b = RP.run_report(tables, report, s, e, as_of=as_of, profile=P)["combined"]
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_reports_from_csv_files(spark, small_tables, tmp_path):
    """Source tables as CSV: the same schemas, the same report."""
    from pyspark.sql import types as T

    for name in small_tables:
        small_tables[name].write.option("header", "true").csv(str(tmp_path / name))
    tables = Tables.from_files(spark, str(tmp_path), fmt="csv", test_id_type=T.LongType(),
                               options={"header": "true"})
    for report in ("deferral", "discard"):
        s, e = C.PERIODS[report]
        as_of = C.view_as_of(RP.REPORTS[report].view)
        a = RP.run_report(small_tables, report, s, e, as_of=as_of, profile=P)["combined"]
        b = RP.run_report(tables, report, s, e, as_of=as_of, profile=P)["combined"]
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_flags_kept_as_numbers_or_text_are_cast(spark, small_tables):
    """Integer and text flags become booleans, whatever the source's types."""
    spark.sql("CREATE DATABASE IF NOT EXISTS blood_flags")
    for name in small_tables:
        df = small_tables[name]
        kinds = dict(df.dtypes)
        flags = [c for c, k in kinds.items() if k == "boolean"]
        df = df.withColumns({c: F.col(c).cast("int").cast("string" if name == "Donor" else "int") for c in flags})
        df.write.mode("overwrite").saveAsTable(f"blood_flags.{name}")
    tables = Tables.from_catalog(spark, "blood_flags", T.LongType())
    s, e = C.PERIODS["donation"]
    a = RP.run_report(small_tables, "donation", s, e, as_of=C.AS_OF, profile=P)["combined"]
    b = RP.run_report(tables, "donation", s, e, as_of=C.AS_OF, profile=P)["combined"]
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_unpartitioned_facts_are_refused(spark):
    with pytest.raises(ValueError, match="Donation"):
        Tables.from_jdbc(spark, "jdbc:x:y", {}, {"Donor": ("id", 0, 10, 2)})


def test_jdbc_ranges_are_balanced(spark):
    """Keys with a gap: even strides would leave one range with most rows."""
    keys = spark.range(9_000).select(F.col("id")).unionAll(spark.range(10**9, 10**9 + 1_000)).unionAll(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    edges = balanced_edges(keys, "id", 8)
    assert len(edges) == 7
    found = keys.select(*[F.expr(p).alias(f"p{k}") for k, p in enumerate(range_predicates("id", edges))])
    held = [F.coalesce(F.col(c), F.lit(False)).cast("int") for c in found.columns]
    sizes = found.agg(*[F.sum(h) for h in held]).first()
    assert found.where(sum(held) != 1).isEmpty() and sum(sizes) == 10_001 and max(sizes) < 1_500 and min(sizes) > 1_000


def test_jdbc_ranges_of_few_keys(spark):
    same = spark.range(100).select(F.lit(5).cast("long").alias("id"))
    assert balanced_edges(same, "id", 4) == [5]
    assert range_predicates("id", [5]) == ["id < 5 OR id IS NULL", "id >= 5"]
    assert balanced_edges(same.limit(0), "id", 4) == [] and range_predicates("id", []) == ["1 = 1"]
    assert balanced_edges(same, "id", 1) == []
