"""Wide rows move once: results on odd keys, and what the plans shuffle."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemotab.plans import views as V
from hemotab.profile import fixture_profile
from hemotab.sources.schema import schemas
from hemotab.sources.tables import Tables

P = fixture_profile()


def _tables(spark, **rows):
    sch = schemas(T.LongType())
    return Tables(spark, {n: spark.createDataFrame([{f.name: r.get(f.name) for f in sch[n].fields} for r in rows.get(n, [])], sch[n])
                          for n in sch})


@pytest.fixture(scope="module")
def odd(spark):
    """Components without donation or id, alike ids in two donations, a donation
    with many returns, components returned twice and alike rows."""
    component = [{"id": i, "donation_id": i // 5, "componentBatch_id": i % 4 or None, "componentCode": f"C{i}", "isDeleted": i == 8}
                 for i in range(40)]
    component += [{"id": 100 + i, "donation_id": 50, "componentCode": "many", "isDeleted": False} for i in range(V.RETURNS_TOGETHER + 9)]
    component += [{"id": 7, "donation_id": 3, "componentCode": "alike id", "isDeleted": False},
                  {"id": 7, "donation_id": 3, "componentCode": "alike id", "isDeleted": False},
                  {"id": 300, "componentCode": "no donation", "isDeleted": False},
                  {"id": 7, "componentCode": "no donation", "isDeleted": False},
                  {"donation_id": 3, "componentCode": "no id", "isDeleted": False}]
    links = [{"component_id": i, "returnForm_id": i % 3} for i in [*range(0, 40, 3), 7, 7, 8, 300, 300, 999]]
    links += [{"component_id": 100 + i, "returnForm_id": i % 3} for i in range(V.RETURNS_TOGETHER + 5)] + [{"returnForm_id": 1}]
    return _tables(
        spark, Component=component, ReturnForm_Component=links,
        ReturnForm=[{"id": 0, "status": "CREATED"}, {"id": 1, "status": "RETURNED"}],
        Donation=[{"id": i, "donationIdentificationNumber": f"D{i}"} for i in [*range(7), 3, 50]],
        ComponentBatch=[{"id": 1, "location_id": 0}, {"id": 2, "location_id": 1}, {"id": 3}],
        Location=[{"id": 0, "name": "A"}, {"id": 1, "name": "B"}])


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("dedupe", [True, False])
def test_inventory_on_odd_keys(odd, small, dedupe, monkeypatch):
    monkeypatch.setattr(V, "known_small", lambda frame: small)
    cols = ["donationIdentificationNumber", "componentCode", "processedAtLocation", "returnStatus"]
    found = V.inventory_summary(odd, profile=P, columns=cols, dedupe_returns=dedupe)
    c = odd["Component"].where(~F.col("isDeleted")).alias("c")
    links = odd["ReturnForm_Component"].where("component_id IS NOT NULL")
    if dedupe:
        links = links.groupBy("component_id").agg(F.max("returnForm_id").alias("returnForm_id"))
    sites = odd["ComponentBatch"].alias("b").join(odd["Location"].alias("l"), F.expr("b.location_id = l.id")).selectExpr("b.id", "l.name")
    plain = (c.join(odd["Donation"].alias("d"), F.expr("c.donation_id = d.id"), "left")
             .join(sites.alias("s"), F.expr("c.componentBatch_id = s.id"), "left")
             .join(links.alias("k"), F.expr("c.id = k.component_id"), "left")
             .join(odd["ReturnForm"].alias("f"), F.expr("k.returnForm_id = f.id"), "left")
             .selectExpr("donationIdentificationNumber", "componentCode", "s.name", "f.status"))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, map(tuple, plain.collect())))


def test_inventory_rows_move_once(spark, small_tables, tmp_path):
    for name in small_tables:
        small_tables[name].write.parquet(str(tmp_path / name))
    stored = Tables.from_files(spark, str(tmp_path), test_id_type=T.LongType())
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        view = V.inventory_summary(stored, profile=P, columns=V.INVENTORY_COLUMNS)
        # One to the donation; the other is of components without one and of crowded donations.
        plan = view._jdf.queryExecution().executedPlan().toString()
        wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(id#" in line]
        assert len(wide) == 1
        assert plan.count("Exchange hashpartitioning(componentBatch_id") == plan.count("Exchange hashpartitioning(__key") == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def _plan_of_stored(spark, tables, tmp_path, build) -> str:
    for name in tables:
        tables[name].write.parquet(str(tmp_path / name))
    stored = Tables.from_files(spark, str(tmp_path), test_id_type=T.LongType())
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return build(stored)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)


def test_donation_rows_stay_with_their_id(spark, small_tables, tmp_path):
    plan = _plan_of_stored(spark, small_tables, tmp_path, lambda t: V.donation_summary(t, as_of="2001-12-31", profile=P)).splitlines()
    dealt = [i for i, line in enumerate(plan) if "Exchange hashpartitioning(donor_id#" in line]
    assert dealt and not any("bleedStartTime" in plan[i + 1] for i in dealt)


def test_donors_of_repeated_donations(spark):
    """Alike ids with other donors, alike donors, and no donor."""
    rows = [{"id": i, "donationIdentificationNumber": f"D{i}", "donor_id": d, "packType_id": 0, "isDeleted": False, "donorPulse": p}
            for i, d, p in [(1, 10, 1), (1, 11, 2), (1, 11, 2), (2, 10, 3), (3, 12, 4), (4, None, 5), (5, 99, 6)]]
    t = _tables(spark, Donation=rows, PackType=[{"id": 0, "packType": "Single", "countAsDonation": True}],
                Donor=[{"id": d, "donorNumber": n, "isDeleted": False, "donorStatus": "NORMAL"}
                       for d, n in [(10, "a"), (11, "b"), (12, "c"), (12, "d")]])
    found = V.donation_summary(t, as_of="2001-12-31", profile=P).select("donationIdentificationNumber", "donorNumber", "donorPulse").collect()
    assert sorted(map(tuple, found)) == [("D1", "a", 1), ("D1", "b", 2), ("D1", "b", 2), ("D2", "a", 3), ("D3", "c", 4), ("D3", "d", 4)]


def test_changed_keys_are_summed_as_longs(spark):
    from hemotab.plans.incremental import CHANGE_KEYS, changed_keys

    def results(*rows):
        return _tables(spark, BloodTestResult=[{"donation_id": k, "bloodTest_id": b, "result": r} for k, b, r in rows])

    before = results((1, 1, "POS"), (2, 1, "POS"), (2, 1, "POS"), (3, 1, "NEG"), (3, 2, "POS"), (4, 1, "POS"), (None, 1, "POS"), (5, 1, None))
    after = results((1, 1, "POS"), (2, 1, "NEG"), (2, 1, "NEG"), (3, 2, "POS"), (3, 1, "NEG"), (4, 1, "POS"), (4, 1, "POS"), (6, 1, "NEG"))
    found = changed_keys(before, after)
    assert set(found) == set(CHANGE_KEYS)
    assert sorted(r[0] for r in found["BloodTestResult"].collect()) == [2, 4, 5, 6]
    assert "decimal" not in found["BloodTestResult"]._jdf.queryExecution().optimizedPlan().toString()


def test_export_moves_few_bytes_beside_the_rows(spark, tmp_path, monkeypatch):
    from hemotab.sources import sinks

    seen = []
    kind = type(spark.range(1))
    sort = kind.orderBy
    monkeypatch.setattr(kind, "orderBy", lambda df, *c, **k: (seen.append(df.schema), sort(df, *c, **k))[1])
    rows = spark.range(5000).selectExpr("DATE'2000-01-01' AS day", "id % 2 AS x")
    sinks.export_view(rows, str(tmp_path / "out"), ["day"])
    extra = [f.dataType for f in seen[0].fields if f.name not in rows.columns]
    assert extra == [T.IntegerType(), T.ShortType()]
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.columns == rows.columns and back.groupBy("x").count().collect() and back.count() == 5000
