"""Case tables: every branch of the recodes, with nulls."""

from __future__ import annotations

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from hemotab.functions import recodes as R
from hemotab.profile import PROFILES, fixture_profile

P = fixture_profile()


def one(spark, schema, rows, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


@pytest.mark.parametrize("birth,as_of,age", [
    ("2004-02-29", "2005-02-28", 0),
    ("2004-02-29", "2005-03-01", 1),
    ("2000-12-31", "2001-12-30", 0),
    ("2000-12-31", "2001-12-31", 1),
    ("1980-06-15", "2001-12-31", 21),
    (None, "2001-12-31", None),
])
def test_age_anniversary(spark, birth, as_of, age):
    b = dt.date.fromisoformat(birth) if birth else None
    assert one(spark, "b date", [(b,)], R.age_years("b", as_of)) == [age]


def test_age_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
        got = one(spark, "b date", [(dt.date(1990, 10, 14),)], R.age_years("b", "2001-10-14"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [11]


def test_age_band_edges(spark):
    ages = [None, 15, 16, 25, 26, 35, 36, 50, 51, 65, 66]
    got = one(spark, "a long", [(a,) for a in ages], R.age_band("a"))
    assert got == ["Other", "Other", "16-25", "16-25", "26-35", "26-35", "36-50", "36-50",
                   "51-65", "51-65", "Other"]


def test_blood_type_and_grouping(spark):
    rows = [("O", "+", "MATCH"), ("AB", "-", "RESOLVED"), ("A", "+", "NOT_DONE"),
            ("B", None, "MATCH"), (None, "+", "NO_TYPE_DETERMINED"), ("C", "+", "MATCH"), ("A", "-", None)]
    df = spark.createDataFrame(rows, "abo string, rh string, ms string")
    got = df.select(R.blood_type("abo", "rh").alias("t"),
                    R.blood_grouping(R.blood_type("abo", "rh"), "ms").alias("g")).collect()
    assert [tuple(r) for r in got] == [
        ("O+", " O+"), ("AB-", " AB-"), ("A+", "Unknown"), (None, "Unknown"),
        (None, "No Type Determined"), ("C+", "Unknown"), ("A-", "Unknown")]


def test_counselling_label(spark):
    vals = ["RECEIVED_COUNSELLING", "REFUSED_COUNSELLING", "OTHER", None]
    assert one(spark, "s string", [(v,) for v in vals], R.counselling_label("s")) == [
        "Counselled", "Refused Counselling", "Not Counselled", "Not Counselled"]


def test_tti_reactive_status(spark):
    rows = [("UNSAFE", True, True), ("UNSAFE", True, None), ("UNSAFE", True, False),
            ("SAFE", True, True), ("UNSAFE", False, True), ("SAFE", None, None), (None, True, None)]
    got = one(spark, "ttiStatus string, released boolean, hiv_pos boolean", rows, R.tti_reactive_status(P))
    assert got == ["Reactive for HIV", "Reactive for Other TTIs", "Reactive for Other TTIs",
                   "TTI Unreactive", "Unknown", "Unknown", "Unknown"]


def test_old_status_codes(spark):
    old = PROFILES["1.3.0"]
    rows = [("TTI_UNSAFE", True, True), ("UNSAFE", True, True), ("TTI_SAFE", True, None)]
    got = one(spark, "ttiStatus string, released boolean, hiv_pos boolean", rows, R.tti_reactive_status(old))
    assert got == ["Reactive for HIV", "Unknown", "TTI Unreactive"]


def test_component_and_order_status(spark):
    codes = ["PROCESSED", "EXPIRED", "DISCARDED", "ISSUED", "TRANSFUSED", "AVAILABLE", None]
    assert one(spark, "s string", [(c,) for c in codes], R.component_status_label("s")) == [
        "Processed", "Expired", "Discarded", "Issued", "Transfused", "Other States", "Other States"]
    orders = ["CREATED", "DISPATCHED", "X", None]
    assert one(spark, "s string", [(c,) for c in orders], R.order_status_label("s")) == [
        "Order not Dispatched", "Issued", "Unknown", "Unknown"]


@pytest.mark.parametrize("expires,label", [
    ("2024-01-01 13:00:00", "NOT EXPIRED"),   # 11 hours before midnight: 0 whole days
    ("2023-12-31 23:00:00", "EXPIRED"),       # 25 hours
    ("2024-01-01 00:00:00", "EXPIRED"),       # exactly 24 hours
    ("2024-01-01 00:00:01", "NOT EXPIRED"),
    ("2024-01-03 00:00:00", "NOT EXPIRED"),   # in the future
    (None, "NOT EXPIRED"),
])
def test_expiry(spark, expires, label):
    v = dt.datetime.fromisoformat(expires) if expires else None
    assert one(spark, "e timestamp_ntz", [(v,)], R.expiry_status("e", "2024-01-02")) == [label]


def test_prevalence(spark):
    rows = [(True, "UNSAFE", True), (True, "SAFE", True), (None, "UNSAFE", True),
            (True, "UNSAFE", False), (True, "UNSAFE", None)]
    got = one(spark, "hbv_pos boolean, ttiStatus string, released boolean", rows, R.prevalence("hbv", P))
    assert got == ["Reactive for HBV", "Not Reactive for HBV", "Not Reactive for HBV", "Unknown", "Unknown"]


def _coinfection_expected(h, b, c, s, gate, released, strict):
    pos = {"HIV": h, "HBV": b, "HCV": c, "Syphilis": s}
    if gate and h:
        return ", ".join(k for k in ("HIV", "HBV", "HCV", "Syphilis") if pos[k])
    other = (b or c or s) and gate if strict else (b or c or (s and gate))
    if other:
        return "Other TTIs (Excl. HIV)"
    if released:
        return "No TTIs"
    return "Unknown"


@pytest.mark.parametrize("strict", [False, True])
def test_coinfection_truth_table(spark, strict):
    """16 flag combinations x 4 gate states (P16), incl. the precedence quirk."""
    gates = [("UNSAFE", True), ("UNSAFE", False), ("SAFE", True), ("SAFE", None)]
    rows = [(h, b, c, s, t, r) for h, b, c, s in itertools.product([True, False], repeat=4) for t, r in gates]
    df = spark.createDataFrame(rows, "hiv_pos boolean, hbv_pos boolean, hcv_pos boolean, "
                                     "syphilis_pos boolean, ttiStatus string, released boolean")
    got = [r[0] for r in df.select(R.coinfection(P, strict_gate=strict)).collect()]
    want = [_coinfection_expected(h, b, c, s, t == "UNSAFE" and bool(r), bool(r), strict)
            for h, b, c, s, t, r in rows]
    assert got == want


def test_coinfection_quirk_unreleased_hbv(spark):
    df = spark.createDataFrame([(False, True, False, False, "UNSAFE", False)],
                               "hiv_pos boolean, hbv_pos boolean, hcv_pos boolean, syphilis_pos boolean, "
                               "ttiStatus string, released boolean")
    assert df.select(R.coinfection(P)).first()[0] == "Other TTIs (Excl. HIV)"
    assert df.select(R.coinfection(P, strict_gate=True)).first()[0] == "Unknown"


def test_coinfection_missing_flags_act_false(spark):
    df = spark.createDataFrame([(None, None, None, None, "UNSAFE", True)],
                               "hiv_pos boolean, hbv_pos boolean, hcv_pos boolean, syphilis_pos boolean, "
                               "ttiStatus string, released boolean")
    assert df.select(R.coinfection(P)).first()[0] == "No TTIs"
