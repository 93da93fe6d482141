"""Operators on small hand-made frames: J-T, D1, D2, periods, crosstab, binary ids."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from harness import crosstab_direct

from hemotab.operators import crosstab as X
from hemotab.operators.dedupe import first_by_key, latest_counselling, one_per_donation_number
from hemotab.operators.period import closed_dates, timestamp_period
from hemotab.operators.results import positive_flags
from hemotab.profile import PROFILES, fixture_profile


def test_flags_any_positive_and_deleted(spark):
    rows = [(1, 0, "NEG", False), (1, 1, "POS", False), (2, 0, "POS", True), (2, 1, "NEG", False),
            (3, 2, "POS", False), (3, 9, "POS", False), (4, 5, "NEG", None)]
    df = spark.createDataFrame(rows, "donation_id long, bloodTest_id long, result string, isDeleted boolean")
    got = {r.donation_id: tuple(r)[1:] for r in positive_flags(df, fixture_profile()).collect()}
    assert got == {1: (True, None, None, None), 2: (False, None, None, None), 3: (None, True, None, None)}
    old = {r.donation_id: r.hiv_pos for r in positive_flags(df, fixture_profile("1.0.0")).collect()}
    assert old[2] is True  # 1.0.0 keeps deleted results


def test_flags_binary_ids(spark):
    p = PROFILES["1.4.0"]
    hiv1, _ = p.repeat_ids("hiv")
    _, syph2 = p.repeat_ids("syphilis")
    rows = [(1, bytearray(hiv1), "POS", False), (1, bytearray(b"\x00" * 16), "POS", False),
            (2, bytearray(syph2), "POS", False)]
    df = spark.createDataFrame(rows, "donation_id long, bloodTest_id binary, result string, isDeleted boolean")
    got = {r.donation_id: (r.hiv_pos, r.syphilis_pos) for r in positive_flags(df, p).collect()}
    assert got == {1: (True, None), 2: (None, True)}


def test_one_per_donation_number_lowest_id_and_null_group(spark):
    rows = [(5, "D1"), (3, "D1"), (9, None), (7, None), (4, "D2")]
    df = spark.createDataFrame(rows, "id long, donationIdentificationNumber string")
    got = sorted((r.donationIdentificationNumber or "", r.id) for r in one_per_donation_number(df).collect())
    assert got == [("", 7), ("D1", 3), ("D2", 4)]


def test_dedupe_is_order_insensitive(spark):
    rows = [(i, f"D{i % 7}") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, donationIdentificationNumber string")
    a = one_per_donation_number(df)
    b = one_per_donation_number(df.repartition(13).orderBy(F.rand(7)))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_latest_counselling(spark):
    d = dt.date
    rows = [(1, 10, "RECEIVED_COUNSELLING", True, d(2024, 1, 2)), (2, 10, "REFUSED_COUNSELLING", False, d(2024, 1, 5)),
            (3, 10, None, True, None), (4, 11, None, True, None), (5, 11, "X", False, None),
            (6, 12, "A", True, d(2024, 1, 1)), (7, 12, "B", True, d(2024, 1, 1))]
    df = spark.createDataFrame(rows, "id long, donation_id long, counsellingStatus string, "
                                     "flaggedForCounselling boolean, counsellingDate date")
    got = {r.donation_id: r.counsellingStatus for r in latest_counselling(df).collect()}
    assert got == {10: "REFUSED_COUNSELLING", 11: "X", 12: "B"}


def test_first_by_key_descending(spark):
    df = spark.createDataFrame([(1, "k", 1), (2, "k", 3), (3, "k", 2)], "id long, key string, v long")
    assert first_by_key(df, "key", ["v", "id"], ["key", "v", "id"], descending=True).first().id == 2


def test_periods(spark):
    days = [dt.date(2000, 1, 1), dt.date(2000, 1, 31), dt.date(2000, 2, 1)]
    df = spark.createDataFrame([(x,) for x in days], "d date")
    assert df.where(closed_dates("d", "2000-01-01", "2000-01-31")).count() == 2
    assert df.where(closed_dates("d", "2000-01-01", "2000-01-31", plus_one_day=True)).count() == 3
    ts = [dt.datetime(2000, 1, 31, 23, 59), dt.datetime(2000, 2, 1, 0, 0), dt.datetime(2000, 2, 1, 0, 0, 1)]
    tf = spark.createDataFrame([(x,) for x in ts], "t timestamp_ntz")
    assert tf.where(timestamp_period("t", "2000-01-01", "2000-01-31")).count() == 2  # midnight after end included
    assert tf.where(timestamp_period("t", "2000-01-01", "2000-01-31", half_open=True)).count() == 1


SPEC = X.CrosstabSpec("T", "t", (X.Group("venue"), X.Group("kind")),
                      (X.Group("gender", descending=True), X.Group("band")), "kind",
                      col_values={"gender": ("male", "female", None), "band": ("a", "b")})


def _detail(spark):
    rows = [("v1", "x", "male", "a"), ("v1", "x", "female", "b"), ("v1", None, "male", "a"),
            ("v2", "y", None, "b"), (None, "x", "male", "b"), ("v2", "y", "female", "a")]
    return spark.createDataFrame(rows, "venue string, kind string, gender string, band string")


def test_crosstab_two_step_equals_direct(spark):
    df = _detail(spark)
    two = X.crosstab(X.finest(df, SPEC.keys, SPEC.measure), SPEC)
    one = crosstab_direct(df, SPEC)
    assert sorted(map(tuple, two.collect()), key=str) == sorted(map(tuple, one.collect()), key=str)
    assert two.count() == len({tuple(r) for r in two.collect()})


def test_crosstab_null_label_vs_total(spark):
    long = X.crosstab(X.finest(_detail(spark), SPEC.keys, SPEC.measure), SPEC)
    grand = long.where("g_venue = 1 AND g_kind = 1 AND g_gender = 1 AND g_band = 1").first()
    assert grand.n == 5  # the null kind adds a bucket but counts 0
    null_kind = long.where("kind IS NULL AND g_kind = 0 AND g_gender = 1 AND g_band = 1").first()
    assert null_kind.n == 0
    labels = X.labelled(long, SPEC).where("g_venue = 1").select("venue_label").distinct().collect()
    assert [r[0] for r in labels] == ["Total"]


def test_crosstab_wide(spark):
    long = X.crosstab(X.finest(_detail(spark), SPEC.keys, SPEC.measure), SPEC)
    wide = X.crosstab_wide(long, SPEC)
    assert wide.columns[4:] == ["male|a", "male|b", "male|Total", "female|a", "female|b", "female|Total",
                                "(null)|a", "(null)|b", "(null)|Total", "Total"]
    grand = wide.where("g_venue = 1 AND g_kind = 1").first().asDict()
    assert grand["Total"] == 5 and grand["male|a"] == 1 and grand["(null)|Total"] == 1


def test_wide_members_come_from_the_data(spark):
    """Labels no list names, labels like a total, a null or two parts; nulls
    then totals last; nothing dropped."""
    rows = [("v", m, b) for m in ("male", "other", "Total", "", "a|b", None) for b in ("a", "Total", None)]
    df = spark.createDataFrame(rows, "venue string, gender string, band string")
    spec = X.CrosstabSpec("T", "odd", (X.Group("venue"),), (X.Group("gender", descending=True), X.Group("band")), "venue",
                          col_values={"gender": ("male", None), "band": ("a", "z")})
    wide = X.crosstab_wide(X.crosstab(X.finest(df, spec.keys, "venue"), spec), spec)
    inner = ['"Total"', "a", "z", "(null)", "Total"]
    outer = ["other", "male", '"a|b"', '"Total"', '""', "(null)"]
    assert wide.columns[2:] == [f"{o}|{i}" for o in outer for i in inner] + ["Total"]
    grand = wide.where("g_venue = 1").first().asDict()
    assert grand["Total"] == len(rows) == sum(grand[f"{o}|{i}"] for o in outer for i in inner[:-1])
    assert all(grand[f"{o}|Total"] == 3 for o in outer)


def test_grouping_sets_count():
    assert len(SPEC.grouping_sets()) == 9
