"""Bucketed source tables: same rows, and no shuffle where the key is the bucket's."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import types as T

from hemotab.plans import catalog as C
from hemotab.plans import reports as RP
from hemotab.plans import views as V
from hemotab.profile import fixture_profile
from hemotab.sources.colocated import colocated, write_colocated
from hemotab.sources.tables import Tables

P = fixture_profile()


@pytest.fixture(scope="module")
def both(spark, small_tables, tmp_path_factory):
    database = f"buckets_{uuid.uuid4().hex[:8]}"
    root = tmp_path_factory.mktemp("plain")
    for n in small_tables:
        small_tables[n].write.parquet(str(root / n))
    write_colocated(small_tables, database, 6, str(root))
    return Tables.from_files(spark, str(root), test_id_type=T.LongType()), colocated(spark, database, T.LongType())


@pytest.fixture
def at_scale(spark):
    """Every fact join must shuffle or be co-located."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for k, v in zip(old, ("-1", "false")):
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _report(tables, name):
    return RP.run_report(tables, name, *C.PERIODS[name], as_of=C.AS_OF, profile=P)["combined"]


@pytest.mark.parametrize("name", ["donorCounselling", "ttiCoinfection"])
def test_same_rows_with_fewer_shuffles(both, at_scale, name):
    plain, buckets = (_report(t, name) for t in both)
    assert sorted(map(str, plain.collect())) == sorted(map(str, buckets.collect()))
    before, after = (_plan(df).count("Exchange hashpartitioning") for df in (plain, buckets))
    assert after <= before - 4, (before, after)


def test_no_exchange_below_flags_counselling_and_donation_joins(both, at_scale):
    """Donations of a view with their counselling and flags: only the choice per
    number, its ids and the donors' side of the donations move."""
    rows = V._donation_base(both[1], P, ["donationDate", "ttiReactiveStatus", "counsellingStatus"], ("hiv",), counselling=True)
    lines = _plan(rows).splitlines()
    scans = {t: next(i for i, x in enumerate(lines) if "FileScan" in x and f"{t.lower()}[" in x.lower()) for t in ("BloodTestResult", "PostDonationCounselling")}
    depth = [len(x) - len(x.lstrip(" :+-|")) for x in lines]
    for table, at in scans.items():
        above, now = [], depth[at]
        for i in range(at - 1, -1, -1):  # the node's ancestors, the nearest first
            if depth[i] < now:
                above.append(lines[i])
                now = depth[i]
        join = next(i for i, x in enumerate(above) if "Join" in x)
        assert not [x for x in above[:join] if "Exchange" in x], (table, above)
    moved = [x for x in lines if "Exchange hashpartitioning" in x]
    assert len(moved) == 3 and sum("donationIdentificationNumber" in x for x in moved) == 1, moved


def test_tables_are_written_side_by_side(spark, small_tables, tmp_path, monkeypatch):
    from hemotab.sources import colocated as CO

    asked = []
    at_once = CO.at_once
    monkeypatch.setattr(CO, "at_once", lambda s, steps: asked.append(len(steps)) or at_once(s, steps))
    database = f"buckets_{uuid.uuid4().hex[:8]}"
    write_colocated(small_tables, database, 2, str(tmp_path))
    assert asked == [len(small_tables)] and len(spark.sql(f"SHOW TABLES IN {database}").collect()) == len(small_tables)


def test_steps_at_once(spark):
    """Two steps wait for each other; an error comes out."""
    import threading

    from hemotab.session import at_once

    meet = threading.Barrier(2)
    assert sorted(at_once(spark, [lambda: meet.wait(20), lambda: meet.wait(20)])) == [0, 1]
    with pytest.raises(ZeroDivisionError):
        at_once(spark, [lambda: 1, lambda: 1 / 0])
    assert at_once(spark, []) == []
