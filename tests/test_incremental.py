"""The base kept up to date equals a rebuild; what an update reads and writes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hemotab.plans import incremental as I
from hemotab.plans import materialize as M
from hemotab.plans import partials as PA
from hemotab.plans import reports as RP
from hemotab.profile import fixture_profile
from hemotab.sources.fixtures import earlier_state
from hemotab.sources.versions import Manifest, MonthlyStore

P = fixture_profile()


def _rows(df, columns=None):
    return sorted(map(str, (df.select(*columns) if columns else df).collect()))


def _same_as_rebuilt(base, after):
    want = M.donation_base(after, P)
    assert _rows(base.rows(), want.columns) == _rows(want)


def _base(tables, tmp_path):
    base = I.DonationBase(tables, P, str(tmp_path / "base"))
    base.build(tables)
    return base


def test_a_batch_of_changes_equals_a_rebuild(spark, small_tables, tmp_path):
    before = earlier_state(small_tables)
    base = _base(before, tmp_path)
    changes = I.changed_keys(before, small_tables)
    done = base.update(small_tables, changes)
    _same_as_rebuilt(base, small_tables)
    # Again: nothing differs, rows stay the same.
    base.update(small_tables, changes)
    _same_as_rebuilt(base, small_tables)
    assert 0 < done.numbers < base.rows().count()
    # And back.
    base.update(before, I.changed_keys(small_tables, before))
    _same_as_rebuilt(base, before)


def test_a_small_change_rewrites_its_months_only(spark, check_tables, tmp_path):
    """One donation moves from one month to another: two months are written."""
    base = _base(check_tables, tmp_path)
    files = set(base.rows().inputFiles())
    one = base.rows().where("donationDate is not null").orderBy("id").first()
    moved = check_tables["Donation"].withColumn("donationDate", F.when(F.col("id") == one["id"], F.lit("1990-05-05").cast("date"))
                                                .otherwise(F.col("donationDate")))
    after = check_tables.replaced(Donation=moved)
    done = base.update(after, {"Donation": spark.createDataFrame([(one["id"],)], "id long")})
    _same_as_rebuilt(base, after)
    assert done.numbers >= 1 and done.months_written == 2
    assert done.bytes_written < done.bytes_total / 10
    now = set(base.rows().inputFiles())
    assert len(files - now) <= 2 and len(now & files) >= len(files) - 2


@pytest.mark.parametrize("table,column,value", [
    ("PackType", "countAsDonation", False), ("Location", "name", None)])
def test_code_lists(spark, small_tables, tmp_path, table, column, value):
    base = _base(small_tables, tmp_path)
    changed = small_tables[table].withColumn(column, F.when(F.col("id") == 2, F.lit(value)).otherwise(F.col(column)))
    after = small_tables.replaced(**{table: changed})
    base.update(after, {table: spark.createDataFrame([(2,)], "id long")})
    _same_as_rebuilt(base, after)


def test_null_numbers_are_one_group(spark, small_tables, tmp_path):
    """The number of the chosen donation of the null group changes, and that of others becomes null."""
    null = F.col("id") % 19 == 3
    before = small_tables.replaced(Donation=small_tables["Donation"].withColumn(
        "donationIdentificationNumber", F.when(null, None).otherwise(F.col("donationIdentificationNumber"))))
    base = _base(before, tmp_path)
    first = base.rows().where("donationIdentificationNumber is null").first()["id"]
    after = small_tables.replaced(Donation=small_tables["Donation"].withColumn(
        "donationIdentificationNumber", F.when(null & (F.col("id") != first), None).otherwise(F.col("donationIdentificationNumber"))))
    base.update(after, I.changed_keys(before, after))
    _same_as_rebuilt(base, after)


def test_removed_and_emptied(spark, small_tables, tmp_path):
    base = _base(small_tables, tmp_path)
    empty = small_tables.replaced(Donation=small_tables["Donation"].limit(0))
    base.update(empty, I.changed_keys(small_tables, empty))
    assert base.rows().count() == 0
    base.update(small_tables, I.changed_keys(empty, small_tables))
    _same_as_rebuilt(base, small_tables)
    assert base.update(small_tables, {}).rows_written == 0
    with pytest.raises(ValueError):
        base.update(small_tables, {"OrderForm": small_tables["OrderForm"]})


def test_repeated_and_null_keys(spark, small_tables):
    """Rows are compared as a multiset per key."""
    results = small_tables["BloodTestResult"]
    twice = small_tables.replaced(BloodTestResult=results.unionAll(results.where("donation_id = 7")))
    keys = I.changed_keys(small_tables, twice)
    assert [r[0] for r in keys["BloodTestResult"].collect()] == ([7] if results.where("donation_id = 7").count() else [])
    assert keys["Donor"].count() == 0


def test_a_failed_update_leaves_the_old_version(spark, small_tables, tmp_path, monkeypatch):
    before = earlier_state(small_tables)
    base = _base(before, tmp_path)

    def fail(self, parts):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(Manifest, "publish", fail)
        with pytest.raises(RuntimeError):
            base.update(small_tables, I.changed_keys(before, small_tables))
    _same_as_rebuilt(base, before)
    base.update(small_tables, I.changed_keys(before, small_tables))
    _same_as_rebuilt(base, small_tables)


def test_monthly_store(spark, tmp_path):
    store = MonthlyStore(spark, str(tmp_path / "s"), "month")
    rows = spark.sql("SELECT * FROM VALUES (1, DATE'2000-01-01'), (2, DATE'2000-02-01'), (3, CAST(NULL AS DATE)) AS t(n, month)")
    assert store.read(rows.schema).count() == 0
    store.replace(rows)
    assert _rows(store.read(rows.schema)) == _rows(rows)
    store.replace(rows.where("n = 3").withColumn("n", F.lit(9)), [None])
    store.replace(rows.limit(0), [rows.collect()[0]["month"]])
    assert sorted((r["n"], str(r["month"])) for r in store.read(rows.schema).collect()) == [(2, "2000-02-01"), (9, "None")]
    with pytest.raises(ValueError):
        store.replace(rows, [None])
    assert store.read(rows.schema).count() == 2 and store.manifest.version() == 3


# --- monthly counts -----------------------------------------------------------------------
def _cells(df):
    return sorted(str(sorted(r.asDict().items(), key=str)) for r in df.collect())


@pytest.fixture(scope="module")
def counted(spark, tmp_path_factory):
    from hemotab.sources.fixtures import fixture_tables

    tables = fixture_tables(spark, "/root/testdata/sf0.001")
    counts = PA.MonthlyCounts(tables, P, str(tmp_path_factory.mktemp("counts")))
    counts.build(tables)
    return counts.use(tables)


@pytest.mark.parametrize("start,end,half_open", [("1996-01-15", "2000-12-10", False), ("1997-03-01", "1997-04-30", True),
                                                 ("1996-02-29", "1996-03-31", False)])
def test_months_add_up(small_tables, counted, start, end, half_open):
    for report in ("discard", "donation"):
        a = RP.run_report(counted, report, start, end, as_of="2003-02-28", profile=P, half_open=half_open)["combined"]
        b = RP.run_report(small_tables, report, start, end, as_of="2003-02-28", profile=P, half_open=half_open)["combined"]
        assert _cells(a) == _cells(b), report


def test_days_around_months_are_one_pass(small_tables, counted, monkeypatch):
    """A view without a stored base is computed once for the days before and after the whole months."""
    calls = []
    dataset = RP.dataset
    monkeypatch.setattr(RP, "dataset", lambda *a, **k: calls.append(k) or dataset(*a, **k))
    a = RP.run_report(counted, "discard", "1996-01-15", "2000-12-10", as_of="2003-02-28", profile=P)["combined"]
    assert len(calls) == 1
    assert _cells(a) == _cells(RP.run_report(small_tables, "discard", "1996-01-15", "2000-12-10", as_of="2003-02-28", profile=P)["combined"])


def test_stored_base_is_read_by_its_own_months(spark, counted):
    """Where the view's rows are stored by month, the days around are read from their months alone."""
    from hemotab.plans import materialize as M
    from hemotab.sources.fixtures import fixture_tables

    tables = fixture_tables(spark, "/root/testdata/sf0.001")
    M.use_donation_base(tables, M.write_donation_base(tables, P), P)
    tables.monthly_counts = counted.monthly_counts
    a, b = (RP.crosstab(t, "donation_by_site", "1996-01-15", "1999-12-10", as_of="2001-01-01", profile=P) for t in (tables, counted))
    assert _cells(a) == _cells(b)
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert plan.count("(donationMonth#") >= 4     # bounds of two months, apart


def test_held_table_is_not_derived_again(spark, small_tables):
    from hemotab.sources.fixtures import fixture_tables

    tables = fixture_tables(spark, "/root/testdata/sf0.001").hold("Component")
    for name in ("Component", "OrderForm_Component", "ReturnForm_Component"):
        assert not any("lineitem" in f for f in tables[name].inputFiles()), name
        assert tables[name].dtypes == small_tables[name].dtypes
        assert sorted(map(str, tables[name].collect())) == sorted(map(str, small_tables[name].collect()))


@pytest.mark.parametrize("as_of", ["2000-02-29", "2001-03-01"])
def test_ages_of_any_reporting_date(small_tables, counted, as_of):
    a, b = (RP.crosstab(t, "donation_by_site", "1996-01-01", "1999-12-31", as_of=as_of, profile=P) for t in (counted, small_tables))
    assert _cells(a) == _cells(b)


def test_whole_months_read_no_rows(counted):
    """A report of whole months is a scan of the counts."""
    plan = RP.crosstab(counted, "donation_all", "1997-01-01", "1998-12-31", as_of="2001-01-01", profile=P)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "month" in plan.split("PartitionFilters")[1].split("]")[0]


def test_options_that_change_labels_leave_the_counts_aside(small_tables, counted):
    a, b = (RP.crosstab(t, "ttiCoinfection_all", "1996-01-01", "1999-12-31", as_of="2001-01-01", profile=P, strict_gate=True)
            for t in (counted, small_tables))
    assert _cells(a) == _cells(b)
