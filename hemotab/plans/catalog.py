"""Registered queries: every view, crosstab and operator as a named
``(spark, sf_dir) -> DataFrame`` over the tables derived from the test data.

Parameters are fixed (``as_of`` dates and periods) so that results are
reproducible; periods span most of each table's dates, and every query
reads whole tables.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemotab.functions import recodes as R
from hemotab.operators import crosstab as X
from hemotab.operators.dedupe import latest_counselling
from hemotab.operators.period import closed_dates, timestamp_period
from hemotab.operators.results import positive_flags
from hemotab.plans import incremental as I
from hemotab.plans import materialize as M
from hemotab.plans import partials as PA
from hemotab.plans import reports as RP
from hemotab.plans import sqlviews as SV
from hemotab.plans import views as V
from hemotab.profile import PROFILES, fixture_profile
from hemotab.session import at_once, checkpoint_dir
from hemotab.sources import sinks
from hemotab.sources.colocated import colocated, write_colocated
from hemotab.sources.fixtures import earlier_state, fixture_tables, odd_labels

AS_OF = "2001-12-31"          # ages
EXPIRY_AS_OF = "1998-06-01"   # component expiry

# Report periods for the checks, by report (start, end).
DONATION_PERIOD = ("1996-01-01", "2000-12-31")
PERIODS = {name: DONATION_PERIOD for name in RP.REPORTS}
PERIODS["deferral"] = ("2024-01-02", "2024-01-29")
MONTH = ("1997-03-01", "1997-03-31")   # the period of a monthly report
# Periods that begin and end within a month, and a reporting date of their own.
YEARS = {name: ("1996-01-15", "2000-12-10") for name in RP.REPORTS} | {"deferral": ("2023-12-15", "2024-02-10")}
YEARS_AS_OF = "2004-02-29"

VIEW_QUERIES = {
    "view_donation_summary": "donationSummaryView",
    "view_batch_location": "componentBatchLocationView",
    "view_inventory_summary": "inventorySummaryView",
    "view_deferral_summary": "deferralSummaryView",
    "view_discard_summary": "discardSummaryView",
    "view_issued_summary": "issuedSummaryView",
    "view_testing_summary": "testingSummaryView",
}


@dataclass(frozen=True)
class CrosstabCheck:
    crosstab: str
    # A release's codes and test ids, on tables that hold them; None: the
    # current release on the fixtures' own test numbers.
    release: str | None = None

    @property
    def profile(self):
        return PROFILES[self.release] if self.release else fixture_profile()


CROSSTAB_QUERIES = {f"xt_{name}": CrosstabCheck(name) for name in RP.CROSSTABS}
CROSSTAB_QUERIES["profile_100_donation"] = CrosstabCheck("donorCounselling_by_site", "1.0.0")
CROSSTAB_QUERIES["profile_130_donation"] = CrosstabCheck("donorCounselling_by_site", "1.3.0")
CROSSTAB_QUERIES["profile_100_hiv"] = CrosstabCheck("hivPrevalence_by_site", "1.0.0")
CROSSTAB_QUERIES["profile_130_hiv"] = CrosstabCheck("hivPrevalence_by_site", "1.3.0")
CROSSTAB_QUERIES["profile_100_issued"] = CrosstabCheck("componentsIssued_by_site", "1.0.0")
CROSSTAB_QUERIES["profile_140_binary_ids"] = CrosstabCheck("ttiCoinfection_by_site", "1.4.0")


def view_as_of(view: str) -> str:
    return EXPIRY_AS_OF if view == "inventorySummaryView" else AS_OF


def view_frame(tables, view: str) -> DataFrame:
    fn = V.VIEWS[view]
    profile = fixture_profile()
    if fn is V.batch_location:
        return fn(tables)
    if fn in (V.discard_summary, V.issued_summary):
        return fn(tables, profile=profile)
    return fn(tables, as_of=view_as_of(view), profile=profile)


def crosstab_frame(tables, check: CrosstabCheck) -> DataFrame:
    spec, _ = RP.CROSSTABS[check.crosstab]
    start, end = PERIODS[spec.name]
    return RP.crosstab(tables, check.crosstab, start, end, as_of=view_as_of(spec.view),
                       profile=check.profile)


# --- single-operator queries ---------------------------------------------------------
def expr_age(tables) -> DataFrame:
    d = tables["Donor"]
    return d.select("id", "birthDate", R.age_years("birthDate", AS_OF).alias("age"))


def expr_age_before_birth(tables) -> DataFrame:
    """Ages on a date that many birth dates lie after."""
    d = tables["Donor"]
    return d.select("id", R.age_years("birthDate", "1960-02-29").alias("age"))


def expr_age_band(tables) -> DataFrame:
    d = tables["Donor"].select(R.age_band(R.age_years("birthDate", AS_OF)).alias("ageGroup"))
    return d.groupBy("ageGroup").agg(F.count(F.lit(1)).alias("n"))


def expr_blood_type(tables) -> DataFrame:
    d = tables["Donation"]
    return d.select("id", R.blood_type().alias("bloodType"),
                    R.blood_grouping(R.blood_type()).alias("bloodGrouping"))


def expr_expiry(tables) -> DataFrame:
    c = tables["Component"]
    return c.select("id", "expiresOn", R.expiry_status("expiresOn", EXPIRY_AS_OF).alias("expiryStatus"))


def expr_coinfection(tables) -> DataFrame:
    """Co-infection label of every donation row (no WHERE, no collapse)."""
    p = fixture_profile()
    flags = positive_flags(tables["BloodTestResult"], p).withColumnRenamed("donation_id", "id")
    d = tables["Donation"].select("id", "ttiStatus", "released").join(flags, "id", "left")
    return d.select("id", R.coinfection(p).alias("ttiCoinfection"),
                    R.coinfection(p, strict_gate=True).alias("ttiCoinfectionStrict"))


def q_test_flags(tables) -> DataFrame:
    return positive_flags(tables["BloodTestResult"], fixture_profile())


def dedupe_donation(tables) -> DataFrame:
    return V.donation_numbers(tables, fixture_profile())


def dedupe_counselling(tables) -> DataFrame:
    return latest_counselling(tables["PostDonationCounselling"])


def period_closed(tables) -> DataFrame:
    start, end = DONATION_PERIOD
    v = V.donation_summary(tables, as_of=AS_OF, profile=fixture_profile(), columns=["donationDate"])
    return v.where(closed_dates("donationDate", start, end)).groupBy("donationDate").agg(F.count(F.lit(1)).alias("n"))


def period_plus_one_day(tables) -> DataFrame:
    start, end = PERIODS["discard"]
    v = V.discard_summary(tables, profile=fixture_profile(), columns=["statusChangedOn"])
    return (v.where(timestamp_period("statusChangedOn", start, end))
            .groupBy("statusChangedOn").agg(F.count(F.lit(1)).alias("n")))


def xt_labels_discard(tables) -> DataFrame:
    """The discard-by-site crosstab with its total labels."""
    spec, xt = RP.CROSSTABS["discard_by_site"]
    return X.labelled(crosstab_frame(tables, CrosstabCheck("discard_by_site")), xt)


BATCH_REPORTS = tuple(n for n, r in RP.REPORTS.items()
                      if r.view in ("donationSummaryView", "testingSummaryView"))


def report_batch_donation_views(tables) -> DataFrame:
    """``run_reports``: the eight donation-view reports for one period, one job."""
    start, end = DONATION_PERIOD
    return RP.run_reports(tables, BATCH_REPORTS, start, end, as_of=AS_OF, profile=fixture_profile())


def _wide(tables, name: str) -> DataFrame:
    return X.crosstab_wide(crosstab_frame(tables, CrosstabCheck(name)), RP.CROSSTABS[name][1])


def xt_wide_donation(tables) -> DataFrame:
    return _wide(tables, "donation_by_site")


def xt_wide_discard(tables) -> DataFrame:
    """X7 with column labels from the data (discard reasons)."""
    return _wide(tables, "discard_by_site")


def xt_wide_donation_odd_labels(tables) -> DataFrame:
    """X7 with a gender that no list names."""
    return _wide(odd_labels(tables), "donation_by_site")


def xt_wide_discard_odd_labels(tables) -> DataFrame:
    """X7 with a reason named like the total and an empty reason."""
    return _wide(odd_labels(tables), "discard_by_site")


# --- the routes users take -----------------------------------------------------------
def _month(tables) -> DataFrame:
    """All 12 reports for one month (deferrals: their own)."""
    p = fixture_profile()
    rest = [n for n in RP.REPORTS if n != "deferral"]
    batch = RP.run_reports(tables, rest, *MONTH, as_of=AS_OF, profile=p)
    own = RP.run_reports(tables, ["deferral"], *PERIODS["deferral"], as_of=AS_OF, profile=p)
    return batch.unionByName(own, allowMissingColumns=True)


def report_batch_month(tables) -> DataFrame:
    """Monthly reports from the source tables."""
    return _month(tables)


def report_batch_month_stored(tables) -> DataFrame:
    """Monthly reports from stored bases, written to the shared folder first."""
    p = fixture_profile()
    return _month(M.use_all_bases(tables, M.write_all_bases(tables, p), p))


def report_batch_month_colocated(tables) -> DataFrame:
    """Monthly reports from bucketed source tables, saved first."""
    spark, database = tables.spark, f"hemotab_{uuid.uuid4().hex}"
    write_colocated(tables, database, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return _month(colocated(spark, database, T.LongType()))


def _updated_base(tables) -> I.DonationBase:
    """A base built on an earlier state of the tables and brought up to date by what changed since."""
    before, base = earlier_state(tables), I.DonationBase(tables, fixture_profile())
    base.build(before)
    base.update(tables, I.changed_keys(before, tables))
    return base


def base_updated_donation(tables) -> DataFrame:
    """V1 from a base kept up to date (inserts, deletions, moved dates, re-pointed numbers, donors, results)."""
    return view_frame(_updated_base(tables).use(tables), "donationSummaryView")


def base_updated_testing(tables) -> DataFrame:
    """V7 from a base kept up to date."""
    return view_frame(_updated_base(tables).use(tables), "testingSummaryView")


def _years(tables) -> DataFrame:
    """All 12 reports over years."""
    p = fixture_profile()
    parts = [RP.run_reports(tables, [n for n in RP.REPORTS if YEARS[n] == period], *period, as_of=YEARS_AS_OF, profile=p)
             for period in dict.fromkeys(YEARS.values())]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


def report_years_from_months(tables) -> DataFrame:
    """Reports over years, added up from stored monthly counts; days around whole months from the views."""
    p = fixture_profile()
    # Three views read components, for their counts and for the days around the months of two periods.
    _, base = at_once(tables.spark, [lambda: tables.hold("Component"), lambda: M.write_donation_base(tables, p)])
    M.use_donation_base(tables, base, p)
    counts = PA.MonthlyCounts(tables, p)
    counts.build(tables)
    return _years(counts.use(tables))


def report_years_after_update(tables) -> DataFrame:
    """The donation views' reports over years, from a base and counts built earlier and both updated by what changed since."""
    p, before, views = fixture_profile(), earlier_state(tables), ("donationSummaryView", "testingSummaryView")
    base = I.DonationBase(before, p)
    base.build(before)
    counts = PA.MonthlyCounts(base.use(before), p, views=views)
    counts.build(before)
    done = base.update(tables, I.changed_keys(before, tables))
    for view in views:
        counts.update(base.use(tables), view, done.months_changed)
    return RP.run_reports(counts.use(tables), BATCH_REPORTS, *YEARS["donation"], as_of=YEARS_AS_OF, profile=p)


def sink_round_trip(tables) -> DataFrame:
    """K1: the monthly reports written report by report, and read back."""
    root = f"{checkpoint_dir(tables.spark).rstrip('/')}/reports/{uuid.uuid4().hex}"
    for name in RP.REPORTS:
        start, end = PERIODS["deferral"] if name == "deferral" else MONTH
        out = RP.run_report(tables, name, start, end, as_of=AS_OF, profile=fixture_profile())
        sinks.write_report(out, root, name, start, end)
    held = tables.spark.read.option("mergeSchema", "true").parquet(f"{root}/crosstabs")
    keys = list(dict.fromkeys(k for r in RP.REPORTS.values() for k in r.keys))
    return held.select("report", "crosstab", *keys, *[f"g_{k}" for k in keys], X.COUNT)


def sink_published(tables) -> DataFrame:
    """K1: the monthly reports published together, one of them published again, and read back."""
    store = sinks.ReportStore(tables.spark, f"{checkpoint_dir(tables.spark).rstrip('/')}/published/{uuid.uuid4().hex}")

    def run(name: str, period: tuple[str, str]) -> tuple:
        return name, *period, RP.run_report(tables, name, *period, as_of=AS_OF, profile=fixture_profile())

    wrong = PERIODS["discard"]
    store.publish([run(n, PERIODS["deferral"] if n == "deferral" else MONTH) for n in RP.REPORTS if n != "discard"]
                  + [("discard", *MONTH, run("discard", wrong)[3])])
    store.publish([run("discard", MONTH)])
    keys = list(dict.fromkeys(k for r in RP.REPORTS.values() for k in r.keys))
    return store.crosstabs().select("report", "crosstab", *keys, *[f"g_{k}" for k in keys], X.COUNT)


def order_donation_by_site(tables) -> DataFrame:
    """The place of each cell in report order (aggregate cells only, numbered in one task)."""
    xt = RP.CROSSTABS["donation_by_site"][1]
    long = crosstab_frame(tables, CrosstabCheck(xt.name))
    # One row per printed cell.
    return long.withColumn("place", F.row_number().over(Window.orderBy(*X.sort_columns(xt))))


def order_views(tables) -> DataFrame:
    """Each ordered view written by ``export_view``; the place of each
    sort key in the files as they are read back."""
    root = f"{checkpoint_dir(tables.spark).rstrip('/')}/exports/{uuid.uuid4().hex}"
    parts = []
    for view, keys in sinks.VIEW_ORDER.items():
        sinks.export_view(view_frame(tables, view), f"{root}/{view}", keys)
        key = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
        placed = sinks.places(tables.spark, f"{root}/{view}", keys)
        parts.append(placed.groupBy(*keys, "place").agg(F.count(F.lit(1)).alias("n"))
                     .select(F.lit(view).alias("view"), key.alias("sort_key"), F.col("place").cast("int").alias("place"), "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def _sql_form(tables, release: str) -> DataFrame:
    """The donation dataset of a month by SQL over registered views."""
    V.register_views(tables, as_of=AS_OF, profile=PROFILES[release])
    return RP.dataset_sql(tables.spark, "donation", *MONTH, profile=PROFILES[release])


def sql_form_100(tables) -> DataFrame:
    return _sql_form(tables, "1.0.0")


def sql_form_140(tables) -> DataFrame:
    return _sql_form(tables, "1.4.0")


def sql_views(tables) -> DataFrame:
    """Rows of every registered view, counted in SQL."""
    V.register_views(tables, as_of=AS_OF, profile=fixture_profile())
    return tables.spark.sql(" UNION ALL ".join(f"SELECT '{v}' AS view, count(*) AS n FROM {v}" for v in V.VIEWS))


def sql_views_stored(tables) -> DataFrame:
    """Rows of the views defined as SQL text in a database, counted in another session."""
    spark, database = tables.spark, f"hemotab_{uuid.uuid4().hex}"
    write_colocated(tables, database, int(spark.conf.get("spark.sql.shuffle.partitions")))
    SV.create_views(spark, database, fixture_profile(), AS_OF)
    return spark.newSession().sql(" UNION ALL ".join(f"SELECT '{v}' AS view, count(*) AS n FROM {database}.{v}" for v in V.VIEWS))


def report_metadata(tables) -> DataFrame:
    """Two monthly reports, each cell with its report's title, period and stamp (fixed clock)."""
    rows = RP.run_reports(tables, ["donation", "discard"], *MONTH, as_of=AS_OF, profile=fixture_profile())
    return RP.with_metadata(rows, *MONTH, now=dt.datetime(1998, 3, 9, 17, 5, 41))


OPERATOR_QUERIES: dict[str, Callable] = {
    "expr_age": expr_age,
    "expr_age_before_birth": expr_age_before_birth,
    "expr_age_band": expr_age_band,
    "expr_blood_type": expr_blood_type,
    "expr_expiry": expr_expiry,
    "expr_coinfection": expr_coinfection,
    "test_flags": q_test_flags,
    "dedupe_donation": dedupe_donation,
    "dedupe_counselling": dedupe_counselling,
    "period_closed": period_closed,
    "period_plus_one_day": period_plus_one_day,
    "xt_wide_donation": xt_wide_donation,
    "xt_wide_discard": xt_wide_discard,
    "xt_wide_donation_odd_labels": xt_wide_donation_odd_labels,
    "xt_wide_discard_odd_labels": xt_wide_discard_odd_labels,
    "xt_labels_discard": xt_labels_discard,
    "report_batch_donation_views": report_batch_donation_views,
    "report_batch_month": report_batch_month,
    "report_batch_month_stored": report_batch_month_stored,
    "report_batch_month_colocated": report_batch_month_colocated,
    "base_updated_donation": base_updated_donation,
    "base_updated_testing": base_updated_testing,
    "report_years_from_months": report_years_from_months,
    "report_years_after_update": report_years_after_update,
    "sink_round_trip": sink_round_trip,
    "sink_published": sink_published,
    "order_donation_by_site": order_donation_by_site,
    "order_views": order_views,
    "sql_views": sql_views,
    "sql_views_stored": sql_views_stored,
    "report_metadata": report_metadata,
}

# Queries on tables that hold a release's own codes and ids.
RELEASE_QUERIES: dict[str, tuple[Callable, str]] = {
    "sql_form_100": (sql_form_100, "1.0.0"),
    "sql_form_140": (sql_form_140, "1.4.0"),
}


def as_text(df: DataFrame) -> DataFrame:
    """Decimals and timestamps as text: both engines print them alike, but
    hand them over as different types.  All other columns keep their types."""
    def shown(f):
        printed = isinstance(f.dataType, (T.DecimalType, T.TimestampType, T.TimestampNTZType))
        return F.col(f.name).cast("string").alias(f.name) if printed else F.col(f.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def _runner(build: Callable, text: bool, release: str | None = None) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = build(fixture_tables(spark, sf_dir, PROFILES[release] if release else None))
        return as_text(df) if text else df
    return run


def queries(text: bool = True) -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """All registered queries; ``text=False`` keeps declared types throughout."""
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for name, view in VIEW_QUERIES.items():
        out[name] = _runner(lambda t, v=view: view_frame(t, v), text)
    for name, check in CROSSTAB_QUERIES.items():
        out[name] = _runner(lambda t, c=check: crosstab_frame(t, c), text, check.release)
    for name, fn in OPERATOR_QUERIES.items():
        out[name] = _runner(fn, text)
    for name, (fn, release) in RELEASE_QUERIES.items():
        out[name] = _runner(fn, text, release)
    return out
