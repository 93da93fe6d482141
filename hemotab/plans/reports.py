"""The twelve reports: a view, a date period and two crosstabs each.

A report of the reference runs its dataset query twice (once per
crosstab) and ships every detail row of the period to the report
process.  Here one plan serves both crosstabs: the view is filtered by
the period, reduced to the finest grain of the union of both crosstabs'
keys, and each crosstab is a rollup over that small aggregate.  Nothing
but the aggregate cells leaves the executors.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemotab.functions import labels as L
from hemotab.operators import crosstab as X
from hemotab.operators.crosstab import CrosstabSpec, Group
from hemotab.operators.period import closed_dates, timestamp_period
from hemotab.plans import views as V
from hemotab.profile import DEFAULT_PROFILE, Profile
from hemotab.sources.tables import Tables

DateLike = dt.date | str

GENDERS = ("male", "female", None)
AGE_GROUPS = tuple(b[0] for b in L.AGE_BANDS) + (L.AGE_OTHER,)


@dataclass(frozen=True)
class ReportSpec:
    name: str
    title: str
    view: str
    date_field: str
    # "date": closed interval on a date column (F10);
    # "timestamp": closed interval start .. end + 1 day.
    period: str
    fields: tuple[str, ...]
    crosstabs: tuple[CrosstabSpec, CrosstabSpec]

    @property
    def keys(self) -> list[str]:
        return list(dict.fromkeys(k for xt in self.crosstabs for k in xt.keys))

    @property
    def measure(self) -> str:
        measures = {xt.measure for xt in self.crosstabs}
        assert len(measures) == 1, self.name
        return measures.pop()


def _gender_age() -> tuple[Group, Group]:
    return (Group("gender", descending=True), Group("ageGroup"))


def _by_band(xid: str, name: str, rows: Sequence[Group], measure: str) -> CrosstabSpec:
    return CrosstabSpec(xid, name, tuple(rows), _gender_age(), measure,
                        col_values={"gender": GENDERS, "ageGroup": AGE_GROUPS})


def _donor_report(name, title, view, fields, label, measure, first_id, second_id, extra_rows=()):
    """Reports with rows label (and venue) and columns gender / age band."""
    first_rows = [Group(f, total_label=L.TOTAL if i else L.TOTAL_ALL_VENUES)
                  for i, f in enumerate([*extra_rows, label])]
    second_rows = [Group("venue", total_label=L.TOTAL_ALL_VENUES)] + [
        Group(f, total_label=L.TOTAL) for f in [*extra_rows, label]]
    return ReportSpec(
        name=name, title=title, view=view, date_field="donationDate", period="date", fields=fields,
        crosstabs=(_by_band(first_id, f"{name}_all", first_rows, measure),
                   _by_band(second_id, f"{name}_by_site", second_rows, measure)),
    )


def _site_report(name, title, view, date_field, fields, site, col, col_total, first_id, second_id,
                 col_values=None):
    """Reports with rows site / component type and one column group."""
    cols = (Group(col, total_label=col_total),)
    values = {col: tuple(col_values)} if col_values else {}
    return ReportSpec(
        name=name, title=title, view=view, date_field=date_field, period="timestamp", fields=fields,
        crosstabs=(
            CrosstabSpec(first_id, f"{name}_all",
                         (Group("componentTypeName", total_label=L.TOTAL_ALL_SITES),), cols, "componentTypeName",
                         col_values=values),
            CrosstabSpec(second_id, f"{name}_by_site",
                         (Group(site, total_label=L.TOTAL_ALL_SITES), Group("componentTypeName")),
                         cols, "componentTypeName", col_values=values),
        ),
    )


# Column labels of the site reports, in report order (ascending).
_FINAL_STATUSES = sorted([*L.COMPONENT_STATUS.values(), L.OTHER_STATES])
_ORDER_STATUSES = sorted([*L.ORDER_STATUS.values(), L.UNKNOWN])


_BG_FIELDS = V.TESTING_COLUMNS[:19] + ("ttiCoinfection",)

REPORTS: dict[str, ReportSpec] = {r.name: r for r in [
    _donor_report("bloodGrouping", "Blood Grouping Summary Report", "testingSummaryView", _BG_FIELDS,
                  "bloodGrouping", "bloodGrouping", "XT1", "XT2"),
    _site_report("component", "Component Summary Report", "inventorySummaryView", "createdOn",
                 V.INVENTORY_COLUMNS, "processedAtLocation", "finalComponentStatus", L.TOTAL_UNITS, "XT3", "XT4",
                 col_values=_FINAL_STATUSES),
    _site_report("componentsIssued", "Components Issued Summary Report", "issuedSummaryView", "orderDate",
                 V.ISSUED_COLUMNS, "dispatchedTo", "orderStatus", L.TOTAL, "XT5", "XT6",
                 col_values=_ORDER_STATUSES),
    ReportSpec(
        name="deferral", title="Deferral Summary Report", view="deferralSummaryView",
        date_field="deferralDate", period="timestamp", fields=V.DEFERRAL_COLUMNS,
        crosstabs=(
            _by_band("XT7", "deferral_all", (Group("reason", total_label=L.TOTAL_ALL_VENUES),), "reason"),
            _by_band("XT8", "deferral_by_site",
                     (Group("venue", total_label=L.TOTAL_ALL_VENUES), Group("reason")), "reason"),
        ),
    ),
    _site_report("discard", "Discard Summary Report", "discardSummaryView", "statusChangedOn",
                 V.DISCARD_COLUMNS, "processedAtLocation", "statusChangeReason", L.TOTAL, "XT9", "XT10"),
    _donor_report("donation", "Donation Summary Report", "donationSummaryView", V.DONATION_COLUMNS,
                  "donationType", "donationType", "XT11", "XT12"),
    _donor_report("donorCounselling", "Donor Counselling Summary Report", "donationSummaryView",
                  V.DONATION_COLUMNS, "donorCounsellingStatus", "donorCounsellingStatus", "XT13", "XT14",
                  extra_rows=("ttiReactiveStatus",)),
    _donor_report("hbvPrevalence", "HBV Prevalence Summary Report", "testingSummaryView", V.TESTING_COLUMNS,
                  "hbvPrevalence", "hbvPrevalence", "XT15", "XT16"),
    _donor_report("hcvPrevalence", "HCV Prevalence Summary Report", "testingSummaryView", V.TESTING_COLUMNS,
                  "hcvPrevalence", "hcvPrevalence", "XT17", "XT18"),
    _donor_report("hivPrevalence", "HIV Prevalence Summary Report", "testingSummaryView", V.TESTING_COLUMNS,
                  "hivPrevalence", "hivPrevalence", "XT19", "XT20"),
    _donor_report("syphilisPrevalence", "Syphilis Prevalence Summary Report", "testingSummaryView",
                  V.TESTING_COLUMNS, "syphilisPrevalence", "syphilisPrevalence", "XT21", "XT22"),
    _donor_report("ttiCoinfection", "TTI Co-Infection Summary Report", "testingSummaryView", _BG_FIELDS,
                  "ttiCoinfection", "bloodGrouping", "XT23", "XT24"),
]}

CROSSTABS: dict[str, tuple[ReportSpec, CrosstabSpec]] = {
    xt.name: (r, xt) for r in REPORTS.values() for xt in r.crosstabs
}


# Options of the views, by view; an option of another view has no effect.
VIEW_OPTIONS = {
    "testingSummaryView": ("strict_gate",),
    "inventorySummaryView": ("dedupe_returns",),
}


def _view_frame(tables: Tables, spec: ReportSpec, columns: Sequence[str], as_of, profile: Profile,
                period: tuple[str, str], **options) -> DataFrame:
    unknown = set(options) - {o for names in VIEW_OPTIONS.values() for o in names}
    if unknown:
        raise ValueError(f"unknown options: {sorted(unknown)}")
    fn = V.VIEWS[spec.view]
    mine = {o: options[o] for o in VIEW_OPTIONS.get(spec.view, ()) if o in options}
    if fn not in (V.discard_summary, V.issued_summary):
        mine["as_of"] = as_of
    return fn(tables, profile=profile, columns=columns, period=period, **mine)


def _last_day(spec: ReportSpec, end: DateLike, profile: Profile) -> dt.date:
    """Last day of the period, the closing day of a timestamp period aside."""
    plus_one = spec.period == "date" and profile.donation_period_plus_one_day
    return dt.date.fromisoformat(str(end)) + dt.timedelta(days=1 if plus_one else 0)


def dataset(tables: Tables, report: str | ReportSpec, start: DateLike, end: DateLike,
            as_of=None, profile: Profile = DEFAULT_PROFILE, columns: Sequence[str] | None = None,
            half_open: bool = False, since: dt.date | None = None, before: dt.date | None = None,
            around: tuple[dt.date, dt.date] | None = None, **options) -> DataFrame:
    """The report's dataset: its view, filtered by the period, declared fields only.

    Catalyst pushes the period to the scan.  For the donation views that is
    the scan of the chosen donations; the choice itself reads all of them.
    ``since`` (included) and ``before`` (not included) narrow the period down;
    ``around`` leaves out the days from its first to before its second.
    """
    spec = REPORTS[report] if isinstance(report, str) else report
    cols = list(columns) if columns is not None else list(spec.fields)
    if spec.date_field not in cols:
        cols.append(spec.date_field)
    # Inclusive date bounds covering the period: they prune stored months.
    first = dt.date.fromisoformat(str(start))
    last = _last_day(spec, end, profile) + dt.timedelta(days=1 if spec.period == "timestamp" else 0)
    bounds = (max(first, since or first), min(last, before - dt.timedelta(days=1) if before else last))
    df = _view_frame(tables, spec, cols, as_of, profile, period=(str(bounds[0]), str(bounds[1])), **options)
    if spec.period == "date":
        cond = closed_dates(spec.date_field, start, end, plus_one_day=profile.donation_period_plus_one_day)
    else:
        cond = timestamp_period(spec.date_field, start, end, half_open=half_open)
    kind = "date" if spec.period == "date" else "timestamp_ntz"
    if since:
        cond = cond & (F.col(spec.date_field) >= F.lit(since).cast(kind))
    if before:
        cond = cond & (F.col(spec.date_field) < F.lit(before).cast(kind))
    if around:
        cond = cond & ((F.col(spec.date_field) < F.lit(around[0]).cast(kind)) | (F.col(spec.date_field) >= F.lit(around[1]).cast(kind)))
    return df.where(cond)


def _has_base(tables: Tables, view: str) -> bool:
    """Whether the view's rows are stored by month."""
    return view in tables.view_bases or (tables.donation_base is not None and view in ("donationSummaryView", "testingSummaryView"))


def _key_counts(tables: Tables, spec: ReportSpec, keys: Sequence[str], measures: Sequence[str], start: DateLike,
                end: DateLike, as_of, profile: Profile, **options) -> DataFrame:
    """Counts ``n_<measure>`` per combination of ``keys`` within the period.

    Where ``tables`` carries monthly counts of the view (``plans.partials``),
    whole months are added up from them and only the days around them are read
    from the view.  Options that change rows or labels leave them aside.
    """
    columns = list(dict.fromkeys([*keys, *measures]))
    counted = [F.count(F.col(m)).alias(f"n_{m}") for m in measures]

    def rows(**more) -> DataFrame:
        ds = dataset(tables, spec, start, end, as_of, profile, columns=columns, **options, **more)
        return ds.groupBy(*keys).agg(*counted)

    stored = tables.monthly_counts.get(spec.view)
    if stored is None or any(options.get(o) for o in VIEW_OPTIONS.get(spec.view, ())):
        return rows()
    from hemotab.plans.partials import merged, whole_months

    if stored[1] != profile.name:
        raise ValueError(f"stored counts of {spec.view} are for {stored[1]}, not {profile.name}")
    first, last = dt.date.fromisoformat(str(start)), _last_day(spec, end, profile)
    months = whole_months(first, last)
    if months is None:
        return rows()
    parts = [merged(stored[0], months, keys, measures, as_of)]
    # A timestamp period also holds midnight after its last day.
    early, late = first < months[0], months[1] <= last or (spec.period == "timestamp" and not options.get("half_open"))
    if early and late and not _has_base(tables, spec.view):
        parts.append(rows(around=months))   # one pass over the view
    else:  # each reads its own months only
        parts += [rows(before=months[0])] if early else []
        parts += [rows(since=months[1])] if late else []
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy(*keys).agg(*[F.sum(f"n_{m}").alias(f"n_{m}") for m in measures])


def finest(tables: Tables, report: str | ReportSpec, start: DateLike, end: DateLike, as_of=None,
           profile: Profile = DEFAULT_PROFILE, **options) -> DataFrame:
    """Finest-grain counts shared by both crosstabs of the report."""
    spec = REPORTS[report] if isinstance(report, str) else report
    counts = _key_counts(tables, spec, spec.keys, [spec.measure], start, end, as_of, profile, **options)
    return counts.withColumnRenamed(f"n_{spec.measure}", X.COUNT)


def crosstab(tables: Tables, name: str, start: DateLike, end: DateLike, as_of=None,
             profile: Profile = DEFAULT_PROFILE, **options) -> DataFrame:
    """One crosstab (``<report>_all`` or ``<report>_by_site``), long form."""
    spec, xt = CROSSTABS[name]
    return X.crosstab(finest(tables, spec, start, end, as_of, profile, **options), xt)


def _stamp(spec: ReportSpec, start: DateLike, end: DateLike, now: dt.datetime | None) -> dict[str, Column]:
    """Title, period label and run stamp (P19, P20); ``now`` fixes the clock."""
    before, between = L.PERIOD_LABEL
    clock = F.current_timestamp() if now is None else F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    return {
        "title": F.lit(spec.title),
        "period": F.lit(f"{before}{start}{between}{end}"),
        "run_time": F.date_format(clock, "HH:mm"),
        "run_date": F.date_format(clock, "MMMM dd, yyyy"),
    }


def metadata(spark, report: str | ReportSpec, start: DateLike, end: DateLike,
             now: dt.datetime | None = None) -> DataFrame:
    """Title, period label and run stamp as a one-row frame."""
    spec = REPORTS[report] if isinstance(report, str) else report
    return spark.range(1).select(*[c.alias(n) for n, c in _stamp(spec, start, end, now).items()])


def with_metadata(rows: DataFrame, start: DateLike, end: DateLike, now: dt.datetime | None = None) -> DataFrame:
    """``run_reports`` rows with the title, period label and run stamp of their report."""
    out = rows
    for name in ("title", "period", "run_time", "run_date"):
        cases = F.lit(None).cast("string")
        for spec in reversed(REPORTS.values()):
            cases = F.when(F.col("report") == spec.name, _stamp(spec, start, end, now)[name]).otherwise(cases)
        out = out.withColumn(name, cases)
    return out


def run_report(tables: Tables, report: str, start: DateLike, end: DateLike, as_of=None,
               profile: Profile = DEFAULT_PROFILE, wide: bool = False, **options) -> dict[str, DataFrame]:
    """Both crosstabs plus metadata.  ``combined`` holds both crosstabs in
    one frame (tagged by ``crosstab``): one job, one scan of the inputs.
    ``wide=True`` adds ``<crosstab>_wide`` (columns across, X7).
    """
    spec = REPORTS[report]
    base = finest(tables, spec, start, end, as_of, profile, **options)
    out: dict[str, DataFrame] = {"metadata": metadata(tables.spark, spec, start, end)}
    parts = []
    for xt in spec.crosstabs:
        long = X.crosstab(base, xt)
        out[xt.name] = long
        if wide:
            out[f"{xt.name}_wide"] = X.crosstab_wide(long, xt)
        parts.append(long.withColumn("crosstab", F.lit(xt.name)))
    combined = parts[0].unionByName(parts[1], allowMissingColumns=True)
    out["combined"] = combined
    return out


def dataset_sql(spark, report: str, start: DateLike, end: DateLike, profile: Profile = DEFAULT_PROFILE,
                half_open: bool = False) -> DataFrame:
    """The dataset in SQL form (P18): parameters are bound, not spliced.

    Needs the views registered as temp views (``views.register_views``) for
    the same release.
    """
    spec = REPORTS[report]
    if spec.period == "date":
        last = "date_add(:end, 1)" if profile.donation_period_plus_one_day else ":end"
        cond = f"{spec.date_field} BETWEEN :start AND {last}"
    else:
        upper = "<" if half_open else "<="
        cond = (f"{spec.date_field} >= CAST(:start AS TIMESTAMP_NTZ) "
                f"AND {spec.date_field} {upper} CAST(date_add(:end, 1) AS TIMESTAMP_NTZ)")
    fields = ", ".join(spec.fields)
    return spark.sql(f"SELECT {fields} FROM {spec.view} WHERE {cond}",
                     args={"start": dt.date.fromisoformat(str(start)), "end": dt.date.fromisoformat(str(end))})


def run_reports(tables: Tables, names: Sequence[str] | None, start: DateLike, end: DateLike, as_of=None,
                profile: Profile = DEFAULT_PROFILE, **options) -> DataFrame:
    """Several reports for one period as one long frame, in one job.

    Reports on the same view share one dataset and one finest-grain
    aggregate over the union of their keys, with one count per measure
    (``n_<measure>``); each crosstab then sums its own count.  The six
    testing-view reports thus scan and collapse the donations once, not
    six times.  Columns: ``report``, ``crosstab``, every key with its
    ``g_<key>`` flag (null where the crosstab does not have that key), ``n``.
    """
    specs = [REPORTS[n] for n in (names or REPORTS)]
    by_view: dict[str, list[ReportSpec]] = {}
    for spec in specs:
        by_view.setdefault(spec.view, []).append(spec)
    parts: list[DataFrame] = []
    for view, group in by_view.items():
        keys = list(dict.fromkeys(k for spec in group for k in spec.keys))
        measures = list(dict.fromkeys(spec.measure for spec in group))
        shared = _key_counts(tables, group[0], keys, measures, start, end, as_of, profile, **options)
        for spec in group:
            for xt in spec.crosstabs:
                sub = shared.select(*xt.keys, F.col(f"n_{xt.measure}").alias(X.COUNT))
                parts.append(X.crosstab(sub, xt)
                             .withColumn("report", F.lit(spec.name))
                             .withColumn("crosstab", F.lit(xt.name)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
