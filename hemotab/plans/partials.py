"""Stored monthly counts behind the reports, mergeable over months.

Every cell of every report is a count, and counts add up.  So each view's rows
are counted once per month of their date, by all keys its reports use, and a
report over years adds months instead of rows.  The age band depends on the
reporting date; its place among the keys is taken by the birth date, from which
the band of any reporting date follows exactly.

A period need not begin and end with a month: the whole months inside it come
from the counts, and the days before and after them from the view itself (its
stored base, if there is one, pruned to those months).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemotab.functions import recodes as R
from hemotab.plans import reports as RP
from hemotab.plans import views as V
from hemotab.profile import DEFAULT_PROFILE, Profile
from hemotab.session import at_once, checkpoint_dir
from hemotab.sources.tables import Tables
from hemotab.sources.versions import MonthlyStore, new_run

MONTH = V.BASE_MONTH
# Key that depends on the reporting date -> what is kept of it.
KEPT = {"ageGroup": "birthDate"}


def _specs(view: str) -> list[RP.ReportSpec]:
    return [r for r in RP.REPORTS.values() if r.view == view]


REPORT_VIEWS = tuple(dict.fromkeys(r.view for r in RP.REPORTS.values()))


def monthly_counts(tables: Tables, view: str, profile: Profile = DEFAULT_PROFILE) -> DataFrame:
    """One row per month and combination of keys with ``n_<measure>`` for every
    measure of the view's reports.  Partial on the map side: what is shuffled
    are counts."""
    specs = _specs(view)
    keys = list(dict.fromkeys(KEPT.get(k, k) for s in specs for k in s.keys))
    measures = list(dict.fromkeys(s.measure for s in specs))
    date = specs[0].date_field
    rows = V.VIEWS[view](tables, profile=profile, columns=list(dict.fromkeys([*keys, *measures, date])))
    month = F.trunc(F.col(date).cast("date"), "month").alias(MONTH)
    return rows.groupBy(*keys, month).agg(*[F.count(F.col(m)).alias(f"n_{m}") for m in measures])


def whole_months(start: dt.date, last: dt.date) -> tuple[dt.date, dt.date] | None:
    """(first day of the first, first day after the last) month that lies
    whole within ``start`` .. ``last``, both days included."""
    first = start if start.day == 1 else _next_month(start)
    after = last + dt.timedelta(days=1)
    after = after.replace(day=1)
    return (first, after) if first < after else None


def _next_month(day: dt.date) -> dt.date:
    return (day.replace(day=1) + dt.timedelta(days=32)).replace(day=1)


def merged(counts: DataFrame, months: tuple[dt.date, dt.date], keys: Sequence[str], measures: Sequence[str], as_of) -> DataFrame:
    """Counts of whole months, with the keys as of the reporting date."""
    rows = counts.where((F.col(MONTH) >= F.lit(months[0])) & (F.col(MONTH) < F.lit(months[1])))
    shown = [R.age_band(R.age_years("birthDate", as_of)).alias(k) if k == "ageGroup" else F.col(k) for k in keys]
    return rows.select(*shown, *[F.col(f"n_{m}") for m in measures])


class MonthlyCounts:
    """The stored counts of the reports' views (``root``: a shared folder)."""

    def __init__(self, tables: Tables, profile: Profile = DEFAULT_PROFILE, root: str | None = None,
                 views: Iterable[str] = REPORT_VIEWS):
        self.spark, self.profile = tables.spark, profile
        self.root = (root or f"{checkpoint_dir(self.spark).rstrip('/')}/monthly_counts/{profile.name}/{new_run()}").rstrip("/")
        self.stores = {v: MonthlyStore(self.spark, f"{self.root}/{v}", MONTH) for v in views}
        self.schemas = {v: monthly_counts(tables, v, profile).schema for v in self.stores}

    def build(self, tables: Tables) -> None:
        """Counts of whole views: one pass over each (over its stored base, if there is one), side by side."""
        at_once(self.spark, [partial(store.replace, monthly_counts(tables, view, self.profile))
                             for view, store in self.stores.items()])

    def update(self, tables: Tables, view: str, months: Iterable) -> None:
        """Counts the given months again, after their rows have changed, and
        leaves the others as they are."""
        months = list(months)
        if months:
            rows = monthly_counts(_only_months(tables, view, months), view, self.profile)
            mine = F.col(MONTH).isin([m for m in months if m is not None])
            self.stores[view].replace(rows.where((mine | F.col(MONTH).isNull()) if None in months else mine), months)

    def use(self, tables: Tables) -> Tables:
        """Makes the reports of ``tables`` add up the newest counts."""
        for view, store in self.stores.items():
            tables.monthly_counts[view] = (store.read(self.schemas[view]), self.profile.name)
        return tables


def _only_months(tables: Tables, view: str, months: list) -> Tables:
    """The tables with stored bases cut to the months, so that no other is read."""
    out = Tables(tables.spark, {n: tables[n] for n in tables})

    def cut(rows: DataFrame, column: str) -> DataFrame:
        mine = F.col(column).isin([m for m in months if m is not None])
        return rows.where((mine | F.col(column).isNull()) if None in months else mine)

    if tables.donation_base is not None:
        out.donation_base = cut(tables.donation_base, "donationMonth")
        out.donation_base_profile = tables.donation_base_profile
    out.view_bases = {v: (cut(rows, V.BASE_MONTH), name) for v, (rows, name) in tables.view_bases.items()}
    return out
