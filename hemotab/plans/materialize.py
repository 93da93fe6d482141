"""Stored view bases: the donation collapse (V1, V7) and the event views (V3-V6).

Both views collapse donations per number (D1) *before* any period filter,
so the filter cannot be pushed below the collapse: computed on the fly,
every report re-reads and re-collapses the whole donation history.  The
collapse does not depend on the report period or the reporting date, so
it is written once (per release profile) as Parquet partitioned by
donation month; reports then read only the months of their period
(partition pruning) and compute the date-dependent values (age, band)
and the labels at read time.

The table is written to the shared folder the cluster names in
``spark.checkpoint.dir`` (see :func:`hemotab.session.checkpoint_dir`),
which also cuts the lineage: later reports start from files.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemotab.plans import views as V
from hemotab.profile import DEFAULT_PROFILE, DISEASES, Profile
from hemotab.session import checkpoint_dir
from hemotab.sources.tables import Tables

MONTH = "donationMonth"

# Stored columns: everything V1 and V7 derive their output from, except
# values that depend on the reporting date.
STORED = (
    "id", "donationIdentificationNumber", "donorNumber", "gender", "birthDate", "donationDate",
    "venue", "donationType", "packType", "bloodAbo", "bloodRh", "bleedStartTime", "bleedEndTime",
    "bloodTypingStatus", "bloodTypingMatchStatus", "ttiStatus", "donorWeight", "haemoglobinCount",
    "haemoglobinLevel", "donorPulse", "bloodPressureSystolic", "bloodPressureDiastolic",
    "adverseEvent_id", "ineligibleDonor", "released", "flaggedForCounselling", "counsellingStatus",
    "counsellingDate", *(f"{d}_pos" for d in DISEASES),
)


def donation_base(tables: Tables, profile: Profile = DEFAULT_PROFILE) -> DataFrame:
    """One row per donation number with all stored columns and the month."""
    out = list(dict.fromkeys(V.DONATION_COLUMNS + V.TESTING_COLUMNS))
    rows = V._donation_base(tables, profile, out, DISEASES, counselling=True)
    return rows.select(*STORED, F.trunc("donationDate", "month").alias(MONTH))


def _balanced_by_month(rows: DataFrame, month: str) -> DataFrame:
    """Rows grouped by month for a partitioned write, with balanced tasks.

    The ``rebalance`` hint hashes on the month, and AQE then splits any
    oversized partition (a month, a timestamp or a group of identical rows
    holding a third of all rows) into advisory-size slices and merges small
    ones. Each task writes one month's folder, and files stay near the
    advisory size. Without AQE it degrades to a plain hash repartition.
    """
    return rows.hint("rebalance", month)


def write_donation_base(tables: Tables, profile: Profile = DEFAULT_PROFILE, path: str | None = None) -> str:
    """Writes the base partitioned by month, with balanced write tasks
    (:func:`_balanced_by_month`) even when one month holds most donations.

    Each build goes to a new folder (``.../donation_base/<profile>/<run>``)
    and the folder is returned: a failed or half-written build never
    replaces the one readers use, and a lost executor only re-runs its
    tasks (Spark's file committer publishes a task's files once).
    """
    spark = tables.spark
    if path is None:
        run = f"{time.strftime('%Y%m%dT%H%M%S')}-{uuid.uuid4().hex[:8]}"
        path = f"{checkpoint_dir(spark).rstrip('/')}/donation_base/{profile.name}/{run}"
    base = donation_base(tables, profile)
    (_balanced_by_month(base, MONTH)
         .write.mode("errorifexists").partitionBy(MONTH).parquet(path))
    return path


def use_donation_base(tables: Tables, path: str, profile: Profile = DEFAULT_PROFILE) -> Tables:
    """Makes the donation views of ``tables`` read the stored base."""
    stored = tables.spark.read.parquet(path)
    missing = set(STORED) - set(stored.columns)
    if missing:
        raise ValueError(f"{path} lacks columns {sorted(missing)}")
    tables.donation_base = stored
    tables.donation_base_profile = profile.name
    return tables


# --- event views (V3-V6) -------------------------------------------------------------
_DECLARED = {
    "inventorySummaryView": V.INVENTORY_COLUMNS,
    "deferralSummaryView": V.DEFERRAL_COLUMNS,
    "discardSummaryView": V.DISCARD_COLUMNS,
    "issuedSummaryView": V.ISSUED_COLUMNS,
}


def write_view_base(tables: Tables, view: str, profile: Profile = DEFAULT_PROFILE, path: str | None = None) -> str:
    """Stores an event view's rows partitioned by the month of its date.

    Outputs that depend on the reporting date (expiry, age band) are
    stored as their inputs (expiry time, birth date) and computed at read.
    Same folder-per-build rule as :func:`write_donation_base`.
    """
    spark = tables.spark
    date_field, _ = V.EVENT_BASES[view]
    if path is None:
        run = f"{time.strftime('%Y%m%dT%H%M%S')}-{uuid.uuid4().hex[:8]}"
        path = f"{checkpoint_dir(spark).rstrip('/')}/{view}/{profile.name}/{run}"
    cols = V.stored_columns(view, _DECLARED[view])
    rows = V.VIEWS[view](tables, profile=profile, columns=cols)
    rows = rows.withColumn(V.BASE_MONTH, F.trunc(F.col(date_field).cast("date"), "month"))
    (_balanced_by_month(rows, V.BASE_MONTH)
         .write.mode("errorifexists").partitionBy(V.BASE_MONTH).parquet(path))
    return path


def use_view_base(tables: Tables, view: str, path: str, profile: Profile = DEFAULT_PROFILE) -> Tables:
    stored = tables.spark.read.parquet(path)
    missing = set(V.stored_columns(view, _DECLARED[view])) - set(stored.columns)
    if missing:
        raise ValueError(f"{path} lacks columns {sorted(missing)}")
    tables.view_bases[view] = (stored, profile.name)
    return tables


def write_all_bases(tables: Tables, profile: Profile = DEFAULT_PROFILE, root: str | None = None) -> dict[str, str]:
    """Stores the donation base and the four event views; returns their folders."""
    paths = {"donation": write_donation_base(tables, profile, None if root is None else f"{root}/donation")}
    for view in V.EVENT_BASES:
        paths[view] = write_view_base(tables, view, profile, None if root is None else f"{root}/{view}")
    return paths


def use_all_bases(tables: Tables, paths: dict[str, str], profile: Profile = DEFAULT_PROFILE) -> Tables:
    use_donation_base(tables, paths["donation"], profile)
    for view in V.EVENT_BASES:
        use_view_base(tables, view, paths[view], profile)
    return tables
