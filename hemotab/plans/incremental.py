"""The stored donation base, kept up to date by what changed.

A row of the base (D1, V1, V7) stands for one donation number.  It depends on
the donations of that number, their donors and pack types, and the chosen
donation's labels, counselling and test results.  So the keys of changed source
rows lead to the affected numbers: through the donations as they are now, and
through the base for a number that a changed donation stood for before.  Only
those numbers are computed again, and only the months that held them or hold
them now are rewritten; a reader sees the old or the new version, never a mix.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemotab.operators.joins import code_table
from hemotab.plans import materialize as M
from hemotab.plans import views as V
from hemotab.profile import DEFAULT_PROFILE, Profile
from hemotab.session import checkpoint_dir, stored
from hemotab.sources.tables import Tables
from hemotab.sources.versions import MonthlyStore, folder_bytes, new_run

NUMBER = "donationIdentificationNumber"

# Source table -> the key its changes are known by.
CHANGE_KEYS = {
    "Donation": "id", "Donor": "id", "PackType": "id", "Location": "id", "DonationType": "id",
    "BloodTestResult": "donation_id", "PostDonationCounselling": "donation_id",
}
# Code lists and the donation's column that names them.
_CODE_COLUMNS = {"PackType": "packType_id", "Location": "venue_id", "DonationType": "donationType_id"}


def changed_keys(before: Tables, after: Tables) -> dict[str, DataFrame]:
    """The keys whose rows differ between two states of the source tables, for
    sources that keep no list of changes: one aggregate per table over (key,
    64-bit digest of the row), partial on the map side.  Rows before count
    against rows after; the digest's halves are summed apart, as longs that
    cannot overflow."""
    out = {}
    for table, key in CHANGE_KEYS.items():
        columns = sorted(after[table].columns)
        digest = F.xxhash64(*[F.col(c) for c in columns])
        halves = {"high": F.shiftright(digest, 32), "low": digest.bitwiseAND(F.lit(0xFFFFFFFF)), "n": F.lit(1).cast("long")}
        sides = [t[table].where(F.col(key).isNotNull()).select(F.col(key).alias("key"), *[(sign * c).alias(n) for n, c in halves.items()])
                 for sign, t in ((-1, before), (1, after))]
        rows = sides[0].unionAll(sides[1]).groupBy("key").agg(*[F.sum(n).alias(n) for n in halves])
        out[table] = rows.where("high <> 0 OR low <> 0 OR n <> 0").select(F.col("key").alias(key))
    return out


def affected_numbers(after: Tables, base: DataFrame, changes: Mapping[str, DataFrame]) -> DataFrame:
    """Donation numbers whose row in the base may differ from now on."""
    unknown = set(changes) - set(CHANGE_KEYS)
    if unknown:
        raise ValueError(f"changes of tables the base doesn't depend on: {sorted(unknown)}")
    keys = {t: df.select(F.col(CHANGE_KEYS[t]).alias("key")).distinct() for t, df in changes.items()}
    donation = after["Donation"].select("id", NUMBER, "donor_id", *_CODE_COLUMNS.values())
    ids = [keys[t].select(F.col("key").alias("id")) for t in ("Donation", "BloodTestResult", "PostDonationCounselling") if t in keys]
    if "Donor" in keys:
        ids.append(donation.join(keys["Donor"].withColumnRenamed("key", "donor_id"), "donor_id", "left_semi").select("id"))
    for table, column in _CODE_COLUMNS.items():
        if table in keys:
            ids.append(donation.join(code_table(keys[table].withColumnRenamed("key", column)), column, "left_semi").select("id"))
    if not ids:
        return donation.select(NUMBER).limit(0)
    touched = ids[0]
    for more in ids[1:]:
        touched = touched.unionAll(more)
    touched = touched.distinct()
    now = donation.join(touched, "id", "left_semi").select(NUMBER)
    earlier = base.select("id", NUMBER).join(touched, "id", "left_semi").select(NUMBER)
    return now.unionAll(earlier).distinct()


def _of_numbers(rows: DataFrame, numbers: DataFrame, how: str) -> DataFrame:
    """Rows (not) of these numbers; the null number is a number like any other."""
    theirs = numbers.select(F.col(NUMBER).alias("__number"))
    return rows.join(theirs, F.col(NUMBER).eqNullSafe(F.col("__number")), how)


def recomputed(after: Tables, numbers: DataFrame, profile: Profile = DEFAULT_PROFILE) -> DataFrame:
    """Rows of the base for these numbers, from their donations alone."""
    spark = after.spark
    donation = stored(spark, _of_numbers(after["Donation"], numbers, "left_semi"), "affected-donations")
    theirs = donation.select(F.col("id").alias("donation_id"))
    only = {t: after[t].join(theirs, "donation_id", "left_semi") for t in ("BloodTestResult", "PostDonationCounselling")}
    return M.donation_base(after.replaced(Donation=donation, **only), profile)


@dataclass
class Update:
    """What an update did."""

    numbers: int
    rows_written: int
    months_written: int
    months: int
    bytes_written: int
    bytes_total: int
    months_changed: list = field(default_factory=list, repr=False)


class DonationBase:
    """A donation base that can be updated in place (``root``: a shared folder)."""

    def __init__(self, tables: Tables, profile: Profile = DEFAULT_PROFILE, root: str | None = None):
        self.spark, self.profile = tables.spark, profile
        self.root = root or f"{checkpoint_dir(self.spark).rstrip('/')}/donation_base/{profile.name}/{new_run()}"
        self.store = MonthlyStore(self.spark, self.root, M.MONTH)
        self.schema = T.StructType([f for f in M.donation_base(tables, profile).schema.fields])

    def rows(self) -> DataFrame:
        return self.store.read(self.schema)

    def use(self, tables: Tables) -> Tables:
        """Makes the donation views of ``tables`` read the newest version."""
        tables.donation_base, tables.donation_base_profile = self.rows(), self.profile.name
        return tables

    def build(self, tables: Tables) -> None:
        """The whole base from the source tables."""
        self.store.replace(M.donation_base(tables, self.profile))

    def update(self, after: Tables, changes: Mapping[str, DataFrame]) -> Update:
        """Brings the base up to ``after``.  ``changes``: table -> frame with the
        keys (``CHANGE_KEYS``) of rows added, altered or removed since the last
        version; for a counselling or result row that moved, the donations it
        left and came to.

        A task or job that fails leaves the former version; running the update
        again gives the same rows.
        """
        base = self.rows()
        numbers = stored(self.spark, affected_numbers(after, base, changes), "affected-numbers")
        new = stored(self.spark, recomputed(after, numbers, self.profile), "recomputed-rows")
        held = _of_numbers(base, numbers, "left_semi")
        # At most one row a month of the calendar.
        months = [r[0] for r in held.select(M.MONTH).unionAll(new.select(M.MONTH)).distinct().collect()]
        if not months:
            return Update(numbers.count(), 0, 0, len(self.store.manifest.parts()), 0, self._bytes())
        theirs = F.col(M.MONTH).isin([m for m in months if m is not None])
        if None in months:
            theirs = theirs | F.col(M.MONTH).isNull()
        kept = _of_numbers(base.where(theirs), numbers, "left_anti")
        folders = self.store.replace(kept.select(*new.columns).unionAll(new), months)
        written = sum(self.spark.read.parquet(f).count() for f in folders) if len(folders) < 2 else \
            self.spark.read.option("basePath", f"{self.root}/data").parquet(*folders).count()
        return Update(numbers.count(), written, len(months), len(self.store.manifest.parts()),
                      folder_bytes(self.spark, folders), self._bytes(), months)

    def _bytes(self) -> int:
        return folder_bytes(self.spark, list(self.store.manifest.parts().values()))
