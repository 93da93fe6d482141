"""The seven summary views (V1-V7) as DataFrame plans.

Each view is a function ``(tables, ...) -> DataFrame``.  ``columns``
names the output columns the caller needs (default: all, in the declared
order); joins that feed none of them are left out.  Left joins are only
dropped where the joined key is the other table's primary key, so they
cannot change the row count.  Filters in the reference's WHERE clauses
that reject nulls turn its left joins into inner joins; they are written
as inner joins here.

Scale notes
* Code tables (types, reasons, sites) are broadcast if the planner's own size
  estimate is small (``operators.joins.code_table``); no job runs for it.
* All other joins are planned as shuffles with AQE skew splitting; AQE turns
  one into a broadcast from the measured bytes of a shuffled side.
* The donation views pick one donation per number (D1) by a hash aggregate
  over two narrow columns.  The wide donation columns are scanned once more for
  the chosen ids only, so a report's period filter reaches that scan, and the
  shuffle by id serves the counselling and test-flag joins as well.
* Test results and counselling are reduced to one row per donation before
  they are joined (J-T, D2), so nothing fans out.
* Component batches are broadcast by the same estimate.  Components without a
  batch can't match one; their null keys are spread, should they be shuffled.
* Inventory rows move once, to their donation; returns are brought there by ids.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemotab.functions import labels as L
from hemotab.functions import recodes as R
from hemotab.operators.dedupe import latest_counselling, one_per_donation_number
from hemotab.operators.joins import code_table, dim_lookup, known_small
from hemotab.operators.results import positive_flags
from hemotab.profile import DEFAULT_PROFILE, DISEASES, Profile
from hemotab.sources.tables import Tables

DateLike = dt.date | str | None

DONATION_COLUMNS = (
    "donationIdentificationNumber", "donorNumber", "gender", "age", "ageGroup",
    "donationDate", "venue", "donationType", "packType", "bloodType",
    "bleedStartTime", "bleedEndTime", "bloodTypingStatus", "bloodTypingMatchStatus",
    "ttiStatus", "donorWeight", "haemoglobinCount", "haemoglobinLevel", "donorPulse",
    "bloodPressureSystolic", "bloodPressureDiastolic", "adverseEvent_id",
    "ineligibleDonor", "released", "flaggedForCounselling", "counsellingStatus",
    "counsellingDate", "donorCounsellingStatus", "ttiReactiveStatus",
)
BATCH_LOCATION_COLUMNS = ("id", "name")
INVENTORY_COLUMNS = (
    "donationIdentificationNumber", "componentTypeName", "componentCode", "createdOn",
    "processedAtLocation", "currentLocation", "expiryStatus", "componentStatus",
    "inventoryStatus", "returnStatus", "finalComponentStatus",
)
DEFERRAL_COLUMNS = ("donorNumber", "gender", "ageGroup", "deferralDate", "reason", "venue")
DISCARD_COLUMNS = ("statusChangedOn", "statusChangeReason", "componentTypeName", "processedAtLocation")
ISSUED_COLUMNS = ("orderId", "orderStatus", "orderDate", "dispatchedTo", "componentTypeName")
TESTING_COLUMNS = (
    "donationIdentificationNumber", "donorNumber", "gender", "age", "ageGroup",
    "donationDate", "venue", "donationType", "packType", "bloodType",
    "bleedStartTime", "bleedEndTime", "bloodTypingStatus", "bloodTypingMatchStatus",
    "ttiStatus", "adverseEvent_id", "ineligibleDonor", "released", "bloodGrouping",
    "hivPrevalence", "hbvPrevalence", "hcvPrevalence", "syphilisPrevalence", "ttiCoinfection",
)

# Donation columns that pass through unchanged.
_DONATION_PASSTHROUGH = (
    "donationDate", "bleedStartTime", "bleedEndTime", "bloodTypingStatus",
    "bloodTypingMatchStatus", "ttiStatus", "donorWeight", "haemoglobinCount",
    "haemoglobinLevel", "donorPulse", "bloodPressureSystolic", "bloodPressureDiastolic",
    "adverseEvent_id", "ineligibleDonor", "released",
)
_COUNSELLING_OUT = ("flaggedForCounselling", "counsellingStatus", "counsellingDate", "donorCounsellingStatus")
_PREVALENCE = {f"{d}Prevalence": d for d in DISEASES}


def _project(rows: DataFrame, out: Sequence[str], exprs: dict) -> DataFrame:
    """Final projection; derived columns are built only when selected."""
    return rows.select(*[exprs[c]().alias(c) if c in exprs else F.col(c) for c in out])


def _wanted(columns: Sequence[str] | None, all_columns: Sequence[str], extras: Sequence[str] = ()) -> list[str]:
    """Requested columns in declared order; ``extras`` are raw inputs a
    stored base keeps in place of values that depend on the reporting date."""
    if columns is None:
        return list(all_columns)
    unknown = set(columns) - set(all_columns) - set(extras)
    if unknown:
        raise ValueError(f"unknown view columns: {sorted(unknown)}")
    return [c for c in [*all_columns, *extras] if c in set(columns)]


# --- stored event-view bases (plans.materialize) ----------------------------------------
# View -> (date field, {output that depends on the reporting date: raw input stored}).
EVENT_BASES = {
    "inventorySummaryView": ("createdOn", {"expiryStatus": "expiresOn"}),
    "deferralSummaryView": ("deferralDate", {"ageGroup": "birthDate"}),
    "discardSummaryView": ("statusChangedOn", {}),
    "issuedSummaryView": ("orderDate", {}),
}
BASE_MONTH = "month"


def stored_columns(view: str, declared: Sequence[str]) -> list[str]:
    _, raw = EVENT_BASES[view]
    return [c for c in declared if c not in raw] + list(raw.values())


def _stored_view(tables: Tables, view: str, profile: Profile, period: tuple[str, str] | None) -> DataFrame | None:
    """The stored rows of an event view, pruned to the months of ``period``."""
    entry = getattr(tables, "view_bases", {}).get(view)
    if entry is None:
        return None
    df, name = entry
    if name != profile.name:
        raise ValueError(f"stored {view} is for {name}, not {profile.name}")
    if period is not None:
        lo, hi = (F.trunc(F.lit(d).cast("date"), "month") for d in period)
        df = df.where(F.col(BASE_MONTH).between(lo, hi))
    return df


# --- V1 and V7: one row per donation number -------------------------------------------
def _donation_columns(need: set[str], diseases: Sequence[str]) -> set[str]:
    """Donation columns the requested output columns are computed from."""
    base = {"id", "donationIdentificationNumber"}
    base |= {c for c in _DONATION_PASSTHROUGH if c in need}
    if "venue" in need:
        base.add("venue_id")
    if "donationType" in need:
        base.add("donationType_id")
    if need & {"bloodType", "bloodGrouping"}:
        base |= {"bloodAbo", "bloodRh"}
    if "bloodGrouping" in need:
        base.add("bloodTypingMatchStatus")
    if diseases or "ttiReactiveStatus" in need:
        base |= {"ttiStatus", "released"}
    if need & set(_PREVALENCE) or "ttiCoinfection" in need:
        base.add("released")
    return base


def donation_numbers(tables: Tables, profile: Profile = DEFAULT_PROFILE) -> DataFrame:
    """D1 on its own: the donation id kept for each donation number, among the
    donations that pass the views' WHERE clause."""
    donation = tables["Donation"].where(~F.col("isDeleted")).select(
        "id", "donationIdentificationNumber", "donor_id", "packType_id")
    pack = tables["PackType"].where(F.col("countAsDonation")).select(F.col("id").alias("packType_id"))
    donors = tables["Donor"].where(~F.col("isDeleted") & (F.col("donorStatus") != L.MERGED)).select(
        F.col("id").alias("donor_id"))
    valid = donation.join(code_table(pack), "packType_id", "left_semi").join(donors, "donor_id", "left_semi")
    return one_per_donation_number(valid).select("donationIdentificationNumber", "id")


def _donation_base(tables: Tables, profile: Profile, out: list[str], diseases: Sequence[str],
                   counselling: bool, period: tuple[str, str] | None = None) -> DataFrame:
    """The chosen donations with the labels, counselling row and test flags
    the requested columns need.

    When ``tables`` carries a stored base (``plans.materialize``), it is
    read instead and ``period`` (first and last date, inclusive, a superset of
    the report period) prunes its month partitions.  The stored rows are
    already collapsed, so filtering them by month cannot change which row
    represents a number.
    """
    stored = getattr(tables, "donation_base", None)
    if stored is not None:
        if tables.donation_base_profile != profile.name:
            raise ValueError(f"stored donation base is for {tables.donation_base_profile}, not {profile.name}")
        if period is not None:
            lo, hi = (F.trunc(F.lit(d).cast("date"), "month") for d in period)
            stored = stored.where(F.col("donationMonth").between(lo, hi))
        return stored
    need = set(out)
    base = _donation_columns(need, diseases)
    donor_cols = [c for c in ("donorNumber", "gender") if c in need]
    if need & {"age", "ageGroup", "birthDate"}:
        donor_cols.append("birthDate")
    base |= {"donor_id"} if donor_cols else set()
    base |= {"packType_id"} if "packType" in need else set()
    chosen = donation_numbers(tables, profile).select("id")
    # A filter on the donation's own columns moves below this semi join, to
    # the scan; it never reaches the choice itself.
    rows = tables["Donation"].select(*sorted(base)).join(chosen, "id", "left_semi")
    if counselling:
        rows = rows.join(latest_counselling(tables["PostDonationCounselling"])
                         .withColumnRenamed("donation_id", "id"), "id", "left")
    if diseases:
        flags = positive_flags(tables["BloodTestResult"], profile, diseases)
        rows = rows.join(flags.withColumnRenamed("donation_id", "id"), "id", "left")
    if donor_cols:
        rows = _with_donor(tables, rows, chosen, donor_cols, wide=len(base) > WIDE_COLUMNS)
    if "packType" in need:
        rows = dim_lookup(tables, rows, "PackType", "packType_id", {"packType": "packType"})
    if "venue" in need:
        rows = dim_lookup(tables, rows, "Location", "venue_id", {"name": "venue"})
    if "donationType" in need:
        rows = dim_lookup(tables, rows, "DonationType", "donationType_id", {"donationType": "donationType"})
    return rows


# Rows of more columns stay with their id, and their donors are brought there.
WIDE_COLUMNS = 12


def _with_donor(tables: Tables, rows: DataFrame, chosen: DataFrame, donor_cols: list[str], wide: bool) -> DataFrame:
    """Inner join of the chosen donations with their donors."""
    donors = tables["Donor"].select(F.col("id").alias("donor_id"), *donor_cols)
    if not wide:
        return rows.join(donors, "donor_id", "inner")
    # Narrow rows go to the donors and come back by id; repeated ids keep their own donors.
    pairs = (tables["Donation"].where(F.col("donor_id").isNotNull()).select("id", "donor_id")
             .join(chosen, "id", "left_semi").distinct())
    theirs = pairs.join(donors, "donor_id", "inner").select(F.col("id").alias("__id"), F.col("donor_id").alias("__donor"), *donor_cols)
    # No equality of donors: Spark would then deal the wide rows by both columns.
    same = (F.col("donor_id") <= F.col("__donor")) & (F.col("donor_id") >= F.col("__donor"))
    return rows.join(theirs, (rows["id"] == theirs["__id"]) & same, "inner").drop("__id", "__donor")


def donation_summary(tables: Tables, as_of: DateLike = None, profile: Profile = DEFAULT_PROFILE,
                     columns: Sequence[str] | None = None, period: tuple[str, str] | None = None) -> DataFrame:
    """V1: donation summary, one row per donation number (29 columns)."""
    out = _wanted(columns, DONATION_COLUMNS, extras=("birthDate",))
    need = set(out)
    diseases = ("hiv",) if "ttiReactiveStatus" in need else ()
    rows = _donation_base(tables, profile, out, diseases, counselling=bool(need & set(_COUNSELLING_OUT)),
                          period=period)
    exprs = {
        "age": lambda: R.age_years("birthDate", as_of),
        "ageGroup": lambda: R.age_band(R.age_years("birthDate", as_of)),
        "bloodType": R.blood_type,
        "donorCounsellingStatus": R.counselling_label,
        "ttiReactiveStatus": lambda: R.tti_reactive_status(profile),
    }
    return _project(rows, out, exprs)


def testing_summary(tables: Tables, as_of: DateLike = None, profile: Profile = DEFAULT_PROFILE,
                    columns: Sequence[str] | None = None, strict_gate: bool = False,
                    period: tuple[str, str] | None = None) -> DataFrame:
    """V7: testing summary with grouping, prevalence and co-infection labels (24 columns)."""
    out = _wanted(columns, TESTING_COLUMNS, extras=("birthDate",))
    need = set(out)
    if "ttiCoinfection" in need:
        diseases = DISEASES
    else:
        diseases = tuple(d for col, d in _PREVALENCE.items() if col in need)
    rows = _donation_base(tables, profile, out, diseases, counselling=False, period=period)
    exprs = {
        "age": lambda: R.age_years("birthDate", as_of),
        "ageGroup": lambda: R.age_band(R.age_years("birthDate", as_of)),
        "bloodType": R.blood_type,
        "bloodGrouping": lambda: R.blood_grouping(R.blood_type()),
        "ttiCoinfection": lambda: R.coinfection(profile, strict_gate=strict_gate),
    }
    exprs.update({col: (lambda d=d: R.prevalence(d, profile)) for col, d in _PREVALENCE.items()})
    return _project(rows, out, exprs)


# --- V2 -----------------------------------------------------------------------------------
def batch_location(tables: Tables) -> DataFrame:
    """V2: component batches with a known location: (id, name)."""
    sites = tables["Location"].select(F.col("id").alias("location_id"), "name")
    batches = tables["ComponentBatch"].select("id", "location_id")
    return batches.join(code_table(sites), "location_id", "inner").select("id", "name")


# Rows without a key are dealt to so many negative keys, which no batch has.
NULL_KEYS = 4096


def _processed_at(tables: Tables, rows: DataFrame, batch_key: str = "componentBatch_id") -> DataFrame:
    """Left join of the batch-location view on the component's batch.

    Components without a batch match nothing; their null keys would meet in
    one shuffle partition, so they get spread keys that match nothing either.
    Batches that the planner knows to be few are broadcast, and all components
    stay where they are.
    """
    v2 = batch_location(tables).select(F.col("id").alias("__batch"), F.col("name").alias("processedAtLocation"))
    few = known_small(tables["ComponentBatch"].select("id", "location_id"))
    spread = -1 - F.pmod(F.xxhash64(*rows.columns), F.lit(NULL_KEYS))
    keyed = rows.withColumn("__key", F.coalesce(F.col(batch_key), spread))
    v2 = F.broadcast(v2) if few else v2
    return keyed.join(v2, keyed["__key"] == v2["__batch"], "left").drop("__batch", "__key")


# --- V3 -----------------------------------------------------------------------------------
def inventory_summary(tables: Tables, as_of: DateLike = None, profile: Profile = DEFAULT_PROFILE,
                      columns: Sequence[str] | None = None, dedupe_returns: bool = False,
                      period: tuple[str, str] | None = None) -> DataFrame:
    """V3: inventory, one row per component and return (J15: a component
    returned twice appears twice; ``dedupe_returns=True`` keeps its latest return).
    """
    out = _wanted(columns, INVENTORY_COLUMNS, extras=("expiresOn",))
    need = set(out)
    exprs = {
        "componentStatus": lambda: F.col("status"),
        "expiryStatus": lambda: R.expiry_status("expiresOn", as_of),
        "finalComponentStatus": lambda: R.component_status_label("status"),
    }
    stored = None if dedupe_returns else _stored_view(tables, "inventorySummaryView", profile, period)
    if stored is not None:
        return _project(stored, out, {"expiryStatus": exprs["expiryStatus"]})
    rows = tables["Component"].where(~F.col("isDeleted")).select(
        "id", "donation_id", "componentType_id", "location_id", "componentBatch_id",
        "componentCode", "createdOn", "expiresOn", "status", "inventoryStatus")
    # Returns multiply rows, so they are joined whatever the columns asked.
    links = tables["ReturnForm_Component"].where(F.col("component_id").isNotNull()).select(
        "component_id", "returnForm_id")
    if dedupe_returns:
        links = links.groupBy("component_id").agg(F.max("returnForm_id").alias("returnForm_id"))
    if "returnStatus" in need:
        forms = tables["ReturnForm"].select(F.col("id").alias("returnForm_id"), F.col("status").alias("returnStatus"))
        links = links.join(forms, "returnForm_id", "left")
    if "donationIdentificationNumber" in need:
        rows = _with_number_and_returns(tables, rows, links)
    else:
        rows = rows.join(links, rows["id"] == links["component_id"], "left")
    if "componentTypeName" in need:
        rows = dim_lookup(tables, rows, "ComponentType", "componentType_id", {"componentTypeName": "componentTypeName"})
    if "currentLocation" in need:
        rows = dim_lookup(tables, rows, "Location", "location_id", {"name": "currentLocation"})
    if "processedAtLocation" in need:
        rows = _processed_at(tables, rows)
    return _project(rows, out, exprs)


# A donation with more returns than this meets them by the component's id.
RETURNS_TOGETHER = 64


def _with_number_and_returns(tables: Tables, rows: DataFrame, links: DataFrame) -> DataFrame:
    """Components with their donation's number and their returns (left joins).

    The wide rows move once, to their donation.  The returns follow them there
    as one list per donation: the component's donation is found for them by two
    ids.  Components without a donation, and those of a donation with many
    returns, meet their returns by their own id.
    """
    carried = [c for c in links.columns if c != "component_id"]
    # Dealt by id, so that neither dropping repeated rows nor the join deals them again.
    owners = (tables["Component"].where(F.col("id").isNotNull() & F.col("donation_id").isNotNull())
              .select(F.col("id").alias("component_id"), F.col("donation_id").alias("__of"))
              .repartition("component_id").distinct())
    placed = links.join(owners, "component_id")
    crowded = (placed.groupBy("__of").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > RETURNS_TOGETHER)
               .select(F.col("__of").alias("donation_id")))
    lists = (placed.withColumnRenamed("__of", "donation_id").join(crowded, "donation_id", "left_anti")
             .groupBy("donation_id").agg(F.collect_list(F.struct("component_id", *carried)).alias("__returns")))
    d = tables["Donation"].select(F.col("id").alias("donation_id"), "donationIdentificationNumber")
    owned = rows.where(F.col("donation_id").isNotNull()).join(d, "donation_id", "left")
    together = owned.join(crowded, "donation_id", "left_anti").join(lists, "donation_id", "left")
    mine = F.filter("__returns", lambda r: r["component_id"] == F.col("id"))
    together = together.withColumn("__return", F.explode_outer(mine)).select(
        *owned.columns, *[F.col(f"__return.{c}").alias(c) for c in carried])
    apart = owned.join(crowded, "donation_id", "left_semi").unionByName(
        rows.where(F.col("donation_id").isNull()).withColumn("donationIdentificationNumber", F.lit(None).cast("string")))
    apart = apart.join(links, apart["id"] == links["component_id"], "left").select(*owned.columns, *carried)
    return together.unionByName(apart)


# --- V4 -----------------------------------------------------------------------------------
def deferral_summary(tables: Tables, as_of: DateLike = None, profile: Profile = DEFAULT_PROFILE,
                     columns: Sequence[str] | None = None, period: tuple[str, str] | None = None) -> DataFrame:
    """V4: deferrals that are not voided, of donors not deleted (merged donors kept)."""
    out = _wanted(columns, DEFERRAL_COLUMNS, extras=("birthDate",))
    need = set(out)
    exprs = {"ageGroup": lambda: R.age_band(R.age_years("birthDate", as_of))}
    stored = _stored_view(tables, "deferralSummaryView", profile, period)
    if stored is not None:
        return _project(stored, out, exprs)
    rows = tables["DonorDeferral"].where(~F.col("isVoided")).select(
        "deferredDonor_id", "venue_id", "deferralReason_id", "deferralDate")
    if "reason" in need:
        rows = dim_lookup(tables, rows, "DeferralReason", "deferralReason_id", {"reason": "reason"})
    if "venue" in need:
        rows = dim_lookup(tables, rows, "Location", "venue_id", {"name": "venue"})
    donors = tables["Donor"].where(~F.col("isDeleted")).select(
        F.col("id").alias("deferredDonor_id"), "donorNumber", "gender", "birthDate")
    rows = rows.join(donors, "deferredDonor_id", "inner")
    return _project(rows, out, exprs)


# --- V5 -----------------------------------------------------------------------------------
def discard_summary(tables: Tables, profile: Profile = DEFAULT_PROFILE,
                    columns: Sequence[str] | None = None, period: tuple[str, str] | None = None) -> DataFrame:
    """V5: discard events (a component discarded twice counts twice)."""
    out = _wanted(columns, DISCARD_COLUMNS)
    need = set(out)
    stored = _stored_view(tables, "discardSummaryView", profile, period)
    if stored is not None:
        return stored.select(*out)
    events = tables["ComponentStatusChange"].where(
        (F.col("newStatus") == L.DISCARDED) & ~F.col("isDeleted")).select(
        "component_id", "statusChangeReason_id", "statusChangedOn")
    components = tables["Component"].where(~F.col("isDeleted")).select(
        F.col("id").alias("component_id"), "componentType_id", "componentBatch_id")
    rows = events.join(components, "component_id", "inner")
    if "componentTypeName" in need:
        rows = dim_lookup(tables, rows, "ComponentType", "componentType_id", {"componentTypeName": "componentTypeName"})
    if "statusChangeReason" in need:
        rows = dim_lookup(tables, rows, "ComponentStatusChangeReason", "statusChangeReason_id",
                          {"statusChangeReason": "statusChangeReason"})
    if "processedAtLocation" in need:
        rows = _processed_at(tables, rows)
    return rows.select(*out)


# --- V6 -----------------------------------------------------------------------------------
def issued_summary(tables: Tables, profile: Profile = DEFAULT_PROFILE,
                   columns: Sequence[str] | None = None, period: tuple[str, str] | None = None) -> DataFrame:
    """V6: components on dispatched issue orders."""
    out = _wanted(columns, ISSUED_COLUMNS)
    need = set(out)
    stored = _stored_view(tables, "issuedSummaryView", profile, period)
    if stored is not None:
        return stored.select(*out)
    orders = tables["OrderForm"].where(
        ~F.col("isDeleted") & (F.col("type") == L.ISSUE_ORDER_TYPE) & (F.col("status") == L.DISPATCHED)
    ).select(F.col("id").alias("orderForm_id"), "status", "orderDate", "dispatchedTo_id")
    rows = tables["OrderForm_Component"].select("orderForm_id", "component_id").join(orders, "orderForm_id", "inner")
    components = tables["Component"]
    if profile.issued_requires_live_component:
        components = components.where(~F.col("isDeleted"))
        how = "inner"
    else:
        how = "left"
    if profile.issued_requires_live_component or "componentTypeName" in need:
        components = components.select(F.col("id").alias("component_id"), "componentType_id")
        rows = rows.join(components, "component_id", how)
    if "componentTypeName" in need:
        rows = dim_lookup(tables, rows, "ComponentType", "componentType_id", {"componentTypeName": "componentTypeName"})
    if "dispatchedTo" in need:
        rows = dim_lookup(tables, rows, "Location", "dispatchedTo_id", {"name": "dispatchedTo"})
    exprs = {"orderId": lambda: F.col("orderForm_id"), "orderStatus": lambda: R.order_status_label("status")}
    return _project(rows, out, exprs)


VIEWS = {
    "donationSummaryView": donation_summary,
    "componentBatchLocationView": batch_location,
    "inventorySummaryView": inventory_summary,
    "deferralSummaryView": deferral_summary,
    "discardSummaryView": discard_summary,
    "issuedSummaryView": issued_summary,
    "testingSummaryView": testing_summary,
}


def register_views(tables: Tables, as_of: DateLike = None, profile: Profile = DEFAULT_PROFILE) -> None:
    """Every view as a session temp view, for SQL users."""
    for name, fn in VIEWS.items():
        if fn is batch_location:
            df = fn(tables)
        elif fn in (discard_summary, issued_summary):
            df = fn(tables, profile=profile)
        else:
            df = fn(tables, as_of=as_of, profile=profile)
        df.createOrReplaceTempView(name)
