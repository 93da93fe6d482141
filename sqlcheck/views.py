"""The seven views as plain DuckDB SQL, the second route to each answer.

Where the Spark plans collapse test results and counselling by
aggregation and pick one donation per number with a partial aggregate,
these use one left join per repeat test (on results reduced to one row per
donation and test, any positive winning), ``row_number`` windows, the
inventory and discard views' dead joins, and DuckDB's own date arithmetic
(no ``timestampdiff``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from sqlcheck.fixtures import BINARY_IDS, INTEGER_IDS

FIXTURE_TESTS = {"hiv": (0, 1), "hbv": (2, 3), "hcv": (4, 5), "syphilis": (6, 7)}
DISEASES = ("hiv", "hbv", "hcv", "syphilis")
NAMES = {"hiv": "HIV", "hbv": "HBV", "hcv": "HCV", "syphilis": "Syphilis"}


@dataclass(frozen=True)
class Release:
    unsafe: str = "UNSAFE"
    safe: str = "SAFE"
    tests_skip_deleted: bool = True
    issued_live_component: bool = True
    donation_end_plus_one: bool = False
    tests: dict = field(default_factory=lambda: FIXTURE_TESTS)


def _pairs(ids) -> dict:
    return {d: (ids[2 * k], ids[2 * k + 1]) for k, d in enumerate(DISEASES)}


RELEASES = {
    "1.4.0": Release(),
    "1.4.0-binary": Release(tests=_pairs(BINARY_IDS)),
    "1.3.0": Release(unsafe="TTI_UNSAFE", safe="TTI_SAFE", tests=_pairs(INTEGER_IDS)),
    "1.0.0": Release(unsafe="TTI_UNSAFE", safe="TTI_SAFE", tests_skip_deleted=False,
                     issued_live_component=False, donation_end_plus_one=True, tests=_pairs(INTEGER_IDS)),
}


def age_sql(birth: str, as_of: str) -> str:
    """Whole years, truncated towards zero."""
    d = f"DATE '{as_of}'"

    def between(a: str, b: str) -> str:
        return f"(year({b}) - year({a}) - CASE WHEN month({b}) * 100 + day({b}) < month({a}) * 100 + day({a}) THEN 1 ELSE 0 END)"

    return f"(CASE WHEN {birth} > {d} THEN -{between(d, birth)} ELSE {between(birth, d)} END)"


def band_sql(age: str) -> str:
    return (f"CASE WHEN {age} BETWEEN 16 AND 25 THEN '16-25' WHEN {age} BETWEEN 26 AND 35 THEN '26-35' "
            f"WHEN {age} BETWEEN 36 AND 50 THEN '36-50' WHEN {age} BETWEEN 51 AND 65 THEN '51-65' "
            f"ELSE 'Other' END")


def test_ctes(rel: Release, diseases=DISEASES) -> list[str]:
    out = []
    for d in diseases:
        for k, tid in enumerate(rel.tests[d], start=1):
            tid = f"'{tid}'" if isinstance(tid, str) else tid
            deleted = " AND NOT isDeleted" if rel.tests_skip_deleted else ""
            out.append(
                f"t_{d}{k} AS (SELECT donation_id, CASE WHEN max(CASE WHEN result = 'POS' THEN 1 ELSE 0 END) = 1 "
                f"THEN 'POS' ELSE 'NEG' END AS result FROM BloodTestResult "
                f"WHERE bloodTest_id = {tid}{deleted} GROUP BY donation_id)")
    return out


def test_joins(alias: str, diseases=DISEASES) -> str:
    return " ".join(f"LEFT JOIN t_{d}{k} ON t_{d}{k}.donation_id = {alias}.id"
                    for d in diseases for k in (1, 2))


def _pos(d: str) -> str:
    return f"(t_{d}1.result = 'POS' OR t_{d}2.result = 'POS')"


def _one_per_number(name: str) -> list[str]:
    """Donations passing the WHERE clause, then the lowest id per number."""
    return [
        f"{name}_rows AS (SELECT dn.*, dr.donorNumber, dr.gender, dr.birthDate, loc.name AS venue, "
        "dt.donationType, pt.packType FROM Donation dn "
        "LEFT JOIN Donor dr ON dn.donor_id = dr.id LEFT JOIN Location loc ON dn.venue_id = loc.id "
        "LEFT JOIN DonationType dt ON dn.donationType_id = dt.id LEFT JOIN PackType pt ON dn.packType_id = pt.id "
        "WHERE NOT dn.isDeleted AND NOT dr.isDeleted AND dr.donorStatus <> 'MERGED' AND pt.countAsDonation)",
        f"{name}_one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY donationIdentificationNumber "
        f"ORDER BY id) AS rn FROM {name}_rows) q WHERE rn = 1)",
    ]


DONATION_TABLES = ("Donation", "Donor", "Location", "DonationType", "PackType")


def donation_view(as_of: str, rel: Release) -> tuple[list[str], list[str]]:
    age = age_sql("d.birthDate", as_of)
    u, s = rel.unsafe, rel.safe
    body = (
        "donationSummaryView AS (SELECT d.donationIdentificationNumber, d.donorNumber, d.gender, "
        f"{age} AS age, {band_sql(age)} AS ageGroup, d.donationDate, d.venue, d.donationType, d.packType, "
        "d.bloodAbo || d.bloodRh AS bloodType, d.bleedStartTime, d.bleedEndTime, d.bloodTypingStatus, "
        "d.bloodTypingMatchStatus, d.ttiStatus, d.donorWeight, d.haemoglobinCount, d.haemoglobinLevel, "
        "d.donorPulse, d.bloodPressureSystolic, d.bloodPressureDiastolic, d.adverseEvent_id, d.ineligibleDonor, "
        "d.released, c.flaggedForCounselling, c.counsellingStatus, c.counsellingDate, "
        "CASE WHEN c.counsellingStatus = 'RECEIVED_COUNSELLING' THEN 'Counselled' "
        "WHEN c.counsellingStatus = 'REFUSED_COUNSELLING' THEN 'Refused Counselling' "
        "ELSE 'Not Counselled' END AS donorCounsellingStatus, "
        f"CASE WHEN d.ttiStatus = '{u}' AND d.released AND {_pos('hiv')} THEN 'Reactive for HIV' "
        f"WHEN d.ttiStatus = '{u}' AND d.released THEN 'Reactive for Other TTIs' "
        f"WHEN d.ttiStatus = '{s}' AND d.released THEN 'TTI Unreactive' ELSE 'Unknown' END AS ttiReactiveStatus "
        "FROM v1_one d LEFT JOIN v1_pdc c ON c.donation_id = d.id " + test_joins("d", ("hiv",)) + ")"
    )
    ctes = _one_per_number("v1") + [
        "v1_pdc AS (SELECT donation_id, flaggedForCounselling, counsellingStatus, counsellingDate FROM "
        "(SELECT *, row_number() OVER (PARTITION BY donation_id ORDER BY counsellingDate DESC NULLS LAST, "
        "id DESC) AS rn FROM PostDonationCounselling) q WHERE rn = 1)",
    ] + test_ctes(rel, ("hiv",)) + [body]
    return ctes, [*DONATION_TABLES, "PostDonationCounselling", "BloodTestResult"]


_GROUPS = ("O+", "O-", "A+", "A-", "B+", "B-", "AB+", "AB-")
_COINFECTION = (
    ("hiv", "hbv", "hcv", "syphilis"), ("hiv", "hbv", "hcv"), ("hiv", "hbv", "syphilis"),
    ("hiv", "hcv", "syphilis"), ("hiv", "hbv"), ("hiv", "hcv"), ("hiv", "syphilis"), ("hiv",),
)


def coinfection_case(rel: Release, strict_gate: bool = False) -> str:
    """The co-infection CASE over alias ``d`` and the ``t_<disease><k>`` joins."""
    gate = f"d.ttiStatus = '{rel.unsafe}' AND d.released"
    rows = " ".join(
        f"WHEN {' AND '.join(_pos(d) for d in combo)} AND {gate} THEN '{', '.join(NAMES[d] for d in combo)}'"
        for combo in _COINFECTION)
    if strict_gate:
        other = f"({_pos('hbv')} OR {_pos('hcv')} OR {_pos('syphilis')}) AND {gate}"
    else:
        other = f"{_pos('hbv')} OR {_pos('hcv')} OR {_pos('syphilis')} AND {gate}"
    return (f"CASE {rows} WHEN {other} THEN 'Other TTIs (Excl. HIV)' WHEN d.released THEN 'No TTIs' "
            "ELSE 'Unknown' END")


def testing_view(as_of: str, rel: Release, strict_gate: bool = False) -> tuple[list[str], list[str]]:
    age = age_sql("d.birthDate", as_of)
    gate = f"d.ttiStatus = '{rel.unsafe}' AND d.released"
    grouping = " ".join(
        f"WHEN d.bloodAbo || d.bloodRh = '{g}' AND d.bloodTypingMatchStatus IN ('MATCH','RESOLVED') THEN ' {g}'"
        for g in _GROUPS)
    prevalence = ", ".join(
        f"CASE WHEN {_pos(d)} AND {gate} THEN 'Reactive for {NAMES[d]}' WHEN d.released "
        f"THEN 'Not Reactive for {NAMES[d]}' ELSE 'Unknown' END AS {d}Prevalence" for d in DISEASES)
    body = (
        "testingSummaryView AS (SELECT d.donationIdentificationNumber, d.donorNumber, d.gender, "
        f"{age} AS age, {band_sql(age)} AS ageGroup, d.donationDate, d.venue, d.donationType, d.packType, "
        "d.bloodAbo || d.bloodRh AS bloodType, d.bleedStartTime, d.bleedEndTime, d.bloodTypingStatus, "
        "d.bloodTypingMatchStatus, d.ttiStatus, d.adverseEvent_id, d.ineligibleDonor, d.released, "
        f"CASE {grouping} WHEN d.bloodTypingMatchStatus = 'NO_TYPE_DETERMINED' THEN 'No Type Determined' "
        f"ELSE 'Unknown' END AS bloodGrouping, {prevalence}, "
        f"{coinfection_case(rel, strict_gate)} AS ttiCoinfection "
        "FROM v7_one d " + test_joins("d") + ")"
    )
    return _one_per_number("v7") + test_ctes(rel) + [body], [*DONATION_TABLES, "BloodTestResult"]


BATCH_LOCATION = ("componentBatchLocationView AS (SELECT b.id, l.name FROM ComponentBatch b, Location l "
                  "WHERE b.location_id = l.id)")


def batch_location_view() -> tuple[list[str], list[str]]:
    return [BATCH_LOCATION], ["ComponentBatch", "Location"]


_STATUS = (("PROCESSED", "Processed"), ("EXPIRED", "Expired"), ("DISCARDED", "Discarded"),
           ("ISSUED", "Issued"), ("TRANSFUSED", "Transfused"))


def inventory_view(as_of: str) -> tuple[list[str], list[str]]:
    final = " ".join(f"WHEN c.status = '{a}' THEN '{b}'" for a, b in _STATUS)
    body = (
        "inventorySummaryView AS (SELECT dn.donationIdentificationNumber, ct.componentTypeName, c.componentCode, "
        "c.createdOn, bl.name AS processedAtLocation, cur.name AS currentLocation, "
        f"CASE WHEN date_sub('day', c.expiresOn, TIMESTAMP '{as_of} 00:00:00') > 0 THEN 'EXPIRED' "
        "ELSE 'NOT EXPIRED' END AS expiryStatus, c.status AS componentStatus, c.inventoryStatus, "
        f"rf.status AS returnStatus, CASE {final} ELSE 'Other States' END AS finalComponentStatus "
        "FROM Component c LEFT JOIN Donation dn ON c.donation_id = dn.id "
        "LEFT JOIN ComponentType ct ON c.componentType_id = ct.id "
        "LEFT JOIN ComponentType pct ON c.parentComponent_id = pct.id "
        "LEFT JOIN Location cur ON c.location_id = cur.id "
        "LEFT JOIN ComponentBatch cb ON c.componentBatch_id = cb.id "
        "LEFT JOIN componentBatchLocationView bl ON c.componentBatch_id = bl.id "
        "LEFT JOIN ReturnForm_Component rfc ON c.id = rfc.component_id "
        "LEFT JOIN ReturnForm rf ON rfc.returnForm_id = rf.id "
        "WHERE NOT c.isDeleted)"
    )
    return [BATCH_LOCATION, body], ["Component", "Donation", "ComponentType", "Location", "ComponentBatch",
                                    "ReturnForm_Component", "ReturnForm"]


def deferral_view(as_of: str) -> tuple[list[str], list[str]]:
    age = age_sql("dr.birthDate", as_of)
    body = (
        f"deferralSummaryView AS (SELECT dr.donorNumber, dr.gender, {band_sql(age)} AS ageGroup, dd.deferralDate, "
        "rs.reason, loc.name AS venue FROM DonorDeferral dd "
        "LEFT JOIN DeferralReason rs ON dd.deferralReason_id = rs.id "
        "LEFT JOIN Location loc ON dd.venue_id = loc.id LEFT JOIN Donor dr ON dd.deferredDonor_id = dr.id "
        "WHERE NOT dd.isVoided AND NOT dr.isDeleted)"
    )
    return [body], ["DonorDeferral", "DeferralReason", "Location", "Donor"]


def discard_view() -> tuple[list[str], list[str]]:
    body = (
        "discardSummaryView AS (SELECT sc.statusChangedOn, rs.statusChangeReason, ct.componentTypeName, "
        "bl.name AS processedAtLocation FROM ComponentStatusChange sc "
        "LEFT JOIN Component c ON sc.component_id = c.id "
        "LEFT JOIN ComponentType ct ON c.componentType_id = ct.id "
        "LEFT JOIN ComponentStatusChangeReason rs ON sc.statusChangeReason_id = rs.id "
        "LEFT JOIN ComponentBatch cb ON c.componentBatch_id = cb.id "
        "LEFT JOIN componentBatchLocationView bl ON c.componentBatch_id = bl.id "
        "WHERE sc.newStatus = 'DISCARDED' AND NOT c.isDeleted AND NOT sc.isDeleted)"
    )
    return [BATCH_LOCATION, body], ["ComponentStatusChange", "Component", "ComponentType",
                                    "ComponentStatusChangeReason", "ComponentBatch", "Location"]


def issued_view(rel: Release) -> tuple[list[str], list[str]]:
    live = " AND NOT c.isDeleted" if rel.issued_live_component else ""
    body = (
        "issuedSummaryView AS (SELECT o.id AS orderId, CASE WHEN o.status = 'CREATED' THEN 'Order not Dispatched' "
        "WHEN o.status = 'DISPATCHED' THEN 'Issued' ELSE 'Unknown' END AS orderStatus, o.orderDate, "
        "dest.name AS dispatchedTo, ct.componentTypeName FROM OrderForm_Component oc "
        "LEFT JOIN OrderForm o ON oc.orderForm_id = o.id LEFT JOIN Component c ON oc.component_id = c.id "
        "LEFT JOIN ComponentType ct ON c.componentType_id = ct.id "
        "LEFT JOIN Location dest ON o.dispatchedTo_id = dest.id "
        f"WHERE NOT o.isDeleted AND o.type = 'ISSUE' AND o.status = 'DISPATCHED'{live})"
    )
    return [body], ["OrderForm_Component", "OrderForm", "Component", "ComponentType", "Location"]


def view_sql(view: str, as_of: str, release: str = "1.4.0", **options) -> tuple[list[str], list[str]]:
    rel = RELEASES[release]
    if view == "donationSummaryView":
        return donation_view(as_of, rel)
    if view == "testingSummaryView":
        return testing_view(as_of, rel, **options)
    if view == "componentBatchLocationView":
        return batch_location_view()
    if view == "inventorySummaryView":
        return inventory_view(as_of)
    if view == "deferralSummaryView":
        return deferral_view(as_of)
    if view == "discardSummaryView":
        return discard_view()
    if view == "issuedSummaryView":
        return issued_view(rel)
    raise KeyError(view)
