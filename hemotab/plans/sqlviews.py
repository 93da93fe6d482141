"""The seven views as SQL text in the catalog.

``views.register_views`` makes session views over DataFrames; these are
``CREATE OR REPLACE VIEW`` statements over a database's source tables, so that
they outlive the session and serve SQL users and other tools.  They give the
same rows as the functions of ``plans.views``: one row per donation number by
the least id, one aggregate over the test results instead of a join per test,
the latest counselling per donation.  A column that a query doesn't use is
pruned with the join or aggregate behind it where that can't change rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from hemotab.functions import labels as L
from hemotab.plans import views as V
from hemotab.profile import DEFAULT_PROFILE, DISEASES, Profile


def _text(value) -> str:
    if isinstance(value, bytes):
        return f"X'{value.hex()}'"
    return str(value) if isinstance(value, int) else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _cases(column: str, labels, otherwise: str) -> str:
    rows = " ".join(f"WHEN {column} = {_text(k)} THEN {_text(v)}" for k, v in labels.items())
    return f"CASE {rows} ELSE {_text(otherwise)} END"


def _age(birth: str, day: str) -> str:
    b, d = (f"(month({x}) * 100 + day({x}))" for x in (birth, day))
    return (f"CAST(year({day}) - year({birth}) - CASE WHEN {birth} <= {day} AND {d} < {b} THEN 1 "
            f"WHEN {birth} > {day} AND {b} < {d} THEN -1 ELSE 0 END AS BIGINT)")


def _band(age: str) -> str:
    rows = " ".join(f"WHEN {age} BETWEEN {lo} AND {hi} THEN {_text(label)}" for label, lo, hi in L.AGE_BANDS)
    return f"CASE {rows} ELSE {_text(L.AGE_OTHER)} END"


def _flags(profile: Profile, diseases) -> str:
    deleted = "WHERE NOT isDeleted" if profile.tests_exclude_deleted else ""
    flags = ", ".join(f"bool_or(CASE WHEN bloodTest_id IN ({', '.join(map(_text, profile.repeat_ids(d)))}) "
                      f"THEN result = {_text(L.POSITIVE)} END) AS {d}_pos" for d in diseases)
    return f"SELECT donation_id, {flags} FROM BloodTestResult {deleted} GROUP BY donation_id"


def _chosen() -> str:
    return ("SELECT min(d.id) AS id FROM Donation d JOIN PackType p ON d.packType_id = p.id AND p.countAsDonation "
            f"JOIN Donor r ON d.donor_id = r.id AND NOT r.isDeleted AND r.donorStatus <> {_text(L.MERGED)} "
            "WHERE NOT d.isDeleted GROUP BY d.donationIdentificationNumber")


_LABELS = ("LEFT SEMI JOIN ({chosen}) o ON d.id = o.id JOIN Donor r ON d.donor_id = r.id JOIN PackType p ON d.packType_id = p.id "
           "LEFT JOIN Location v ON d.venue_id = v.id LEFT JOIN DonationType t ON d.donationType_id = t.id")


def _donation_columns(day: str) -> dict[str, str]:
    age = _age("r.birthDate", day)
    return {"donorNumber": "r.donorNumber", "gender": "r.gender", "age": age, "ageGroup": _band(age), "venue": "v.name",
            "donationType": "t.donationType", "packType": "p.packType", "bloodType": "concat(d.bloodAbo, d.bloodRh)"}


def _listed(columns, exprs: dict[str, str], default: str) -> str:
    return ", ".join(f"{exprs.get(c, f'{default}.{c}')} AS {c}" for c in columns)


def _donation(profile: Profile, day: str) -> str:
    unsafe, safe = (f"d.ttiStatus = {_text(x)} AND d.released" for x in (profile.tti_unsafe, profile.tti_safe))
    exprs = _donation_columns(day) | {
        "flaggedForCounselling": "c.pick.flaggedForCounselling", "counsellingStatus": "c.pick.counsellingStatus",
        "counsellingDate": "c.pick.counsellingDate",
        "donorCounsellingStatus": _cases("c.pick.counsellingStatus", L.COUNSELLING, L.NOT_COUNSELLED),
        "ttiReactiveStatus": f"CASE WHEN {unsafe} AND f.hiv_pos THEN {_text(L.TTI_REACTIVE_HIV)} WHEN {unsafe} THEN {_text(L.TTI_REACTIVE_OTHER)} "
                             f"WHEN {safe} THEN {_text(L.TTI_UNREACTIVE)} ELSE {_text(L.UNKNOWN)} END",
    }
    latest = ("SELECT donation_id, max(struct(counsellingDate, id, flaggedForCounselling, counsellingStatus)) AS pick "
              "FROM PostDonationCounselling GROUP BY donation_id")
    return (f"SELECT {_listed(V.DONATION_COLUMNS, exprs, 'd')} FROM Donation d {_LABELS.format(chosen=_chosen())} "
            f"LEFT JOIN ({latest}) c ON c.donation_id = d.id LEFT JOIN ({_flags(profile, ('hiv',))}) f ON f.donation_id = d.id")


def _testing(profile: Profile, day: str) -> str:
    gate = f"d.ttiStatus = {_text(profile.tti_unsafe)} AND d.released"
    blood = "concat(d.bloodAbo, d.bloodRh)"
    typed = (f"{blood} IN ({', '.join(map(_text, L.BLOOD_TYPES))}) "
             f"AND d.bloodTypingMatchStatus IN ({', '.join(map(_text, L.TYPED_MATCH_STATUSES))})")
    infections = " ".join(f"WHEN {gate} AND {' AND '.join(f'f.{d}_pos' for d in of)} THEN {_text(label)}" for of, label in L.COINFECTION_HIV)
    exprs = _donation_columns(day) | {
        f"{d}Prevalence": f"CASE WHEN f.{d}_pos AND {gate} THEN {_text(f'Reactive for {L.DISEASE_LABEL[d]}')} "
                          f"WHEN d.released THEN {_text(f'Not Reactive for {L.DISEASE_LABEL[d]}')} ELSE {_text(L.UNKNOWN)} END" for d in DISEASES}
    exprs |= {
        "bloodGrouping": f"CASE WHEN {typed} THEN concat(' ', {blood}) WHEN d.bloodTypingMatchStatus = {_text(L.NO_TYPE_DETERMINED_STATUS)} "
                         f"THEN {_text(L.NO_TYPE_DETERMINED)} ELSE {_text(L.UNKNOWN)} END",
        "ttiCoinfection": f"CASE {infections} WHEN f.hbv_pos OR f.hcv_pos OR (f.syphilis_pos AND {gate}) THEN {_text(L.OTHER_TTIS)} "
                          f"WHEN d.released THEN {_text(L.NO_TTIS)} ELSE {_text(L.UNKNOWN)} END",
    }
    return (f"SELECT {_listed(V.TESTING_COLUMNS, exprs, 'd')} FROM Donation d {_LABELS.format(chosen=_chosen())} "
            f"LEFT JOIN ({_flags(profile, DISEASES)}) f ON f.donation_id = d.id")


_BATCHES = "SELECT b.id, l.name FROM ComponentBatch b JOIN Location l ON b.location_id = l.id"


def _inventory(profile: Profile, day: str) -> str:
    exprs = {
        "donationIdentificationNumber": "d.donationIdentificationNumber", "componentTypeName": "t.componentTypeName",
        "processedAtLocation": "b.name", "currentLocation": "l.name", "componentStatus": "c.status", "returnStatus": "r.status",
        "expiryStatus": f"CASE WHEN c.expiresOn + INTERVAL 1 DAY <= CAST({day} AS TIMESTAMP_NTZ) THEN {_text(L.EXPIRED)} ELSE {_text(L.NOT_EXPIRED)} END",
        "finalComponentStatus": _cases("c.status", L.COMPONENT_STATUS, L.OTHER_STATES),
    }
    return (f"SELECT {_listed(V.INVENTORY_COLUMNS, exprs, 'c')} FROM Component c LEFT JOIN Donation d ON c.donation_id = d.id "
            "LEFT JOIN ComponentType t ON c.componentType_id = t.id LEFT JOIN Location l ON c.location_id = l.id "
            f"LEFT JOIN ({_BATCHES}) b ON c.componentBatch_id = b.id LEFT JOIN ReturnForm_Component rc ON c.id = rc.component_id "
            "LEFT JOIN ReturnForm r ON rc.returnForm_id = r.id WHERE NOT c.isDeleted")


def _deferral(profile: Profile, day: str) -> str:
    exprs = {"donorNumber": "r.donorNumber", "gender": "r.gender", "ageGroup": _band(_age("r.birthDate", day)), "reason": "q.reason", "venue": "l.name"}
    return (f"SELECT {_listed(V.DEFERRAL_COLUMNS, exprs, 'd')} FROM DonorDeferral d JOIN Donor r ON d.deferredDonor_id = r.id AND NOT r.isDeleted "
            "LEFT JOIN DeferralReason q ON d.deferralReason_id = q.id LEFT JOIN Location l ON d.venue_id = l.id WHERE NOT d.isVoided")


def _discard(profile: Profile, day: str) -> str:
    exprs = {"statusChangeReason": "q.statusChangeReason", "componentTypeName": "t.componentTypeName", "processedAtLocation": "b.name"}
    return (f"SELECT {_listed(V.DISCARD_COLUMNS, exprs, 's')} FROM ComponentStatusChange s JOIN Component c ON s.component_id = c.id AND NOT c.isDeleted "
            "LEFT JOIN ComponentType t ON c.componentType_id = t.id "
            f"LEFT JOIN ComponentStatusChangeReason q ON s.statusChangeReason_id = q.id LEFT JOIN ({_BATCHES}) b ON c.componentBatch_id = b.id "
            f"WHERE s.newStatus = {_text(L.DISCARDED)} AND NOT s.isDeleted")


def _issued(profile: Profile, day: str) -> str:
    exprs = {"orderId": "o.id", "orderStatus": _cases("o.status", L.ORDER_STATUS, L.UNKNOWN), "dispatchedTo": "l.name",
             "componentTypeName": "t.componentTypeName"}
    components = "JOIN Component c ON x.component_id = c.id AND NOT c.isDeleted" if profile.issued_requires_live_component \
        else "LEFT JOIN Component c ON x.component_id = c.id"
    return (f"SELECT {_listed(V.ISSUED_COLUMNS, exprs, 'o')} FROM OrderForm_Component x JOIN OrderForm o ON x.orderForm_id = o.id {components} "
            "LEFT JOIN ComponentType t ON c.componentType_id = t.id LEFT JOIN Location l ON o.dispatchedTo_id = l.id "
            f"WHERE NOT o.isDeleted AND o.type = {_text(L.ISSUE_ORDER_TYPE)} AND o.status = {_text(L.DISPATCHED)}")


_BODIES = {
    "donationSummaryView": _donation, "componentBatchLocationView": lambda profile, day: _BATCHES, "inventorySummaryView": _inventory,
    "deferralSummaryView": _deferral, "discardSummaryView": _discard, "issuedSummaryView": _issued, "testingSummaryView": _testing,
}


def create_views(spark: SparkSession, database: str, profile: Profile = DEFAULT_PROFILE, as_of: dt.date | str | None = None) -> None:
    """Creates (or replaces) the views in ``database``, which holds the source
    tables.  ``as_of`` fixes the reporting date; without it, it is the day of the query."""
    day = "current_date()" if as_of is None else f"DATE'{dt.date.fromisoformat(str(as_of))}'"
    held = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database)   # table names in the bodies belong to it, now and later
    try:
        for name, body in _BODIES.items():
            spark.sql(f"CREATE OR REPLACE VIEW {name} AS {body(profile, day)}")
    finally:
        spark.catalog.setCurrentDatabase(held)
