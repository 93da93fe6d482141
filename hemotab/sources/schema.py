"""Explicit schemas of the 18 source tables (no inference at read time)."""

from __future__ import annotations

from pyspark.sql import types as T

L = T.LongType()
S = T.StringType()
B = T.BooleanType()
D = T.DateType()
TS = T.TimestampNTZType()
I = T.IntegerType()
DEC = T.DecimalType(10, 2)


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


def schemas(test_id_type: T.DataType = T.BinaryType()) -> dict[str, T.StructType]:
    """Source-table schemas; ``test_id_type`` is binary in 1.4.0, bigint before."""
    return {
        "Donation": _struct(
            ("id", L), ("donationIdentificationNumber", S), ("donor_id", L),
            ("venue_id", L), ("donationType_id", L), ("packType_id", L),
            ("donationDate", D), ("bloodAbo", S), ("bloodRh", S),
            ("bloodTypingMatchStatus", S), ("ttiStatus", S), ("bloodTypingStatus", S),
            ("bleedStartTime", TS), ("bleedEndTime", TS), ("donorWeight", DEC),
            ("haemoglobinCount", DEC), ("haemoglobinLevel", S), ("donorPulse", I),
            ("bloodPressureSystolic", I), ("bloodPressureDiastolic", I),
            ("adverseEvent_id", L), ("ineligibleDonor", B), ("released", B),
            ("isDeleted", B),
        ),
        "Donor": _struct(
            ("id", L), ("donorNumber", S), ("gender", S), ("birthDate", D),
            ("isDeleted", B), ("donorStatus", S),
        ),
        "Location": _struct(("id", L), ("name", S)),
        "DonationType": _struct(("id", L), ("donationType", S)),
        "PackType": _struct(("id", L), ("packType", S), ("countAsDonation", B)),
        "PostDonationCounselling": _struct(
            ("id", L), ("donation_id", L), ("counsellingStatus", S),
            ("flaggedForCounselling", B), ("counsellingDate", D),
        ),
        "BloodTestResult": _struct(
            ("donation_id", L), ("bloodTest_id", test_id_type), ("result", S),
            ("isDeleted", B),
        ),
        "ComponentType": _struct(("id", L), ("componentTypeName", S)),
        "ComponentBatch": _struct(("id", L), ("location_id", L)),
        "Component": _struct(
            ("id", L), ("donation_id", L), ("componentType_id", L),
            ("parentComponent_id", L), ("location_id", L), ("componentBatch_id", L),
            ("componentCode", S), ("createdOn", TS), ("expiresOn", TS), ("status", S),
            ("inventoryStatus", S), ("isDeleted", B),
        ),
        "ReturnForm": _struct(("id", L), ("status", S)),
        "ReturnForm_Component": _struct(("component_id", L), ("returnForm_id", L)),
        "DeferralReason": _struct(("id", L), ("reason", S)),
        "DonorDeferral": _struct(
            ("id", L), ("deferredDonor_id", L), ("venue_id", L),
            ("deferralReason_id", L), ("deferralDate", TS), ("isVoided", B),
        ),
        "ComponentStatusChangeReason": _struct(("id", L), ("statusChangeReason", S)),
        "ComponentStatusChange": _struct(
            ("component_id", L), ("newStatus", S), ("statusChangeReason_id", L),
            ("statusChangedOn", TS), ("isDeleted", B),
        ),
        "OrderForm": _struct(
            ("id", L), ("status", S), ("orderDate", TS), ("dispatchedTo_id", L),
            ("type", S), ("isDeleted", B),
        ),
        "OrderForm_Component": _struct(("orderForm_id", L), ("component_id", L)),
    }


TABLE_NAMES = tuple(schemas().keys())

# Tables whose size is bounded by the domain (code lists, sites), not by
# the volume of activity.
DIMENSIONS = (
    "Location",
    "DonationType",
    "PackType",
    "ComponentType",
    "DeferralReason",
    "ComponentStatusChangeReason",
)
