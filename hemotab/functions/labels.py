"""Report labels.

# --- fixed values (must equal the reference's) -------------------------------
Every text below is printed in the reference's output and is kept as is,
including the leading space of the eight blood-group labels (it makes them
sort before the two text labels).
"""

# --- fixed values (must equal the reference's) -------------------------------
AGE_BANDS = (("16-25", 16, 25), ("26-35", 26, 35), ("36-50", 36, 50), ("51-65", 51, 65))
AGE_OTHER = "Other"

COUNSELLING = {"RECEIVED_COUNSELLING": "Counselled", "REFUSED_COUNSELLING": "Refused Counselling"}
NOT_COUNSELLED = "Not Counselled"

TTI_REACTIVE_HIV = "Reactive for HIV"
TTI_REACTIVE_OTHER = "Reactive for Other TTIs"
TTI_UNREACTIVE = "TTI Unreactive"
UNKNOWN = "Unknown"

COMPONENT_STATUS = {
    "PROCESSED": "Processed",
    "EXPIRED": "Expired",
    "DISCARDED": "Discarded",
    "ISSUED": "Issued",
    "TRANSFUSED": "Transfused",
}
OTHER_STATES = "Other States"

EXPIRED = "EXPIRED"
NOT_EXPIRED = "NOT EXPIRED"

ORDER_STATUS = {"CREATED": "Order not Dispatched", "DISPATCHED": "Issued"}
ISSUE_ORDER_TYPE = "ISSUE"
DISPATCHED = "DISPATCHED"
DISCARDED = "DISCARDED"
MERGED = "MERGED"
POSITIVE = "POS"

BLOOD_TYPES = ("O+", "O-", "A+", "A-", "B+", "B-", "AB+", "AB-")
TYPED_MATCH_STATUSES = ("MATCH", "RESOLVED")
NO_TYPE_DETERMINED_STATUS = "NO_TYPE_DETERMINED"
NO_TYPE_DETERMINED = "No Type Determined"

DISEASE_LABEL = {"hiv": "HIV", "hbv": "HBV", "hcv": "HCV", "syphilis": "Syphilis"}
# Prevalence labels are "Reactive for <disease>" / "Not Reactive for <disease>".

COINFECTION_HIV = (
    (("hiv", "hbv", "hcv", "syphilis"), "HIV, HBV, HCV, Syphilis"),
    (("hiv", "hbv", "hcv"), "HIV, HBV, HCV"),
    (("hiv", "hbv", "syphilis"), "HIV, HBV, Syphilis"),
    (("hiv", "hcv", "syphilis"), "HIV, HCV, Syphilis"),
    (("hiv", "hbv"), "HIV, HBV"),
    (("hiv", "hcv"), "HIV, HCV"),
    (("hiv", "syphilis"), "HIV, Syphilis"),
    (("hiv",), "HIV"),
)
OTHER_TTIS = "Other TTIs (Excl. HIV)"
NO_TTIS = "No TTIs"

TOTAL = "Total"
TOTAL_ALL_VENUES = "Total (All Venues)"
TOTAL_ALL_SITES = "Total (All Sites)"
TOTAL_UNITS = "Total Units"

PERIOD_LABEL = ("Date Period:  ", "  to  ")
# --- end of fixed values -----------------------------------------------------
