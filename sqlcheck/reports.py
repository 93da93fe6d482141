"""The 24 crosstabs, written out a second time for the SQL route: view, date
field, kind of period, row groups, column groups, measure."""

from __future__ import annotations

BAND = ["gender", "ageGroup"]
DONATION = ("donationDate", "date")


def _donor(view: str, label: str, measure: str | None = None, before: tuple[str, ...] = ()):
    rows = [*before, label]
    measure = measure or label
    return ((view, *DONATION, rows, BAND, measure), (view, *DONATION, ["venue", *rows], BAND, measure))


def _site(view: str, date: str, site: str, col: str):
    return ((view, date, "timestamp", ["componentTypeName"], [col], "componentTypeName"),
            (view, date, "timestamp", [site, "componentTypeName"], [col], "componentTypeName"))


REPORTS = {
    "bloodGrouping": _donor("testingSummaryView", "bloodGrouping"),
    "component": _site("inventorySummaryView", "createdOn", "processedAtLocation", "finalComponentStatus"),
    "componentsIssued": _site("issuedSummaryView", "orderDate", "dispatchedTo", "orderStatus"),
    "deferral": (("deferralSummaryView", "deferralDate", "timestamp", ["reason"], BAND, "reason"),
                 ("deferralSummaryView", "deferralDate", "timestamp", ["venue", "reason"], BAND, "reason")),
    "discard": _site("discardSummaryView", "statusChangedOn", "processedAtLocation", "statusChangeReason"),
    "donation": _donor("donationSummaryView", "donationType"),
    "donorCounselling": _donor("donationSummaryView", "donorCounsellingStatus", before=("ttiReactiveStatus",)),
    "hbvPrevalence": _donor("testingSummaryView", "hbvPrevalence"),
    "hcvPrevalence": _donor("testingSummaryView", "hcvPrevalence"),
    "hivPrevalence": _donor("testingSummaryView", "hivPrevalence"),
    "syphilisPrevalence": _donor("testingSummaryView", "syphilisPrevalence"),
    "ttiCoinfection": _donor("testingSummaryView", "ttiCoinfection", "bloodGrouping"),
}
CROSSTABS = {f"{name}_{part}": xt for name, pair in REPORTS.items() for part, xt in zip(("all", "by_site"), pair)}

# Periods and reporting dates of the registered queries.
LONG = ("1996-01-01", "2000-12-31")
DEFERRALS = ("2024-01-02", "2024-01-29")
MONTH = ("1997-03-01", "1997-03-31")
ODD_YEARS, ODD_DEFERRALS, YEARS_AGES_ON = ("1996-01-15", "2000-12-10"), ("2023-12-15", "2024-02-10"), "2004-02-29"
AGES_ON, EXPIRY_ON = "2001-12-31", "1998-06-01"
BANDS = ("16-25", "26-35", "36-50", "51-65", "Other")
DONATION_FIELDS = ("donationIdentificationNumber, donorNumber, gender, age, ageGroup, donationDate, venue, donationType, packType, bloodType, "
                   "bleedStartTime, bleedEndTime, bloodTypingStatus, bloodTypingMatchStatus, ttiStatus, donorWeight, haemoglobinCount, "
                   "haemoglobinLevel, donorPulse, bloodPressureSystolic, bloodPressureDiastolic, adverseEvent_id, ineligibleDonor, released, "
                   "flaggedForCounselling, counsellingStatus, counsellingDate, donorCounsellingStatus, ttiReactiveStatus")


def as_of(view: str) -> str:
    return EXPIRY_ON if view == "inventorySummaryView" else AGES_ON


def period(name: str) -> tuple[str, str]:
    return DEFERRALS if name.startswith("deferral") else LONG
