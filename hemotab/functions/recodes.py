"""Column expressions of the views.

All of them are built-in Spark expressions (``when`` chains, ``concat``,
``timestamp_diff``): they run inside whole-stage codegen, no Python UDF.
Null handling follows SQL three-valued logic as in the reference: a
``when`` branch whose condition is null is not taken.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from hemotab.functions import labels as L
from hemotab.profile import DISEASES, Profile

DateLike = dt.date | str | Column | None


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_of_date(as_of: DateLike) -> Column:
    """The reporting date (``CURDATE()``); ``None`` means today."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def as_of_midnight(as_of: DateLike) -> Column:
    """Midnight at the start of the reporting date, as a timestamp without zone."""
    return as_of_date(as_of).cast("timestamp_ntz")


# --- P3, P4: age ---------------------------------------------------------------
def age_years(birth_date: str | Column, as_of: DateLike = None) -> Column:
    """Completed years from birth to ``as_of``, counted on anniversaries
    (``TIMESTAMPDIFF(YEAR, ..)`` on dates): a 29 February birth completes
    a year on 1 March, and a birth after the reporting date counts the completed
    years between them as negative (0 within the first).  Written on date parts
    (year difference, less one if the last year isn't complete) so that no
    timestamp cast, and hence no session time zone, is involved; the result is a
    bigint.
    """
    b, d = _col(birth_date), as_of_date(as_of)
    day_b, day_d = F.month(b) * 100 + F.dayofmonth(b), F.month(d) * 100 + F.dayofmonth(d)
    incomplete = F.when((b <= d) & (day_d < day_b), 1).when((b > d) & (day_b < day_d), -1).otherwise(0)
    return (F.year(d) - F.year(b) - incomplete).cast("long")


def age_band(age: str | Column) -> Column:
    a = _col(age)
    expr = None
    for label, lo, hi in L.AGE_BANDS:
        cond = a.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(L.AGE_OTHER)


# --- P5, P11: blood type and grouping --------------------------------------------
def blood_type(abo: str | Column = "bloodAbo", rh: str | Column = "bloodRh") -> Column:
    """ABO text followed by Rh text; null when either is null."""
    return F.concat(_col(abo), _col(rh))


def blood_grouping(btype: str | Column = "bloodType",
                   match_status: str | Column = "bloodTypingMatchStatus") -> Column:
    bt, ms = _col(btype), _col(match_status)
    typed = bt.isin(*L.BLOOD_TYPES) & ms.isin(*L.TYPED_MATCH_STATUSES)
    return (F.when(typed, F.concat(F.lit(" "), bt))
            .when(ms == L.NO_TYPE_DETERMINED_STATUS, L.NO_TYPE_DETERMINED)
            .otherwise(L.UNKNOWN))


# --- P6, P7: counselling and TTI status ------------------------------------------
def counselling_label(status: str | Column = "counsellingStatus") -> Column:
    s = _col(status)
    expr = None
    for code, label in L.COUNSELLING.items():
        expr = F.when(s == code, label) if expr is None else expr.when(s == code, label)
    return expr.otherwise(L.NOT_COUNSELLED)


def released_unsafe(profile: Profile, tti: str | Column = "ttiStatus",
                    released: str | Column = "released") -> Column:
    """G: TTI status unsafe and the donation released."""
    return (_col(tti) == profile.tti_unsafe) & _col(released)


def tti_reactive_status(profile: Profile, hiv_pos: str | Column = "hiv_pos",
                        tti: str | Column = "ttiStatus", released: str | Column = "released") -> Column:
    unsafe = (_col(tti) == profile.tti_unsafe) & _col(released)
    safe = (_col(tti) == profile.tti_safe) & _col(released)
    return (F.when(unsafe & _col(hiv_pos), L.TTI_REACTIVE_HIV)
            .when(unsafe, L.TTI_REACTIVE_OTHER)
            .when(safe, L.TTI_UNREACTIVE)
            .otherwise(L.UNKNOWN))


# --- P8, P9, P10: component and order --------------------------------------------
def component_status_label(status: str | Column = "status") -> Column:
    s = _col(status)
    expr = None
    for code, label in L.COMPONENT_STATUS.items():
        expr = F.when(s == code, label) if expr is None else expr.when(s == code, label)
    return expr.otherwise(L.OTHER_STATES)


def expiry_status(expires_on: str | Column = "expiresOn", as_of: DateLike = None) -> Column:
    """EXPIRED when at least one whole day lies between expiry and the
    reporting date's midnight; a null expiry is NOT EXPIRED.

    ``whole days > 0`` is the same as ``expiresOn + 1 day <= midnight``,
    a plain comparison Spark evaluates without a day count per row.
    """
    expired = (_col(expires_on) + F.expr("INTERVAL 1 DAY")) <= as_of_midnight(as_of)
    return F.when(expired, L.EXPIRED).otherwise(L.NOT_EXPIRED)


def order_status_label(status: str | Column = "status") -> Column:
    s = _col(status)
    expr = None
    for code, label in L.ORDER_STATUS.items():
        expr = F.when(s == code, label) if expr is None else expr.when(s == code, label)
    return expr.otherwise(L.UNKNOWN)


# --- P12-P16: prevalence and co-infection ----------------------------------------
def flag_col(disease: str) -> str:
    return f"{disease}_pos"


def prevalence(disease: str, profile: Profile, pos: str | Column | None = None,
               tti: str | Column = "ttiStatus", released: str | Column = "released") -> Column:
    name = L.DISEASE_LABEL[disease]
    p = _col(pos if pos is not None else flag_col(disease))
    return (F.when(p & released_unsafe(profile, tti, released), f"Reactive for {name}")
            .when(_col(released), f"Not Reactive for {name}")
            .otherwise(L.UNKNOWN))


def coinfection(profile: Profile, strict_gate: bool = False,
                tti: str | Column = "ttiStatus", released: str | Column = "released") -> Column:
    """TTI co-infection label, first matching row wins.

    The reference's ninth row reads ``B or C or (S and G)``: AND binds
    tighter than OR, so an unreleased HBV- or HCV-positive donation is
    "Other TTIs".  ``strict_gate=True`` applies the gate G to all three.
    """
    g = released_unsafe(profile, tti, released)
    pos = {d: F.col(flag_col(d)) for d in DISEASES}
    expr = None
    for diseases, label in L.COINFECTION_HIV:
        cond = g
        for d in diseases:
            cond = cond & pos[d]
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    if strict_gate:
        other = (pos["hbv"] | pos["hcv"] | pos["syphilis"]) & g
    else:
        other = pos["hbv"] | pos["hcv"] | (pos["syphilis"] & g)
    return (expr.when(other, L.OTHER_TTIS)
            .when(_col(released), L.NO_TTIS)
            .otherwise(L.UNKNOWN))
