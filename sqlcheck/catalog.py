"""DuckDB SQL for each registered query, by its name.

Nothing of the engine is imported: groups, measures, periods, labels and
members are written out here.
"""

from __future__ import annotations

from sqlcheck import crosstab_query, period_sql, rollup_sql, view_query, with_ctes
from sqlcheck import reports as S
from sqlcheck.fixtures import ODD_LABELS
from sqlcheck.views import RELEASES, age_sql, band_sql, coinfection_case, test_ctes, test_joins, view_sql

VIEW_QUERIES = {
    "view_donation_summary": "donationSummaryView",
    "view_batch_location": "componentBatchLocationView",
    "view_inventory_summary": "inventorySummaryView",
    "view_deferral_summary": "deferralSummaryView",
    "view_discard_summary": "discardSummaryView",
    "view_issued_summary": "issuedSummaryView",
    "view_testing_summary": "testingSummaryView",
}


def _crosstab(name: str, release: str = "1.4.0") -> str:
    view, date, kind, rows, cols, measure = S.CROSSTABS[name]
    return crosstab_query(view, rows, cols, measure, date, kind, *S.period(name), S.as_of(view), release)


def _wide(name: str, members: list[tuple[str, str]], override: dict | None = None) -> str:
    """One sum for each (column name, condition on the long form)."""
    view, date, kind, rows, cols, measure = S.CROSSTABS[name]
    quote = lambda c: '"' + c.replace('"', '""') + '"'
    cells = ", ".join(f"CAST(coalesce(sum(CASE WHEN {cond} THEN n END), 0) AS BIGINT) AS {quote(c)}" for c, cond in members)
    keys = ", ".join(rows + [f"g_{r}" for r in rows])
    long = rollup_sql(view, date, kind, rows, cols, measure, *S.period(name))
    return view_query(view, S.as_of(view), select=f"SELECT {keys}, {cells} FROM ({long}) r GROUP BY {keys}", override=override)


def _band_members(genders: tuple) -> list[tuple[str, str]]:
    out = [("Total", "g_gender = 1")]
    for g in genders:
        is_g = "g_gender = 0 AND gender IS NULL" if g is None else f"gender = '{g}'"
        shown = "(null)" if g is None else g
        out.append((f"{shown}|Total", f"{is_g} AND g_ageGroup = 1"))
        out += [(f"{shown}|{b}", f"{is_g} AND ageGroup = '{b}'") for b in S.BANDS]
    return out


def _reason_members(reasons: list[tuple[str, str]]) -> list[tuple[str, str]]:
    return ([(shown, f"statusChangeReason = '{r}'") for shown, r in reasons]
            + [("(null)", "g_statusChangeReason = 0 AND statusChangeReason IS NULL"), ("Total", "g_statusChangeReason = 1")])


def _labels_discard() -> str:
    view, date, kind, rows, cols, measure = S.CROSSTABS["discard_by_site"]
    totals = {"processedAtLocation": "Total (All Sites)", "componentTypeName": "Total", "statusChangeReason": "Total"}
    labels = "".join(f", CASE WHEN GROUPING({k}) = 1 THEN '{t}' ELSE {k} END AS {k}_label" for k, t in totals.items())
    return view_query(view, S.as_of(view), select=rollup_sql(view, date, kind, rows, cols, measure, *S.LONG, extra=labels))


def _order_donation() -> str:
    """Report order: members ascending (gender descending), nulls after them, totals last."""
    view, date, kind, rows, cols, measure = S.CROSSTABS["donation_by_site"]
    order = ", ".join(f"g_{k}, {k} {'DESC' if k == 'gender' else 'ASC'} NULLS LAST" for k in rows + cols)
    long = rollup_sql(view, date, kind, rows, cols, measure, *S.LONG)
    return view_query(view, S.as_of(view), select=f"SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS INTEGER) AS place FROM ({long}) r")


def _order_views() -> str:
    """How many different sort keys precede each row's, per view with an order."""
    ctes: list[str] = []
    tables: list[str] = []
    parts = []
    for view, keys in (("donationSummaryView", ["donationDate"]), ("testingSummaryView", ["donationDate"]),
                       ("inventorySummaryView", ["donationIdentificationNumber", "componentCode"]),
                       ("deferralSummaryView", ["deferralDate"]), ("issuedSummaryView", ["orderId"])):
        more, needed = view_sql(view, S.as_of(view))
        ctes += [c for c in more if c not in ctes]
        tables += needed
        key = " || '/' || ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys)
        order = ", ".join(f"{k} NULLS FIRST" for k in keys)
        parts.append(f"SELECT '{view}' AS view, {key} AS sort_key, CAST(dense_rank() OVER (ORDER BY {order}) AS INTEGER) AS place, "
                     f"count(*) AS n FROM {view} GROUP BY {', '.join(keys)}")
    return with_ctes(list(dict.fromkeys(tables)), ctes, "\nUNION ALL\n".join(parts))


def _batch(names: list[str], period: dict | None = None, as_of: str = S.AGES_ON) -> str:
    """UNION ALL of the direct rollups of every crosstab of the reports."""
    ctes: list[str] = []
    tables: list[str] = []
    for view in dict.fromkeys(S.REPORTS[n][0][0] for n in names):
        more, needed = view_sql(view, as_of)
        ctes += [c for c in more if c not in ctes]
        tables += needed
    keys = list(dict.fromkeys(k for n in names for xt in S.REPORTS[n] for k in xt[3] + xt[4]))
    parts = []
    for n in names:
        start, end = (period or {}).get(n) or S.MONTH if period is not None else S.period(n)
        for part, (view, date, kind, rows, cols, measure) in zip(("all", "by_site"), S.REPORTS[n]):
            picks = ", ".join(f"{k}, CAST(GROUPING({k}) AS INTEGER) AS g_{k}" if k in rows + cols
                              else f"CAST(NULL AS VARCHAR) AS {k}, CAST(NULL AS INTEGER) AS g_{k}" for k in keys)
            parts.append(f"SELECT '{n}' AS report, '{n}_{part}' AS crosstab, {picks}, CAST(count({measure}) AS BIGINT) AS n "
                         f"FROM {view} WHERE {period_sql(date, kind, start, end)} "
                         f"GROUP BY ROLLUP({', '.join(rows)}), ROLLUP({', '.join(cols)})")
    return with_ctes(list(dict.fromkeys(tables)), ctes, "\nUNION ALL\n".join(parts))


DONATION_REPORTS = ["bloodGrouping", "donation", "donorCounselling", "hbvPrevalence", "hcvPrevalence", "hivPrevalence",
                    "syphilisPrevalence", "ttiCoinfection"]


def _sql_form(release: str) -> str:
    return view_query("donationSummaryView", S.AGES_ON, release, select=(
        f"SELECT {S.DONATION_FIELDS} FROM donationSummaryView WHERE {period_sql('donationDate', 'date', *S.MONTH, release)}"))


def _operators() -> dict[str, str]:
    rel = RELEASES["1.4.0"]
    age = age_sql("birthDate", S.AGES_ON)
    out = {
        "expr_age": with_ctes(["Donor"], [], f"SELECT id, birthDate, {age} AS age FROM Donor"),
        "expr_age_band": with_ctes(["Donor"], [], f"SELECT ageGroup, count(*) AS n FROM "
                                   f"(SELECT {band_sql(age)} AS ageGroup FROM Donor) q GROUP BY ageGroup"),
        "expr_blood_type": with_ctes(["Donation"], [], (
            "SELECT id, bloodAbo || bloodRh AS bloodType, CASE "
            + " ".join(f"WHEN bloodAbo || bloodRh = '{g}' AND bloodTypingMatchStatus IN ('MATCH','RESOLVED') "
                       f"THEN ' {g}'" for g in ("O+", "O-", "A+", "A-", "B+", "B-", "AB+", "AB-"))
            + " WHEN bloodTypingMatchStatus = 'NO_TYPE_DETERMINED' THEN 'No Type Determined' ELSE 'Unknown' END "
            "AS bloodGrouping FROM Donation")),
        "expr_expiry": with_ctes(["Component"], [], (
            f"SELECT id, expiresOn, CASE WHEN date_sub('day', expiresOn, TIMESTAMP '{S.EXPIRY_ON} 00:00:00') > 0 "
            "THEN 'EXPIRED' ELSE 'NOT EXPIRED' END AS expiryStatus FROM Component")),
        "test_flags": with_ctes(["BloodTestResult"], [], (
            "SELECT donation_id, "
            "bool_or(CASE WHEN bloodTest_id IN (0, 1) THEN result = 'POS' END) AS hiv_pos, "
            "bool_or(CASE WHEN bloodTest_id IN (2, 3) THEN result = 'POS' END) AS hbv_pos, "
            "bool_or(CASE WHEN bloodTest_id IN (4, 5) THEN result = 'POS' END) AS hcv_pos, "
            "bool_or(CASE WHEN bloodTest_id IN (6, 7) THEN result = 'POS' END) AS syphilis_pos "
            "FROM BloodTestResult WHERE NOT isDeleted AND bloodTest_id BETWEEN 0 AND 7 GROUP BY donation_id")),
        "dedupe_counselling": with_ctes(["PostDonationCounselling"], [], (
            "SELECT donation_id, counsellingDate, flaggedForCounselling, counsellingStatus FROM "
            "(SELECT *, row_number() OVER (PARTITION BY donation_id ORDER BY counsellingDate DESC NULLS LAST, "
            "id DESC) AS rn FROM PostDonationCounselling) q WHERE rn = 1")),
    }
    out["expr_coinfection"] = with_ctes(
        ["Donation", "BloodTestResult"], test_ctes(rel),
        f"SELECT d.id, {coinfection_case(rel)} AS ttiCoinfection, "
        f"{coinfection_case(rel, strict_gate=True)} AS ttiCoinfectionStrict FROM Donation d " + test_joins("d"))
    out["dedupe_donation"] = view_query("testingSummaryView", S.AGES_ON,
                                        select="SELECT donationIdentificationNumber, id FROM v7_one")
    start, end = S.LONG
    out["period_closed"] = view_query(
        "donationSummaryView", S.AGES_ON,
        select=f"SELECT donationDate, count(*) AS n FROM donationSummaryView "
               f"WHERE {period_sql('donationDate', 'date', start, end)} GROUP BY donationDate")
    ds, de = S.LONG
    out["period_plus_one_day"] = view_query(
        "discardSummaryView", S.AGES_ON,
        select=f"SELECT statusChangedOn, count(*) AS n FROM discardSummaryView "
               f"WHERE {period_sql('statusChangedOn', 'timestamp', ds, de)} GROUP BY statusChangedOn")
    reasons = [(r, r) for r in ("Expired", "Broken pack", "Unsafe test", "Leaking")]
    odd = [("Expired", "Expired"), ('"Total"', "Total"), ('""', ""), ("Leaking", "Leaking")]
    out["xt_wide_donation"] = _wide("donation_by_site", _band_members(("male", "female", None)))
    out["xt_wide_discard"] = _wide("discard_by_site", _reason_members(reasons))
    out["xt_wide_donation_odd_labels"] = _wide("donation_by_site", _band_members(("male", "female", "other", None)), ODD_LABELS)
    out["xt_wide_discard_odd_labels"] = _wide("discard_by_site", _reason_members(odd), ODD_LABELS)
    out["xt_labels_discard"] = _labels_discard()
    out["report_batch_donation_views"] = _batch(DONATION_REPORTS)
    month = _batch([n for n in S.REPORTS], {"deferral": S.DEFERRALS})
    out["report_batch_month"] = out["report_batch_month_stored"] = out["sink_round_trip"] = month
    periods = {n: S.ODD_YEARS for n in S.REPORTS} | {"deferral": S.ODD_DEFERRALS}
    out["report_years_from_months"] = _batch([n for n in S.REPORTS], periods, S.YEARS_AGES_ON)
    out["report_years_after_update"] = _batch(DONATION_REPORTS, periods, S.YEARS_AGES_ON)
    out["base_updated_donation"] = view_query("donationSummaryView", S.AGES_ON)
    out["base_updated_testing"] = view_query("testingSummaryView", S.AGES_ON)
    out["order_donation_by_site"] = _order_donation()
    out["order_views"] = _order_views()
    out["sql_form_100"], out["sql_form_140"] = _sql_form("1.0.0"), _sql_form("1.4.0")
    out["sql_views"] = " UNION ALL ".join(
        f"SELECT '{v}' AS view, n FROM ({view_query(v, S.as_of(v), select=f'SELECT count(*) AS n FROM {v}')}) q{i}"
        for i, v in enumerate(VIEW_QUERIES.values()))
    out["sql_views_stored"] = out["sql_views"]
    out["report_metadata"] = (
        "SELECT *, CASE report WHEN 'donation' THEN 'Donation Summary Report' ELSE 'Discard Summary Report' END AS title, "
        "'Date Period:  1997-03-01  to  1997-03-31' AS period, '17:05' AS run_time, 'March 09, 1998' AS run_date "
        f"FROM ({_batch(['donation', 'discard'], {})}) q")
    out["expr_age_before_birth"] = with_ctes(["Donor"], [], f"SELECT id, {age_sql('birthDate', '1960-02-29')} AS age FROM Donor")
    out["sink_published"] = out["report_batch_month_colocated"] = month
    return out


# Decimals and timestamps print alike in both engines but come as different types.
TEXT_COLUMNS = {
    "view_donation_summary": ("bleedStartTime", "bleedEndTime", "donorWeight", "haemoglobinCount"),
    "view_testing_summary": ("bleedStartTime", "bleedEndTime"),
    "base_updated_donation": ("bleedStartTime", "bleedEndTime", "donorWeight", "haemoglobinCount"),
    "base_updated_testing": ("bleedStartTime", "bleedEndTime"),
    "sql_form_100": ("bleedStartTime", "bleedEndTime", "donorWeight", "haemoglobinCount"),
    "sql_form_140": ("bleedStartTime", "bleedEndTime", "donorWeight", "haemoglobinCount"),
    "view_inventory_summary": ("createdOn",), "view_deferral_summary": ("deferralDate",),
    "view_discard_summary": ("statusChangedOn",), "view_issued_summary": ("orderDate",),
    "expr_expiry": ("expiresOn",), "period_plus_one_day": ("statusChangedOn",),
}


def oracle_sql(text: bool = True) -> dict[str, str]:
    """SQL per registered query; ``text`` renders decimals and timestamps as text."""
    out = {name: view_query(view, S.as_of(view)) for name, view in VIEW_QUERIES.items()}
    out |= {f"xt_{name}": _crosstab(name) for name in S.CROSSTABS}
    out["profile_100_donation"] = _crosstab("donorCounselling_by_site", "1.0.0")
    out["profile_130_donation"] = _crosstab("donorCounselling_by_site", "1.3.0")
    out["profile_100_hiv"] = _crosstab("hivPrevalence_by_site", "1.0.0")
    out["profile_130_hiv"] = _crosstab("hivPrevalence_by_site", "1.3.0")
    out["profile_100_issued"] = _crosstab("componentsIssued_by_site", "1.0.0")
    out["profile_140_binary_ids"] = _crosstab("ttiCoinfection_by_site", "1.4.0-binary")
    out.update(_operators())
    if text:
        for name, cols in TEXT_COLUMNS.items():
            out[name] = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in cols)}) FROM ({out[name]}) q"
    return out
