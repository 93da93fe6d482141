"""Independent DuckDB SQL for every registered query (the correctness oracle)."""

from __future__ import annotations

import datetime as dt

from sqlcheck.fixtures import ctes as fixture_ctes
from sqlcheck.views import RELEASES, view_sql


def with_ctes(tables, ctes: list[str], select: str, release: str = "1.4.0", override: dict | None = None) -> str:
    return "WITH " + ",\n".join([*fixture_ctes(tables, release, override), *ctes]) + "\n" + select


def view_query(view: str, as_of: str, release: str = "1.4.0", select: str | None = None,
               override: dict | None = None, **options) -> str:
    ctes, tables = view_sql(view, as_of, release, **options)
    return with_ctes(tables, ctes, select or f"SELECT * FROM {view}", release, override)


def period_sql(field: str, kind: str, start: str, end: str, release: str = "1.4.0") -> str:
    if kind == "date":
        hi = f"DATE '{end}'"
        if RELEASES[release].donation_end_plus_one:
            hi = f"CAST(DATE '{end}' + INTERVAL 1 DAY AS DATE)"
        return f"{field} BETWEEN DATE '{start}' AND {hi}"
    nxt = dt.date.fromisoformat(end) + dt.timedelta(days=1)
    return f"{field} BETWEEN TIMESTAMP '{start} 00:00:00' AND TIMESTAMP '{nxt} 00:00:00'"


def rollup_sql(view: str, date_field: str, kind: str, rows: list[str], cols: list[str], measure: str,
               start: str, end: str, release: str = "1.4.0", extra: str = "") -> str:
    """Direct ``GROUP BY ROLLUP(rows), ROLLUP(cols)`` over the filtered view."""
    keys = rows + cols
    flags = ", ".join(f"CAST(GROUPING({k}) AS INTEGER) AS g_{k}" for k in keys)
    return (f"SELECT {', '.join(keys)}, {flags}, CAST(count({measure}) AS BIGINT) AS n{extra} FROM {view} "
            f"WHERE {period_sql(date_field, kind, start, end, release)} "
            f"GROUP BY ROLLUP({', '.join(rows)}), ROLLUP({', '.join(cols)})")


def crosstab_query(view: str, rows: list[str], cols: list[str], measure: str, date_field: str, kind: str,
                   start: str, end: str, as_of: str, release: str = "1.4.0", **options) -> str:
    return view_query(view, as_of, release, select=rollup_sql(
        view, date_field, kind, rows, cols, measure, start, end, release), **options)
