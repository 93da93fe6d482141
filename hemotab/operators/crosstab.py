"""Cross-tabulation: nested row groups x nested column groups x a count.

A crosstab of the reference is ``GROUP BY ROLLUP(rows), ROLLUP(cols)``
with ``count(measure)`` in every cell and totals after the members.  It
is computed in two steps:

1. ``finest``: one distributed aggregate to the finest grain (all keys),
   counting the non-null measure.  Partial aggregation on the map side
   means only (keys, partial count) pairs cross the shuffle, whatever the
   input size or key skew.
2. ``crosstab``: grouping sets (the rollup product) over that small
   result, summing the counts.  Counts are additive, so this equals the
   direct rollup, but Spark's ``Expand`` multiplies the few finest rows
   instead of every detail row.

Grouping flags ``g_<field>`` (1 = total over that field) are carried in
the long form, because a null label and a total look alike without them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import product
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemotab.functions import labels as L
from hemotab.session import stored

COUNT = "n"
NULL_LABEL = "(null)"


@dataclass(frozen=True)
class Group:
    field: str
    descending: bool = False
    total_label: str = L.TOTAL


@dataclass(frozen=True)
class CrosstabSpec:
    id: str
    name: str
    rows: tuple[Group, ...]
    cols: tuple[Group, ...]
    measure: str
    # Labels each column field has in the wide form even without data.
    col_values: Mapping[str, tuple] = field(default_factory=dict, hash=False)

    @property
    def groups(self) -> tuple[Group, ...]:
        return self.rows + self.cols

    @property
    def keys(self) -> list[str]:
        return [g.field for g in self.groups]

    def grouping_sets(self) -> list[list[str]]:
        """Row-rollup prefixes x column-rollup prefixes, finest first."""
        rows = [g.field for g in self.rows]
        cols = [g.field for g in self.cols]
        return [rows[:i] + cols[:j]
                for i in range(len(rows), -1, -1)
                for j in range(len(cols), -1, -1)]


def finest(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """Step 1: ``count(measure)`` per combination of ``keys`` (non-null measure only)."""
    uniq = list(dict.fromkeys(keys))
    return df.groupBy(*uniq).agg(F.count(F.col(measure)).alias(COUNT))


def crosstab(finest_df: DataFrame, spec: CrosstabSpec) -> DataFrame:
    """Step 2: long form: keys, ``g_<key>`` flags and ``n`` for every cell and total."""
    keys = spec.keys
    sets = [[F.col(k) for k in s] for s in spec.grouping_sets()]
    grouped = finest_df.groupingSets(sets, *[F.col(k) for k in keys])
    return grouped.agg(
        *[F.grouping(k).cast("int").alias(f"g_{k}") for k in keys],
        F.coalesce(F.sum(COUNT), F.lit(0)).cast("long").alias(COUNT),
    )


def sort_columns(spec: CrosstabSpec) -> list[Column]:
    """Presentation order (O5-O7): members first, totals after; gender descending."""
    order: list[Column] = []
    for g in spec.groups:
        order.append(F.col(f"g_{g.field}").asc())
        order.append(F.col(g.field).desc_nulls_last() if g.descending else F.col(g.field).asc_nulls_last())
    return order


def ordered(long: DataFrame, spec: CrosstabSpec) -> DataFrame:
    """The long form in report order; the sort runs on the small result."""
    return long.orderBy(*sort_columns(spec))


def labelled(long: DataFrame, spec: CrosstabSpec) -> DataFrame:
    """Adds ``<field>_label``: the member text, or the total label."""
    out = long
    for g in spec.groups:
        out = out.withColumn(
            f"{g.field}_label",
            F.when(F.col(f"g_{g.field}") == 1, F.lit(g.total_label)).otherwise(F.col(g.field)))
    return out


def member_text(label: str | None) -> str:
    """A member's part of a wide column name.  Labels that would read like a
    null, a total or two parts are quoted, so that no two members share a name."""
    if label is None:
        return NULL_LABEL
    if label in ("", NULL_LABEL, L.TOTAL) or "|" in label or label.startswith('"'):
        return '"' + label.replace('"', '""') + '"'
    return label


# One part of a wide column: (is a total, member).
Part = tuple[bool, str | None]


def column_name(parts: Sequence[Part]) -> str:
    """``male|16-25``, ``male|Total``, ``Total``."""
    if all(total for total, _ in parts):
        return L.TOTAL
    return "|".join(L.TOTAL if total else member_text(m) for total, m in parts)


def wide_members(long: DataFrame, spec: CrosstabSpec) -> list[tuple[Part, ...]]:
    """The column cells in report order: those in the data and, where the
    spec declares labels, those as well.  Nulls follow the other members of a
    group, and totals follow all members."""
    fields = [g.field for g in spec.cols]
    seen = long.select(*[F.col(f"g_{f}") for f in fields], *fields).distinct()
    # As many rows as the crosstab has columns.
    cells = {tuple((r[f"g_{f}"] == 1, r[f]) for f in fields) for r in seen.collect()}
    declared = [set(spec.col_values.get(f, ())) for f in fields]
    if all(declared):  # each member of the outer groups has all declared inner ones
        total = (True, None)
        members = [d | {c[i][1] for c in cells if not c[i][0]} for i, d in enumerate(declared)]
        for i in range(len(fields) + 1):
            named = [m if k < i - 1 else d for k, (m, d) in enumerate(zip(members[:i], declared[:i]))]
            cells |= {(*((False, v) for v in vs), *[total] * (len(fields) - i)) for vs in product(*named)}

    order = list(cells)
    for i, g in reversed(list(enumerate(spec.cols))):  # stable sorts, the inner group first
        members = sorted({c[i][1] for c in order if c[i][1] is not None}, reverse=g.descending)
        rank = {(False, m): k for k, m in enumerate(members)} | {(False, None): len(members), (True, None): len(members) + 1}
        order.sort(key=lambda c: rank[c[i]])
    return order


def crosstab_wide(long: DataFrame, spec: CrosstabSpec) -> DataFrame:
    """One row per row-group cell, one column per column cell; empty cells 0.

    The columns come from the data, so the long form is computed once and
    written (it holds aggregate cells only) before its labels are read.
    """
    held = stored(long.sparkSession, long, f"crosstab-{spec.name}")
    row_keys = [g.field for g in spec.rows]

    def cell(parts: tuple[Part, ...]) -> Column:
        here = [F.col(f"g_{g.field}") == 1 if total else (F.col(f"g_{g.field}") == 0) & F.col(g.field).eqNullSafe(F.lit(m))
                for g, (total, m) in zip(spec.cols, parts)]
        return F.coalesce(F.sum(F.when(reduce(and_, here), F.col(COUNT))), F.lit(0)).cast("long").alias(column_name(parts))

    return held.groupBy(*row_keys, *[f"g_{k}" for k in row_keys]).agg(*[cell(c) for c in wide_members(held, spec)])
