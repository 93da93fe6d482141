"""Deduplication as aggregation.

Both collapses pick one row per key by an ordering, as aggregates and not as
windows: they are computed partially on the map side, so a hot key (one
donation number, or the null number, holding a large share of rows) leaves
each map task as a single row instead of landing whole in one reduce task.

D1 aggregates two numbers per row (a hash aggregate over the number and the
least id) and finds the chosen rows again by their id.  D2 keeps its few
narrow columns in the aggregate, since finding them again would cost three
more shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_by_key(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str],
                 descending: bool = False) -> DataFrame:
    """One row per ``key``: the row with the smallest (or largest) ``order``.

    ``order`` must make rows unique within a key (end it with the row id)
    so that the pick is deterministic.  Nulls in an ordering column rank
    lowest.  Only ``columns`` travel through the shuffle.
    """
    payload = [c for c in columns if c not in order and c != key]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload]).alias("__pick")
    agg = F.max(packed) if descending else F.min(packed)
    out = df.groupBy(key).agg(agg.alias("__pick"))
    keep = [c for c in columns if c != key]
    return out.select(key, *[F.col(f"__pick.{c}").alias(c) for c in keep])


def one_per_donation_number(donations: DataFrame) -> DataFrame:
    """(donation number, id): the lowest donation id of each number.

    The reference groups by the number and lets the engine pick any row;
    the lowest id is the deterministic choice.  Null numbers form one
    group, as in the reference.
    """
    return donations.groupBy("donationIdentificationNumber").agg(F.min("id").alias("id"))


def latest_counselling(counselling: DataFrame) -> DataFrame:
    """One counselling row per donation: latest date (nulls last), then highest id."""
    return first_by_key(
        counselling, "donation_id", ["counsellingDate", "id"],
        ["donation_id", "counsellingDate", "id", "flaggedForCounselling", "counsellingStatus"],
        descending=True,
    ).drop("id")
