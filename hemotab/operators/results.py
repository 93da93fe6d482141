"""J-T: test results as one conditional aggregate per donation.

The testing view joins the result table once per test (22 times, 8 of
them used).  Here the table is scanned once, filtered to the repeat tests
that matter, and reduced to one row per donation with one flag per
disease: true when any of that disease's repeat results is positive (D3).
The aggregate is partial on the map side, so a donation with many result
rows (or one key holding many rows) never moves more than one row per
map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemotab.functions import labels as L
from hemotab.functions.recodes import flag_col
from hemotab.profile import DISEASES, Profile


def positive_flags(results: DataFrame, profile: Profile, diseases=DISEASES) -> DataFrame:
    """``donation_id`` plus ``<disease>_pos`` for each disease.

    A flag is null when the donation has no result for that disease's
    repeat tests, as the reference's left join yields null there.
    """
    r = results
    if profile.tests_exclude_deleted:
        r = r.where(~F.col("isDeleted"))
    r = r.where(F.col("bloodTest_id").isin(*profile.all_repeat_ids(diseases)))
    pos = F.col("result") == L.POSITIVE
    flags = [
        F.bool_or(F.when(F.col("bloodTest_id").isin(*profile.repeat_ids(d)), pos)).alias(flag_col(d))
        for d in diseases
    ]
    return r.groupBy("donation_id").agg(*flags)
