"""Hot keys: one donation number (and the null number) holding a third of
the rows, checked against a brute-force computation in pandas."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from hemotab.plans import catalog as C
from hemotab.plans import views as V
from hemotab.profile import fixture_profile
from hemotab.sources.fixtures import fixture_tables
from hemotab.sources.tables import Tables
from conftest import SF_SMALL

P = fixture_profile()


def _skewed(spark) -> Tables:
    base = fixture_tables(spark, SF_SMALL)
    frames = {n: base[n] for n in base}
    d = frames["Donation"]
    k = F.col("id")
    # a third of donations share one number, a sixth have none
    din = (F.when(k % 3 == 0, F.lit("HOT"))
            .when(k % 6 == 1, F.lit(None).cast("string"))
            .otherwise(F.col("donationIdentificationNumber")))
    frames["Donation"] = d.withColumn("donationIdentificationNumber", din)
    return Tables(spark, frames)


def _brute_force(tables: Tables) -> pd.DataFrame:
    d = tables["Donation"].toPandas()
    donors = tables["Donor"].toPandas()
    packs = tables["PackType"].toPandas()
    d = d[d["isDeleted"] == False]  # noqa: E712
    d = d.merge(donors.add_prefix("donor_"), left_on="donor_id", right_on="donor_id", how="left")
    d = d[(d["donor_isDeleted"] == False) & (d["donor_donorStatus"].notna())  # noqa: E712
          & (d["donor_donorStatus"] != "MERGED")]
    d = d.merge(packs.add_prefix("pack_"), left_on="packType_id", right_on="pack_id", how="left")
    d = d[d["pack_countAsDonation"] == True]  # noqa: E712
    d = d.assign(key=d["donationIdentificationNumber"].fillna("\0null"))
    return d.sort_values("id").groupby("key", as_index=False).first()[["donationIdentificationNumber", "id"]]


def test_hot_number_collapse_matches_brute_force(spark):
    tables = _skewed(spark)
    got = V.donation_numbers(tables, P).toPandas().sort_values("id").reset_index(drop=True)
    want = _brute_force(tables).sort_values("id").reset_index(drop=True)
    assert got["id"].tolist() == want["id"].tolist()
    assert got["donationIdentificationNumber"].isna().sum() == 1
    assert (got["donationIdentificationNumber"] == "HOT").sum() == 1


def test_hot_number_report_totals(spark):
    tables = _skewed(spark)
    v = V.donation_summary(tables, as_of=C.AS_OF, profile=P, columns=["donationIdentificationNumber", "venue"])
    n = v.count()
    assert n == _brute_force(tables).shape[0]
    plan = v._jdf.queryExecution().executedPlan().toString()
    # the collapse is computed partially before its shuffle
    assert "partial_min(id" in plan


def test_aggregates_are_partial_before_shuffle(small_tables):
    from hemotab.plans import reports as RP
    s, e = C.PERIODS["ttiCoinfection"]
    df = RP.crosstab(small_tables, "ttiCoinfection_by_site", s, e, as_of=C.AS_OF, profile=P)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for partial in ("partial_min(id", "partial_max(", "partial_count(", "partial_sum("):
        assert partial in plan, partial


def test_components_without_a_batch_are_spread(spark):
    """A third of the components have no batch: they match nothing, stay, and
    don't meet in one shuffle partition."""
    base = fixture_tables(spark, SF_SMALL)
    batch = F.when(F.col("id") % 3 == 0, None).otherwise(F.col("componentBatch_id"))
    tables = base.replaced(Component=base["Component"].withColumn("componentBatch_id", batch))
    old = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        rows = V._processed_at(tables, tables["Component"].select("id", "componentBatch_id"))
        got = {r["id"]: r["processedAtLocation"] for r in rows.collect()}
        sites = {r["id"]: r["name"] for r in V.batch_location(tables).collect()}
        want = {r["id"]: sites.get(r["componentBatch_id"]) for r in tables["Component"].collect()}
        assert got == want
        assert "pmod(xxhash64(" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)
