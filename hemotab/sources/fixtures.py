"""The 18 source tables derived from the star-schema test data.

The test data holds no blood-service tables, so each one is derived from
a star-schema table by modulo arithmetic on its keys (deterministic, no
random numbers).  Each derivation is a plain projection or filter of one
input table, so it scales with that table and Catalyst prunes and pushes
down through it; only ``Component`` needs an aggregate (one row per
order and line number).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemotab.profile import DISEASES, Profile, fixture_profile
from hemotab.sources.schema import schemas
from hemotab.sources.tables import Tables

INPUTS = ("nation", "customer", "supplier", "orders", "lineitem", "events")


def _case(col: Column, mapping: dict, default) -> Column:
    expr = None
    for key, value in mapping.items():
        expr = (F.when(col == key, F.lit(value)) if expr is None
                else expr.when(col == key, F.lit(value)))
    return expr.otherwise(F.lit(default))


def _hours(n: int) -> Column:
    return F.expr(f"INTERVAL {n} HOURS")


def fixture_tables(spark: SparkSession, sf_dir: str, profile: Profile | None = None) -> Tables:
    """``profile``: TTI codes and test ids of a release (default: the codes of
    1.4.0, tests numbered from 0)."""
    test_ids = [i for d in DISEASES for i in (profile or fixture_profile()).test_ids[d]]
    unsafe, safe = (profile.tti_unsafe, profile.tti_safe) if profile else ("UNSAFE", "SAFE")
    binary = isinstance(test_ids[0], bytes)
    sch = schemas(T.BinaryType() if binary else T.LongType())

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

    def typed(name: str, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in sch[name].fields])

    def values(name: str, rows: list[tuple]) -> DataFrame:
        # Inline rows, whose size the planner knows.
        listed = ", ".join("(" + ", ".join(repr(v).lower() if isinstance(v, bool) else repr(v) for v in r) + ")" for r in rows)
        names = ", ".join(f.name for f in sch[name].fields)
        return typed(name, spark.sql(f"SELECT * FROM VALUES {listed} AS t({names})"))

    def location() -> DataFrame:
        n = read("nation")
        return typed("Location", n.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")))

    def donor() -> DataFrame:
        c = read("customer")
        k = F.col("c_custkey")
        return typed("Donor", c.select(
            k.alias("id"),
            F.col("c_name").alias("donorNumber"),
            F.when(k % 97 == 5, None).when(k % 2 == 0, "male").otherwise("female").alias("gender"),
            F.when(k % 89 == 7, None)
             .otherwise(F.date_add(F.lit("1930-02-28").cast("date"), ((k * 37) % 22000).cast("int")))
             .alias("birthDate"),
            (k % 50 == 3).alias("isDeleted"),
            F.when(k % 61 == 2, None).when(k % 41 == 1, "MERGED").otherwise("NORMAL").alias("donorStatus"),
        ))

    def donation() -> DataFrame:
        o = read("orders")
        k = F.col("o_orderkey")
        din_key = F.when(k % 101 == 50, k - 1).otherwise(k)
        return typed("Donation", o.select(
            k.alias("id"),
            F.concat(F.lit("D"), din_key.cast("string")).alias("donationIdentificationNumber"),
            F.col("o_custkey").alias("donor_id"),
            F.when(k % 59 == 0, None).otherwise(k % 25).alias("venue_id"),
            (k % 5).alias("donationType_id"),
            ((k + F.col("o_custkey")) % 4).alias("packType_id"),
            F.col("o_orderdate").cast("date").alias("donationDate"),
            F.when(k % 9 == 8, None).otherwise(_case(k % 9, {0: "A", 1: "B", 2: "AB", 3: "A"}, "O"))
             .alias("bloodAbo"),
            F.when(k % 7 == 0, "-").otherwise("+").alias("bloodRh"),
            _case(k % 11, {0: "NO_TYPE_DETERMINED", 1: "NOT_DONE", 2: "RESOLVED"}, "MATCH")
             .alias("bloodTypingMatchStatus"),
            _case(F.col("o_orderstatus"), {"F": unsafe, "O": safe}, "NOT_DONE").alias("ttiStatus"),
            F.when(k % 13 == 0, "PENDING").otherwise("COMPLETE").alias("bloodTypingStatus"),
            (F.col("o_orderdate") + _hours(9)).alias("bleedStartTime"),
            (F.col("o_orderdate") + _hours(10)).alias("bleedEndTime"),
            (50 + k % 60).alias("donorWeight"),
            (11 + k % 7).alias("haemoglobinCount"),
            F.when(k % 7 < 2, "FAIL").otherwise("PASS").alias("haemoglobinLevel"),
            (55 + k % 50).alias("donorPulse"),
            (100 + k % 50).alias("bloodPressureSystolic"),
            (60 + k % 30).alias("bloodPressureDiastolic"),
            F.when(k % 70 == 0, k).alias("adverseEvent_id"),
            (k % 17 == 0).alias("ineligibleDonor"),
            (k % 10 < 8).alias("released"),
            (k % 33 == 1).alias("isDeleted"),
        ))

    def blood_test_result() -> DataFrame:
        li = read("lineitem")
        return typed("BloodTestResult", li.select(
            F.col("l_orderkey").alias("donation_id"),
            F.element_at(F.array(*[F.lit(i) for i in test_ids]),
                         ((F.col("l_linenumber") + F.col("l_partkey")) % 8 + 1).cast("int")).alias("bloodTest_id"),
            F.when(F.col("l_returnflag") == "R", "POS").otherwise("NEG").alias("result"),
            (F.col("l_suppkey") % 20 == 0).alias("isDeleted"),
        ))

    def counselling() -> DataFrame:
        e = read("events").where(F.col("event_type").isin("click", "view", "error"))
        k = F.col("event_id")
        return typed("PostDonationCounselling", e.select(
            k.alias("id"),
            (F.floor(k / 2) * 3).alias("donation_id"),
            F.when(F.col("event_type") == "click", "RECEIVED_COUNSELLING")
             .when(F.col("event_type") == "view", "REFUSED_COUNSELLING").alias("counsellingStatus"),
            (k % 2 == 0).alias("flaggedForCounselling"),
            F.col("ts").cast("date").alias("counsellingDate"),
        ))

    def component_batch() -> DataFrame:
        s = read("supplier")
        k = F.col("s_suppkey")
        return typed("ComponentBatch", s.select(
            k.alias("id"), F.when(k % 17 == 4, None).otherwise(F.col("s_nationkey")).alias("location_id")))

    def component() -> DataFrame:
        li = read("lineitem")
        # Dealt by order: the lines of an order and its donation then meet without another shuffle.
        g = li.repartition("l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(
            F.min("l_partkey").alias("p"), F.min("l_suppkey").alias("s"), F.min("l_shipdate").alias("d"))
        p, s, d = F.col("p"), F.col("s"), F.col("d")
        return typed("Component", g.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("l_orderkey").alias("donation_id"),
            (p % 6).alias("componentType_id"),
            F.lit(None).alias("parentComponent_id"),
            (s % 25).alias("location_id"),
            F.when(p % 23 == 9, None).otherwise(s).alias("componentBatch_id"),
            F.concat(F.lit("C"), F.col("l_linenumber").cast("string")).alias("componentCode"),
            (d + _hours(10)).alias("createdOn"),
            F.when(p % 29 == 0, None).otherwise(d + F.expr("INTERVAL 35 DAYS")).alias("expiresOn"),
            _case(p % 8, {0: "EXPIRED", 1: "DISCARDED", 2: "ISSUED", 3: "TRANSFUSED",
                          4: "AVAILABLE", 5: "QUARANTINED"}, "PROCESSED").alias("status"),
            F.when(p % 3 == 0, "NOT_IN_STOCK").otherwise("IN_STOCK").alias("inventoryStatus"),
            (s % 40 == 7).alias("isDeleted"),
        ))

    def return_form() -> DataFrame:
        o = read("orders")
        k = F.col("o_orderkey")
        return typed("ReturnForm", o.where(k % 3 == 0).select(
            k.alias("id"), F.when(k % 4 == 0, "CREATED").otherwise("RETURNED").alias("status")))

    def return_form_component() -> DataFrame:
        c = tables["Component"].select("id", "donation_id")
        first = c.where((F.col("donation_id") % 3 == 0) & (F.col("id") % 7 == 0)).select(
            F.col("id").alias("component_id"), F.col("donation_id").alias("returnForm_id"))
        second = c.where((F.col("donation_id") % 3 == 0) & (F.col("donation_id") >= 3)
                         & (F.col("id") % 35 == 0)).select(
            F.col("id").alias("component_id"), (F.col("donation_id") - 3).alias("returnForm_id"))
        return typed("ReturnForm_Component", first.unionAll(second))

    def donor_deferral() -> DataFrame:
        e = read("events").where(F.col("event_type").isin("error", "purchase"))
        k = F.col("event_id")
        return typed("DonorDeferral", e.select(
            k.alias("id"), F.col("user_id").alias("deferredDonor_id"),
            F.when(k % 43 == 0, None).otherwise(k % 25).alias("venue_id"),
            (k % 5).alias("deferralReason_id"), F.col("ts").alias("deferralDate"),
            (k % 20 == 0).alias("isVoided"),
        ))

    def status_change() -> DataFrame:
        li = read("lineitem")
        return typed("ComponentStatusChange", li.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("component_id"),
            _case(F.col("l_returnflag"), {"R": "DISCARDED", "A": "ISSUED"}, "PROCESSED").alias("newStatus"),
            (F.col("l_partkey") % 5).alias("statusChangeReason_id"),
            F.col("l_shipdate").alias("statusChangedOn"),
            (F.col("l_suppkey") % 30 == 0).alias("isDeleted"),
        ))

    def order_form() -> DataFrame:
        o = read("orders")
        k, c = F.col("o_orderkey"), F.col("o_custkey")
        return typed("OrderForm", o.select(
            k.alias("id"),
            _case(F.col("o_orderstatus"), {"F": "DISPATCHED", "O": "CREATED"}, "DISPATCHED").alias("status"),
            F.col("o_orderdate").alias("orderDate"),
            F.when(c % 37 == 0, None).otherwise(c % 25).alias("dispatchedTo_id"),
            _case(F.col("o_orderpriority"), {"5-LOW": "TRANSFER", "4-NOT SPECIFIED": "PATIENT_REQUEST"},
                  "ISSUE").alias("type"),
            (k % 45 == 2).alias("isDeleted"),
        ))

    def order_form_component() -> DataFrame:
        c = tables["Component"]
        return typed("OrderForm_Component", c.select(
            F.col("donation_id").alias("orderForm_id"), F.col("id").alias("component_id")))

    # Code lists of the fixtures (not values of the reference).
    loaders = {
        "Location": location,
        "Donor": donor,
        "DonationType": lambda: values("DonationType", [
            (0, "Voluntary"), (1, "Family"), (2, "Autologous"), (3, "Other")]),
        "PackType": lambda: values("PackType", [
            (0, "Single", True), (1, "Double", True), (2, "Triple", True), (3, "Did Not Bleed", False)]),
        "Donation": donation,
        "BloodTestResult": blood_test_result,
        "PostDonationCounselling": counselling,
        "ComponentType": lambda: values("ComponentType", [
            (0, "Whole Blood"), (1, "Packed Red Cells"), (2, "Fresh Frozen Plasma"),
            (3, "Platelets"), (4, "Cryoprecipitate")]),
        "ComponentBatch": component_batch,
        "Component": component,
        "ReturnForm": return_form,
        "ReturnForm_Component": return_form_component,
        "DeferralReason": lambda: values("DeferralReason", [
            (0, "Low weight"), (1, "Low haemoglobin"), (2, "High risk behaviour"), (3, "Travel")]),
        "DonorDeferral": donor_deferral,
        "ComponentStatusChangeReason": lambda: values("ComponentStatusChangeReason", [
            (0, "Expired"), (1, "Broken pack"), (2, "Unsafe test"), (3, "Leaking")]),
        "ComponentStatusChange": status_change,
        "OrderForm": order_form,
        "OrderForm_Component": order_form_component,
    }
    tables = Tables(spark, loaders)
    return tables


def odd_labels(tables: Tables) -> Tables:
    """A third gender, a reason named like a total and an empty one."""
    k = F.col("id")
    donor = tables["Donor"].withColumn("gender", F.when((k % 7 == 3) & (k % 97 != 5), "other").otherwise(F.col("gender")))
    label = F.col("statusChangeReason")
    reason = tables["ComponentStatusChangeReason"].withColumn(
        "statusChangeReason", F.when(k == 1, "Total").when(k == 2, "").otherwise(label))
    return tables.replaced(Donor=donor, ComponentStatusChangeReason=reason)


def earlier_state(tables: Tables) -> Tables:
    """The source tables before a batch of changes: donations not yet entered,
    not yet (or still) deleted, with another date, number or venue; donors since
    merged, restored or corrected; other results and counselling; a site since renamed."""
    k = F.col("id")
    d = tables["Donation"].where(k % 83 != 7)
    d = d.withColumns({
        "isDeleted": F.when(k % 29 == 3, ~F.col("isDeleted")).otherwise(F.col("isDeleted")),
        "donationDate": F.when(k % 31 == 5, F.date_sub("donationDate", 40)).otherwise(F.col("donationDate")),
        "venue_id": F.when(k % 43 == 1, (k + 3) % 25).otherwise(F.col("venue_id")),
        "donationIdentificationNumber": F.when(k % 37 == 6, F.concat(F.lit("D"), (k + 5).cast("string")))
         .when(k % 211 == 9, None).otherwise(F.col("donationIdentificationNumber")),
    })
    donor = tables["Donor"].withColumns({
        "gender": F.when(k % 53 == 9, "female").otherwise(F.col("gender")),
        "donorStatus": F.when(k % 47 == 11, "MERGED").when(k % 71 == 4, "NORMAL").otherwise(F.col("donorStatus")),
        "birthDate": F.when(k % 67 == 8, F.date_sub("birthDate", 3000)).otherwise(F.col("birthDate")),
    })
    results = tables["BloodTestResult"].where(F.col("donation_id") % 79 != 6).withColumn(
        "result", F.when(F.col("donation_id") % 73 == 2, "NEG").otherwise(F.col("result")))
    counselling = tables["PostDonationCounselling"].where(k % 61 != 3).withColumns({
        "donation_id": F.when(k % 59 == 4, F.col("donation_id") + 3).otherwise(F.col("donation_id")),
        "counsellingStatus": F.when(k % 57 == 5, None).otherwise(F.col("counsellingStatus")),
    })
    site = tables["Location"].withColumn("name", F.when(k == 7, "Old name").otherwise(F.col("name")))
    return tables.replaced(Donation=d, Donor=donor, BloodTestResult=results, PostDonationCounselling=counselling, Location=site)
