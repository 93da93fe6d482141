"""Release 1.4.0 end to end: binary test ids read from stored tables."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from hemotab.plans import catalog as C
from hemotab.plans import reports as RP
from hemotab.profile import FIXTURE_TEST_IDS, PROFILES, fixture_profile
from hemotab.sources.tables import Tables


def test_binary_keys_same_report(spark, small_tables):
    root = tempfile.mkdtemp(prefix="hemotab-bin-", dir="/tmp")
    p140 = PROFILES["1.4.0"]
    # re-key the fixture's integer test ids to the release's 16-byte ids
    mapping = None
    for disease, ints in FIXTURE_TEST_IDS.items():
        for i, b in zip(ints, p140.repeat_ids(disease)):
            cond = F.col("bloodTest_id") == i
            value = F.lit(bytearray(b))
            mapping = F.when(cond, value) if mapping is None else mapping.when(cond, value)
    for name in small_tables:
        df = small_tables[name]
        if name == "BloodTestResult":
            df = df.withColumn("bloodTest_id", mapping)
        df.write.parquet(f"{root}/{name}")
    stored = Tables.from_files(spark, root)  # binary test ids by default
    assert stored["BloodTestResult"].schema["bloodTest_id"].dataType.simpleString() == "binary"
    s, e = C.PERIODS["ttiCoinfection"]
    a = RP.crosstab(small_tables, "ttiCoinfection_by_site", s, e, as_of=C.AS_OF, profile=fixture_profile())
    b = RP.crosstab(stored, "ttiCoinfection_by_site", s, e, as_of=C.AS_OF, profile=p140)
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
