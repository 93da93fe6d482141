"""Source tables stored so that the joins on a donation need no shuffle.

Donations are bucketed by their id, test results and counselling by the
donation's id, donors by theirs, all into the same number of buckets.  A join or
an aggregate on that key then works bucket by bucket: of the donation views'
plans only the choice per number and the step to the donors still move rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemotab.session import at_once, checkpoint_dir
from hemotab.sources.schema import schemas
from hemotab.sources.tables import Tables
from hemotab.sources.versions import new_run

# Table -> the key its rows are bucketed and sorted by.
BUCKET_KEYS = {"Donation": "id", "BloodTestResult": "donation_id", "PostDonationCounselling": "donation_id", "Donor": "id"}


def write_colocated(tables: Tables, database: str, buckets: int, root: str | None = None,
                    keys: Mapping[str, str] = BUCKET_KEYS) -> None:
    """Saves all source tables in ``database`` of the session catalog, those of
    ``keys`` bucketed; files go to a new folder below ``root`` (default: the
    shared checkpoint folder).

    Tables are written side by side.  Each bucket is written by one task as one file: choose ``buckets`` so that a
    bucket of the largest table fits a task (input bytes / 200 MB or so).  Rows
    whose key is null match no donation and are left out of the results and
    counselling tables, so that they don't fill one bucket.
    """
    spark = tables.spark
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    folder = f"{(root or checkpoint_dir(spark)).rstrip('/')}/colocated/{new_run()}"

    def save(name: str, rows: DataFrame) -> None:
        key = keys.get(name)
        if key is not None and key != "id":
            rows = rows.where(F.col(key).isNotNull())
        writer = rows.write if key is None else rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
        writer.option("path", f"{folder}/{name}").saveAsTable(f"`{database}`.`{name}`")

    at_once(spark, [partial(save, name, tables[name]) for name in tables])


def colocated(spark, database: str, test_id_type: T.DataType = T.BinaryType()) -> Tables:
    """The tables ``write_colocated`` saved."""
    sch = schemas(test_id_type)
    # Columns that have their declared type already are taken as they are, so
    # that the planner sees the buckets.
    def loader(n: str):
        def load():
            df = spark.table(f"`{database}`.`{n}`")
            kinds = {f.name: f.dataType for f in df.schema.fields}
            return df.select(*[F.col(f.name) if kinds[f.name] == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name)
                               for f in sch[n].fields])
        return load

    return Tables(spark, {n: loader(n) for n in sch})
