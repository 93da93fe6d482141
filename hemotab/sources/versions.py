"""Published versions: which folders a reader sees.

Data is written to new folders first.  Then one small file with the rows of a
new version (which folder holds each part) is added to ``<root>/manifest``; a
reader takes the newest version there.  A single file appears at once or not
at all, so a failure before it leaves the former version whole, and folders
that no version names are never read.  One writer at a time; should two meet,
readers agree on one of their versions.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MANIFEST = "version long, run string, part string, path string"
NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


def new_run() -> str:
    return f"r{uuid.uuid4().hex}"


def folder_bytes(spark: SparkSession, paths: Sequence[str]) -> int:
    """Size of the files below the folders (only their lengths are read)."""
    if not paths:
        return 0
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


class Manifest:
    """The parts of a table, version by version: as many rows as a version has parts."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/manifest"

    def _newest(self) -> list:
        try:
            rows = self.spark.read.schema(_MANIFEST).parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        last = rows.agg(F.max(F.struct("version", "run")).alias("last")).select("last.*").first()
        if last["version"] is None:
            return []
        return rows.where((F.col("version") == last["version"]) & (F.col("run") == last["run"])).collect()

    def version(self) -> int:
        """0: nothing published yet."""
        return max((r["version"] for r in self._newest()), default=0)

    def parts(self) -> dict[str, str]:
        """part -> folder of the newest version."""
        return {r["part"]: r["path"] for r in self._newest() if r["part"] is not None}

    def publish(self, parts: dict[str, str]) -> int:
        """Makes ``parts`` the newest version, in one file."""
        version, run = self.version() + 1, new_run()
        # The row without a part stands for a version that may hold nothing.
        rows = [(version, run, None, None), *[(version, run, p, path) for p, path in sorted(parts.items())]]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("append").parquet(self.path)
        return version


class MonthlyStore:
    """A table by months of which single months can be replaced.

    A replaced month lives in the folder of the run that wrote it; the others
    stay where they are.  ``month`` is the partition column (a date, the first
    of the month; null for rows without a date).
    """

    def __init__(self, spark: SparkSession, root: str, month: str):
        self.spark, self.root, self.month = spark, root.rstrip("/"), month
        self.manifest = Manifest(spark, root)

    def _data(self) -> str:
        return f"{self.root}/data"

    def read(self, schema: T.StructType) -> DataFrame:
        """The newest version; ``schema`` holds all columns, the month among them."""
        paths = sorted(self.manifest.parts().values())
        columns = [f.name for f in schema.fields]
        if not paths:
            return self.spark.createDataFrame([], schema)
        whole = T.StructType([*[f for f in schema.fields if f.name != self.month],
                              T.StructField("run", T.StringType()), schema[self.month]])
        return self.spark.read.schema(whole).option("basePath", self._data()).parquet(*paths).select(*columns)

    def replace(self, rows: DataFrame, months: Iterable | None = None) -> list[str]:
        """Publishes a version in which ``months`` hold ``rows`` and nothing else
        (all of the table, if no months are given).  Returns the new folders.

        The write is balanced: rows are dealt by month, and AQE splits a month
        that is too large for a task.
        """
        run = new_run()
        folder = f"{self._data()}/run={run}"
        rows.hint("rebalance", self.month).write.partitionBy(self.month).parquet(folder)
        # Spark's own list of the files just written: one folder per month.
        files = self.spark.read.schema(rows.schema).parquet(folder).inputFiles()
        written = {unquote(f.rsplit("/", 2)[1].partition("=")[2]) for f in files}
        new = {m: f"{folder}/{self.month}={m}" for m in written}
        kept = self.manifest.parts() if months is not None else {}
        gone = {self._part(m) for m in months or ()}
        if not set(new) <= gone and months is not None:
            raise ValueError(f"rows of other months than those replaced: {sorted(set(new) - gone)}")
        self.manifest.publish({p: path for p, path in kept.items() if p not in gone} | new)
        return sorted(new.values())

    @staticmethod
    def _part(month) -> str:
        return NO_MONTH if month is None else str(month)
