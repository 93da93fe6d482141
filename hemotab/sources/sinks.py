"""Sinks (K1): report and view outputs as files.

Crosstabs are written in long form (and optionally wide) with the report
name and period as partition columns, so that many runs accumulate in one
table and a reader prunes to one report and period.  Writes go through
Spark's file committer, so a lost executor only re-runs its tasks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hemotab.sources.versions import Manifest, new_run

FORMATS = ("parquet", "csv", "json")
ALIKE = 4096


def _tag(df: DataFrame, report: str, start, end) -> DataFrame:
    return (df.withColumn("report", F.lit(report))
              .withColumn("period_start", F.lit(str(start)).cast("date"))
              .withColumn("period_end", F.lit(str(end)).cast("date")))


def write_frame(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> None:
    """Writes ``df``; with partition columns, ``overwrite`` replaces only the
    partitions present in ``df`` (dynamic overwrite), so re-running a report
    for a period after a failure replaces that period and nothing else."""
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt!r} not in {FORMATS}")
    writer = df.write.mode(mode).format(fmt)
    if partition_by and mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if fmt == "csv":
        writer = writer.option("header", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_report(outputs: Mapping[str, DataFrame], path: str, report: str, start: dt.date | str,
                 end: dt.date | str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Writes ``run_report`` output: both crosstabs in one long table at
    ``path/crosstabs``, the metadata row at ``path/metadata`` and, if there,
    each wide form at ``path/<crosstab>_wide`` (its columns come from the data,
    so readers of several periods merge schemas).  Runs for
    other reports and periods in the same folders are kept; a re-run of
    the same report and period replaces it (idempotent).
    """
    combined = _tag(outputs["combined"], report, start, end)
    write_frame(combined, f"{path.rstrip('/')}/crosstabs", fmt, mode,
                ("report", "period_start", "period_end", "crosstab"))
    meta = _tag(outputs["metadata"], report, start, end)
    write_frame(meta, f"{path.rstrip('/')}/metadata", fmt, mode, ("report", "period_start", "period_end"))
    for name, df in outputs.items():
        if name.endswith("_wide"):
            write_frame(_tag(df, report, start, end), f"{path.rstrip('/')}/{name}", fmt, mode,
                        ("report", "period_start", "period_end"))


def export_view(df: DataFrame, path: str, order_by: Sequence[str] = (), fmt: str = "parquet",
                mode: str = "overwrite") -> None:
    """Detail export of a view, sorted as the reference's views are (O1-O4):
    each file is sorted, and files follow one another in the order of their names.

    Rows with equal sort keys are told apart by a digest of the row and by
    where they came from, so a sort key that holds most rows (one date, or rows
    that are all alike) is dealt to as many tasks as its rows need (rows that are
    all alike: ``ALIKE`` at most).
    """
    if order_by:
        tie = [c for c in df.columns if c not in order_by] or list(order_by)
        apart = {"__digest": F.hash(*tie), "__row": (F.monotonically_increasing_id() % ALIKE).cast("short")}   # 6 bytes to move
        df = df.withColumns(apart).orderBy(*order_by, *apart).drop(*apart)
    write_frame(df, path, fmt, mode)


def places(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The rows of a Parquet export with ``place``: how many runs of equal keys
    have begun, in the order of files and rows.  In a sorted export that is the
    rank of the key, and no key has two places."""
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__at"))
    earlier = Window.partitionBy("__file").orderBy("__at")
    mine, before = F.struct(*keys), F.struct(*[F.lag(k).over(earlier) for k in keys])
    begins = rows.withColumn("__new", F.when((F.col("__at") > 0) & mine.eqNullSafe(before), 0).otherwise(1))
    # One row per file: its runs, and whether its first goes on with the file before.
    files = begins.groupBy("__file").agg(F.sum("__new").alias("n"), F.min_by(mine, "__at").alias("first"), F.max_by(mine, "__at").alias("last"))
    by_name = Window.orderBy("__file")
    goes_on = F.when(F.col("first").eqNullSafe(F.lag("last").over(by_name)) & F.lag("n").over(by_name).isNotNull(), 1).otherwise(0)
    files = files.select("__file", F.col("n"), goes_on.alias("joined"))
    offset = F.sum(F.col("n") - F.col("joined")).over(by_name) - F.col("n")
    return (begins.join(files.select("__file", offset.alias("__offset")), "__file")
            .withColumn("place", F.col("__offset") + F.sum("__new").over(earlier))
            .drop("__file", "__at", "__new", "__offset"))


# Report, first day, last day, run_report output.
Run = tuple[str, dt.date | str, dt.date | str, Mapping[str, DataFrame]]
_TAGS = ("report", "period_start", "period_end")


class ReportStore:
    """Reports published together (K1).

    The crosstabs, metadata and wide forms of any number of reports are written
    to folders of their own run, all long forms in one job, and then one
    manifest file makes the run's reports visible.  A failure before that leaves
    every report as it was; readers never see parts of two runs of a report.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.manifest = spark, root.rstrip("/"), Manifest(spark, root)

    def publish(self, runs: Sequence[Run]) -> int:
        """Adds the reports, or replaces those of the same report and period;
        returns the new version."""
        if not runs:
            raise ValueError("no reports to publish")
        run = new_run()
        parts = {f"{name}/{start}/{end}": run for name, start, end, _ in runs}
        if len(parts) < len(runs):
            raise ValueError("a report and period is given twice")
        kinds: dict[str, list[DataFrame]] = {}
        for name, start, end, outputs in runs:
            kinds.setdefault("crosstabs", []).append(_tag(outputs["combined"], name, start, end))
            kinds.setdefault("metadata", []).append(_tag(outputs["metadata"], name, start, end))
            for kind, df in outputs.items():
                if kind.endswith("_wide"):
                    kinds.setdefault(kind, []).append(_tag(df, name, start, end))
        for kind, frames in kinds.items():
            whole = frames[0]
            for more in frames[1:]:
                whole = whole.unionByName(more, allowMissingColumns=True)
            whole.write.partitionBy(*_TAGS, *(["crosstab"] if kind == "crosstabs" else [])).parquet(f"{self.root}/{kind}/run={run}")
        return self.manifest.publish(self.manifest.parts() | parts)

    def _read(self, kind: str, parts: Mapping[str, str]) -> DataFrame:
        runs = sorted(set(parts.values()))
        rows = (self.spark.read.option("basePath", f"{self.root}/{kind}").option("mergeSchema", "true")
                .parquet(*[f"{self.root}/{kind}/run={r}" for r in runs]))
        # On partition columns alone: files of replaced reports are not opened.
        here = F.concat_ws("/", "run", *[F.col(c).cast("string") for c in _TAGS])
        return rows.where(here.isin([f"{run}/{part}" for part, run in parts.items()])).drop("run")

    def crosstabs(self) -> DataFrame:
        """Long forms of all published reports, with report, period_start, period_end and crosstab."""
        return self._read("crosstabs", self._published())

    def metadata(self) -> DataFrame:
        return self._read("metadata", self._published())

    def wide(self, crosstab: str) -> DataFrame:
        """Wide forms of a crosstab, of the reports that were published with them."""
        parts = {p: r for p, r in self._published().items() if crosstab.startswith(p.split("/")[0] + "_")}
        return self._read(f"{crosstab}_wide", parts)

    def _published(self) -> dict[str, str]:
        parts = self.manifest.parts()
        if not parts:
            raise ValueError(f"nothing published in {self.root}")
        return parts


# Sort keys of the reference's views, for export_view.
VIEW_ORDER = {
    "donationSummaryView": ("donationDate",),
    "inventorySummaryView": ("donationIdentificationNumber", "componentCode"),
    "deferralSummaryView": ("deferralDate",),
    "issuedSummaryView": ("orderId",),
    "testingSummaryView": ("donationDate",),
}
