"""Spark session helpers.

Library code never creates a session on its own; callers (tests, bench,
command-line use) go through :func:`build_session` so that the settings
the plans rely on are in one place.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings the plans are designed around.  AQE coalesces the small
# post-aggregate shuffles and splits skewed sort-merge-join partitions;
# the session zone is fixed so that date/timestamp casts are stable.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Code lists are hinted where the planner's size estimate is small
    # (operators.joins.code_table); other joins are planned as shuffles and
    # only AQE turns one into a broadcast, from the measured size of the
    # shuffled side.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Plans are built from many small DataFrame calls; capturing the Python
    # call site on each one costs more than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "hemotab",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised tables.

    On a cluster this is whatever the deployment set in
    ``spark.checkpoint.dir`` (a shared file system).  Only when it is
    unset, as in local tests, a scratch folder is created and set.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; on a cluster it must name a shared folder "
                           "(a machine-local folder would be lost with its executor)")
    local = tempfile.mkdtemp(prefix="hemotab-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder below the shared checkpoint folder and read back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def at_once(spark: SparkSession, steps: Sequence[Callable[[], object]], most: int = 4) -> list:
    """Results of independent steps that each run Spark jobs, ``most`` of them
    side by side, so that the last tasks of one job leave no cores idle.  The
    first error is raised once all that were begun have ended."""
    with ThreadPoolExecutor(most) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
        try:
            return [b.result() for b in begun]
        except BaseException:
            for b in begun:
                b.cancel()
            raise
