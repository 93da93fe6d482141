"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemotab.llm.common import store


def _nearest(spark: SparkSession, pairs: DataFrame) -> DataFrame:
    """u and its smallest partner; written, so that joining it back to a hub's
    many pairs is a join of two shuffles, which Spark can split."""
    return store(spark, pairs.groupBy("u").agg(F.min("v").alias("least")), "stars")


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, component): component is the smallest node reachable by
    ``links`` (a, b).  Nodes without a link to another node are absent.

    Each round hangs every larger neighbour of a node on its smallest one, then
    every node and its smaller neighbours on the smallest; paths halve until
    the links are stars.  Links stay as many as they were, and each round is
    written, so nothing is recomputed after a failure.
    """
    edges = store(spark, links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .distinct(), "links")
    last = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = _nearest(spark, both).select("u", F.least("u", "least").alias("m"))
        large = both.where("v > u").join(near, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = store(spark, large, "links")
        near = _nearest(spark, large)
        hung = (large.join(near, "u").where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
                .unionAll(near.select("u", F.col("least").alias("v"))))
        edges = store(spark, hung.distinct(), "links")
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (state["n"], state["h"]) == last:
            break
        last = (state["n"], state["h"])
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
