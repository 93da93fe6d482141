"""Mixing sources by temperature.

A source's weight is its token share to the power of an exponent between 0
(uniform) and 1 (proportional), normalised.  The exponent is bisected until
the weights have a wanted entropy, or until no source repeats more often than
a limit.  Weights times a token budget say how often each source is gone
through; a pass is a block, in which the source's documents stand in an order
of their own (by a hash of seed, block, id and text).  Whole blocks hold every
document; a last, partial block holds the first documents of its order whose
tokens fit what is left of the source's budget.

Without a budget, the largest budget is taken that the least repeated source
meets with exactly one block, so every document is used at least once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hemotab.llm.common import store, text_or_empty

BROADCAST_SOURCES = 100_000     # one row each; with more sources, plans are joined by a shuffle
BUCKET_ROWS = 4096


def words_and_end(text_col: str) -> Column:
    """Tokens of a text: its words and one end."""
    return F.regexp_count(text_or_empty(text_col), F.lit(r"[^\x20\x09-\x0D]+")).cast("long") + 1


LEVELS = 6         # steps of the bisection that one job prepares


def _bisect(high_ok: Callable[[float], bool], prepare: Callable[[Iterable[float]], None] = lambda points: None) -> float:
    """The smallest exponent in [0, 1] for which ``high_ok``; 1 if there is none.
    ``prepare`` is told all points that the next steps may ask for."""
    low, high = 0.0, 1.0
    prepare([low])
    if high_ok(low):
        return low
    for step in range(60):
        if step % LEVELS == 0:
            ends = [(low, high)]
            points = []
            for _ in range(LEVELS):
                points += [(a + b) / 2 for a, b in ends]
                ends = [x for a, b in ends for x in ((a, (a + b) / 2), ((a + b) / 2, b))]
            prepare(points)
        middle = (low + high) / 2
        low, high = (low, middle) if high_ok(middle) else (middle, high)
    return high


class Shares:
    """Sums over the sources with tokens, each a Spark aggregate in decimals, so
    that the order of rows changes no digit.  The driver sees sums only."""

    def __init__(self, totals: DataFrame):
        self.same = totals.where("tokens > 0").groupBy("tokens").agg(F.count(F.lit(1)).alias("alike"))
        size = self.same.agg(F.sum(F.col("tokens").cast("decimal(38,0)") * F.col("alike")).cast("double").alias("whole"),
                             F.min("tokens").alias("least"), F.max("tokens").alias("most")).first()
        self.whole, self.least, self.most = size["whole"] or 0.0, size["least"], size["most"]
        self.sums: dict[float, tuple[float, float]] = {}

    def power(self, exponent: float) -> Column:
        return F.pow(F.col("tokens") / F.lit(self.whole), F.lit(exponent))

    def prepare(self, exponents: Iterable[float]) -> None:
        """Sum of s ** a, and of s ** a ln s, over the shares s, for each exponent a."""
        new = [a for a in dict.fromkeys(exponents) if a not in self.sums]
        total = lambda c: F.sum((F.col("alike") * c).cast("decimal(38,20)")).cast("double")
        log = F.log(F.col("tokens") / F.lit(self.whole))
        row = self.same.agg(*[x for a in new for x in (total(self.power(a)), total(self.power(a) * log))]).first() if new else ()
        for k, a in enumerate(new):
            self.sums[a] = row[2 * k], row[2 * k + 1]

    def entropy(self, exponent: float) -> float:
        """Of the weights, in nats."""
        power, logs = self.sums[exponent]
        return math.log(power) - exponent * logs / power

    def most_repeats(self, exponent: float, budget: float | None) -> float:
        """Of the source with the fewest tokens: no other one repeats more often."""
        if budget is None:
            return (self.most / self.least) ** (1 - exponent)
        return (self.least / self.whole) ** exponent / self.sums[exponent][0] / self.least * budget

    def solve(self, target_entropy: float | None, most_repeats: float | None, budget: float | None) -> float:
        """The exponent.  Of a target entropy (nats) and a limit on repeats, the
        one that asks for the larger exponent rules; without both it is 1."""
        if not self.whole or (target_entropy is None and most_repeats is None):
            return 1.0
        exponent = 0.0
        if target_entropy is not None:
            exponent = max(exponent, _bisect(lambda a: self.entropy(a) <= target_entropy, self.prepare))
        if most_repeats is not None:
            ready = {"prepare": self.prepare} if budget is not None else {}
            exponent = max(exponent, _bisect(lambda a: self.most_repeats(a, budget) <= most_repeats, **ready))
        return exponent


class Mix:
    """The plan of a mixture; see ``rows`` and ``documents``."""

    def __init__(self, docs: DataFrame, *, source_col: str = "source", id_col: str = "doc_id", text_col: str = "text",
                 tokens: Column | None = None, target_entropy: float | None = None, most_repeats: float | None = None,
                 budget: float | None = None, seed: int = 17):
        self.docs, self.id_col, self.seed = docs, id_col, seed
        # A null source is a source of its own, apart from the empty name.
        self.key = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null"))
        self.tokens = tokens if tokens is not None else words_and_end(text_col)
        self.body = text_or_empty(text_col)
        spark = docs.sparkSession
        totals = store(spark, docs.select(self.key.alias("key"), self.tokens.alias("t")).groupBy("key")
                       .agg(F.coalesce(F.sum("t"), F.lit(0)).cast("long").alias("tokens"), F.count(F.lit(1)).alias("n")), "mixing-totals")
        self.few = totals.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
        shares = Shares(totals)
        self.exponent = shares.solve(target_entropy, most_repeats, budget)
        some = F.col("tokens") > 0
        if not shares.whole:
            weight = times = F.lit(0.0)
        else:
            shares.prepare([self.exponent])
            weight = F.when(some, shares.power(self.exponent) / F.lit(shares.sums[self.exponent][0])).otherwise(F.lit(0.0))
            times = (weight * F.lit(float(budget)) / F.col("tokens") if budget is not None else
                     F.pow(F.lit(float(shares.most)) / F.col("tokens"), F.lit(1 - self.exponent)))
            times = F.when(some, times).otherwise(F.lit(0.0))
        near = F.rint("times")
        # One row per source.
        self.plan = self._narrow_side(
            totals.withColumn("weight", weight).withColumn("times", times)
            .withColumn("times", F.when(F.abs(F.col("times") - near) < 1e-9 * F.greatest(near, F.lit(1.0)), near).otherwise(F.col("times")))
            .withColumn("whole", F.floor("times").cast("int"))
            .select("key", "weight", "times", "whole", ((F.col("times") - F.col("whole")) * F.col("tokens")).cast("long").alias("rest"),
                    F.greatest(F.lit(1), F.ceil(F.col("n") / BUCKET_ROWS)).cast("long").alias("buckets")))

    def _narrow_side(self, per_source: DataFrame) -> DataFrame:
        return F.broadcast(per_source) if self.few else per_source

    def _order(self, block: Column) -> Column:
        """A non-negative number that orders a block."""
        return F.shiftrightunsigned(F.xxhash64(F.lit(self.seed), block.cast("int"), F.col("id"), F.col("h")), 1)

    def _bucket(self) -> Column:
        """Buckets follow the order, so that no task orders a whole source."""
        return F.floor((F.shiftright("o", 13) * F.col("buckets")) / F.lit(float(1 << 50))).cast("long")

    def _narrow(self) -> DataFrame:
        return (self.docs.select(self.key.alias("key"), F.col(self.id_col).alias("id"), self.tokens.alias("t"),
                                 F.xxhash64(self.body).alias("h")).join(self.plan, "key"))

    def cuts(self) -> DataFrame:
        """key, cut: the last order number that the partial block takes."""
        part = self._narrow().where("rest > 0").withColumn("o", self._order(F.col("whole"))).withColumn("bucket", self._bucket())
        sums = part.groupBy("key", "bucket").agg(F.sum("t").alias("s"))
        before = F.sum("s").over(Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
        sums = sums.select("key", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
        # Only the bucket in which the budget ends has to be ordered.
        edge = sums.join(self.plan, "key").where("before < rest").groupBy("key").agg(F.max(F.struct("bucket", "before")).alias("edge"))
        within = part.join(self._narrow_side(edge.select("key", "edge.bucket", "edge.before")), ["key", "bucket"])
        so_far = F.sum("t").over(Window.partitionBy("key").orderBy("o").rangeBetween(Window.unboundedPreceding, Window.currentRow))
        last = (within.withColumn("c", F.col("before") + so_far).where("c <= rest").groupBy("key").agg(F.max("o").alias("last")))
        first = part.join(self._narrow_side(edge.select("key", F.col("edge.bucket").alias("stop"))), "key").where("bucket < stop") \
            .groupBy("key").agg(F.max("o").alias("full"))
        return (edge.select("key").join(last, "key", "left").join(first, "key", "left")
                .select("key", F.coalesce("last", "full", F.lit(-1).cast("long")).alias("cut")))

    def _copies(self, df: DataFrame) -> DataFrame:
        """``df`` (with key, id, h) once per block that holds the row: block, o."""
        cut = df.join(self._narrow_side(self.cuts()), "key", "left")
        taken = F.col("whole") + F.when(self._order(F.col("whole")) <= F.col("cut"), 1).otherwise(0)
        blocks = F.when(taken > 0, F.sequence(F.lit(0), taken - 1)).otherwise(F.array().cast("array<int>"))
        return cut.withColumn("block", F.explode(blocks)).withColumn("o", self._order(F.col("block")))

    def rows(self) -> DataFrame:
        """id, source key's weight, n_tokens, block and position of every use of a document."""
        used = self._copies(self._narrow()).withColumn("bucket", self._bucket())
        sizes = used.groupBy("key", "block", "bucket").agg(F.count(F.lit(1)).alias("c"))
        before = F.sum("c").over(Window.partitionBy("key", "block").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
        sizes = sizes.select("key", "block", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
        nth = F.row_number().over(Window.partitionBy("key", "block", "bucket").orderBy("o", "id", "h"))
        return (used.withColumn("nth", nth).join(sizes, ["key", "block", "bucket"])
                .select(F.col("id").alias(self.id_col), F.when(F.col("key") != "null", F.expr("substring(key, 2)")).alias("source"),
                        "weight", F.col("t").alias("n_tokens"), "block", (F.col("before") + F.col("nth") - 1).alias("position")))

    def documents(self) -> DataFrame:
        """The rows of ``docs``, each as often as the mixture uses it, with all columns."""
        marked = self.docs.select(F.struct(*self.docs.columns).alias("row"), self.key.alias("key"),
                                  F.col(self.id_col).alias("id"), F.xxhash64(self.body).alias("h"))
        return self._copies(marked.join(self.plan, "key")).select("row.*")


def mix(docs: DataFrame, **options) -> DataFrame:
    """``id_col``, source, weight, n_tokens, block, position: one row per use.

    Null text counts as empty (one token, the end), a null source is a source
    of its own, null and repeated ids are ordered by their text, repeated rows
    enter a partial block together or not at all, an empty table gives no
    rows, and other columns are not read.
    """
    return Mix(docs, **options).rows()
