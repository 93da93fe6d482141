"""Secret scans over an incremental blob ledger.

Every historical version of a path is content-addressed (SHA-256 of its
text).  The ledger has one row per scanned blob: the rule versions it was
scanned with and the spans they found.  A run scans only the (blob, rule
version) pairs that the ledger lacks, adds them, and joins the findings back
to all paths that hold the blob.

Positions come from built-in functions only: ``split`` by a rule's pattern
gives the text between its matches, ``regexp_extract_all`` the matches
themselves, and running sums of their lengths are the offsets.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hemotab.llm.common import store, text_or_empty


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The base rules in their listed order.  A run of one character class with at
# least n characters is the same as the unbounded run of n or more.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
         2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE_RULES + MORE_RULES

LEDGER = ("blob string, rules array<string>, "
          "spans array<struct<start: int, rank: int, kind: string, version: int, end: int>>")


def _matches(rule: Rule, rank: int):
    """The rule's matches of ``body`` as structs of lengths, in text order."""
    pattern = F.lit(rule.pattern)
    lengths = lambda a: F.transform(a, F.length)
    zipped = F.arrays_zip(
        lengths(F.split("body", rule.pattern, -1)).alias("gap"),
        lengths(F.regexp_extract_all("body", pattern, F.lit(0))).alias("len"),
        lengths(F.regexp_extract_all("body", pattern, F.lit(rule.group))).alias("value"))
    found = F.transform(zipped, lambda m, i: F.struct(
        F.lit(rank).alias("rank"), i.alias("nth"), m["gap"].alias("gap"), m["len"].alias("len"),
        m["value"].alias("value")))
    due = F.array_contains("rules", rule.key) & F.col("body").rlike(rule.pattern)
    return F.when(due, found)


def _spans(blobs: DataFrame, rules) -> DataFrame:
    """blob, spans of blobs (blob, rules, body); blobs without a span are absent."""
    nothing = F.array().cast("array<struct<rank: int, nth: int, gap: int, len: int, value: int>>")
    arrays = [F.coalesce(_matches(r, i), nothing) for i, r in enumerate(rules)]
    each = blobs.select("blob", F.explode(F.concat(*arrays)).alias("m")).select("blob", "m.*").where("len is not null")
    # Few rows from here on, all of a blob in one partition.  Repeated rows of
    # a path and version hold a blob more than once; each match counts once.
    each = each.repartition("blob").dropDuplicates(["blob", "rank", "nth"])
    order = Window.partitionBy("blob", "rank").orderBy("nth")
    end = F.sum(F.col("gap") + F.col("len")).over(order)
    pick = lambda f: reduce(lambda c, x: c.when(F.col("rank") == x[0], f(x[1])), enumerate(rules), F)
    placed = (each.withColumn("end", end.cast("int"))
              .where(F.col("value") >= pick(lambda r: F.lit(r.least)))
              .withColumn("span", F.struct((F.col("end") - F.col("len")).cast("int").alias("start"), "rank",
                                           pick(lambda r: F.lit(r.kind)).alias("kind"),
                                           pick(lambda r: F.lit(r.version)).alias("version"), "end")))
    return placed.groupBy("blob").agg(F.sort_array(F.collect_list("span")).alias("spans"))


def scan(versions: DataFrame, path_cols=("path", "version"), text_col: str = "text", *,
         ledger: DataFrame | None = None, rules=RULES) -> tuple[DataFrame, DataFrame]:
    """(findings, additions to the ledger).

    findings: one row per row of ``versions`` with its path columns, blob and
    spans (of ``rules``' current versions, by start, then rule order; code
    points, end exclusive).  additions: a row for each blob with pairs that
    ``ledger`` lacks; append them to it.  Null text counts as empty, null or
    repeated paths are rows like any other, an empty table gives two empty
    results, and other columns are not read.
    """
    spark = versions.sparkSession
    names = [f"p{i}" for i in range(len(path_cols))]
    body = text_or_empty(text_col)
    held = versions.select(*[F.col(c).alias(n) for c, n in zip(path_cols, names)], body.alias("body"),
                           F.sha2(body.cast("binary"), 256).alias("blob"))
    wanted = F.array(*[F.lit(r.key) for r in rules])
    # One holder per blob stands for its text: copies collapse in the map tasks,
    # and only ids and digests are shuffled.
    blobs = held.groupBy("blob").agg(F.min(F.struct(*names)).alias("holder")).select("blob", "holder.*")
    if ledger is None:
        pairs = blobs.withColumn("rules", wanted)
    else:
        seen = ledger.groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("seen"))
        pairs = (blobs.join(seen, "blob", "left")
                 .withColumn("rules", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
                 .drop("seen"))
    due = store(spark, pairs.where(F.size("rules") > 0), "secret-due")
    same = reduce(lambda a, n: a & held[n].eqNullSafe(due[n]), names, held["blob"] == due["blob"])
    texts = (held.join(due.hint("shuffle_hash"), same)
             .select(due["blob"], due["rules"], held["body"]))
    found = _spans(texts, rules)
    none = F.array().cast(LEDGER.split("spans ")[1])
    additions = store(spark, due.select("blob", "rules").join(found, "blob", "left")
                      .select("blob", "rules", F.coalesce("spans", none).alias("spans")), "secret-ledger")
    known = additions if ledger is None else additions.unionByName(ledger.select(*additions.columns))
    current = F.filter("spans", lambda s: F.array_contains(wanted, F.concat_ws("@", s["kind"], s["version"])))
    if ledger is None:
        by_blob = known.where(F.size("spans") > 0).select("blob", current.alias("spans"))
    else:
        by_blob = (known.where(F.size("spans") > 0).select("blob", current.alias("spans")).groupBy("blob")
                   .agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans")))
    findings = (held.drop("body").join(by_blob, "blob", "left")
                .select(*[F.col(n).alias(c) for c, n in zip(path_cols, names)], "blob",
                        F.coalesce("spans", none).alias("spans")))
    return findings, additions


def digest(findings: DataFrame, id_col: str) -> DataFrame:
    """Counts and joined spans of the findings per path."""
    label = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    joined = lambda a: F.array_join(F.transform(a, label), ",")
    base = [r.kind for r in BASE_RULES]
    return findings.select(
        id_col, *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(joined(of(*base)).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
