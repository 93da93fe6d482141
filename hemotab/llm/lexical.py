"""Ranked lexical search by dense blocked matrix products.

Queries (items) are few against the documents: they are dealt into groups of a
bounded number of terms, and each group is searched in all documents.  A group's
vocabulary goes to the tasks, which count its terms in every document (whole
texts, kept as two short arrays) and the documents that hold each term.

Scores are integers.  For a tile of items, its own vocabulary (and no more) is
cut into tiles of terms; a tile of items times terms holds the weights, a tile
of terms times documents the impacts, both in float64, and BLAS multiplies
them.  Terms are cut so that no partial sum can reach 2^53, where float64 would
stop being exact; the partial sums are added as 64-bit integers.  Of each
product, every score that can still be among an item's best is kept, ties
included; the best of the tasks are merged by Spark, ties by document id.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemotab.llm.common import store, sum_arrays, text_bytes

GROUP_TERMS = 1 << 16      # distinct terms of items, summed, in a group (one item at least)
TILE_CELLS = 1 << 21       # of items x terms
TILE_TERMS = 1024
TILE_DOCUMENTS = 1024
EXACT = 1 << 53
MOST_IMPACT = 1_000_000    # 10^9 tf div (1000 tf + 8 m) is below it
SALTS = 64
CHUNK_BYTES = 1 << 20      # of a text at a time
COUNT_CHUNK = 1 << 14
NO_ID = (1 << 63) - 1

# Terms are runs of digits, ASCII letters (lower-cased) and everything beyond ASCII.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
                    for b in range(256))


def term_lists(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, some at a time."""
    at = 0
    while at < len(text):
        end = at + CHUNK_BYTES
        if end < len(text):
            plain = text[at:end].translate(_TERM_BYTES)
            cut = plain.rfind(b" ")
            while cut < 0 and end < len(text):       # a term longer than the chunk
                more = text[end:end + CHUNK_BYTES].translate(_TERM_BYTES)
                gap = more.find(b" ")
                plain, end = plain + (more if gap < 0 else more[:gap + 1]), end + (len(more) if gap < 0 else gap + 1)
                cut = len(plain) if gap >= 0 else -1
            cut = len(plain) if cut < 0 else cut
        else:
            plain = text[at:].translate(_TERM_BYTES)
            cut = len(plain)
        yield plain[:cut].split()
        at += max(cut, 1)


# --- items -------------------------------------------------------------------------------
def _items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row, id, terms (joined by blanks), counts of every item, in groups of at most GROUP_TERMS."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nth = size = 0
        for b in batches:
            rows = []
            for i, task, text in zip(b["id"], b["task"], b["text"]):
                terms = Counter()
                for some in term_lists(text):
                    terms.update(some)
                names = sorted(terms)
                rows.append((task, nth, size, i, b" ".join(names), np.array([terms[t] for t in names], "<i8").tobytes()))
                nth, size = nth + 1, size + len(names)
            yield pd.DataFrame(rows, columns=["task", "nth", "size", "id", "terms", "counts"])

    spark = items.sparkSession
    rows = items.select(F.col(id_col).cast("string").alias("id"), text_bytes(text_col).alias("text"),
                        F.spark_partition_id().cast("long").alias("task"))
    counted = store(spark, rows.mapInPandas(count, "task long, nth long, size long, id string, terms binary, counts binary"), "lexical-items")
    per_task = counted.groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("size") + F.octet_length("counts") / 8).alias("s"))
    earlier = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row a task of the items
    before = per_task.select("task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rows"),
                             F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("sizes"))
    return store(spark, counted.join(before, "task").select(
        (F.col("rows") + F.col("nth")).alias("row"), ((F.col("sizes") + F.col("size")) / GROUP_TERMS).cast("long").alias("group"),
        "id", "terms", "counts"), "lexical-groups")


@dataclass
class Tile:
    """Items' rows, and per tile of terms: the terms' numbers and the weights."""

    rows: np.ndarray
    parts: list[tuple[np.ndarray, np.ndarray]]


def item_tiles(items: list[tuple[int, np.ndarray, np.ndarray]], weight: np.ndarray) -> list[Tile]:
    """Dense tiles of (row, term numbers, counts): each over its items' own terms,
    cut where a sum of weights times the greatest impact could reach 2^53."""
    out: list[Tile] = []
    most = (EXACT - 1) // MOST_IMPACT

    def close(some: list[tuple[int, np.ndarray, np.ndarray]], terms: list[int]) -> None:
        terms = np.array(sorted(terms), np.int64)
        whole = np.zeros((len(some), len(terms)), np.int64)
        for k, (_, t, c) in enumerate(some):
            whole[k, np.searchsorted(terms, t)] = c * weight[t]
        parts, start = [], 0
        while start < len(terms):
            total = np.cumsum(whole[:, start:start + TILE_TERMS].max(axis=0))
            n = int(np.searchsorted(total, most, side="right"))
            if n:
                parts.append((terms[start:start + n], whole[:, start:start + n].astype(np.float64)))
                start += n
            else:  # one weight alone is too large: in several summands
                parts.append((terms[start:start + 1], np.minimum(whole[:, start:start + 1], most).astype(np.float64)))
                whole[:, start] -= np.minimum(whole[:, start], most)
        out.append(Tile(np.array([r for r, _, _ in some], np.int64), parts))

    some, terms = [], set()
    for row, t, c in items:
        alive = weight[t] > 0
        t, c = t[alive], c[alive]
        if not len(t):
            continue
        if some and (len(some) + 1) * len(terms | set(t.tolist())) > TILE_CELLS:
            close(some, list(terms))
            some, terms = [], set()
        some.append((row, t, c))
        terms |= set(t.tolist())
    if some:
        close(some, list(terms))
    return out


# --- documents -----------------------------------------------------------------------------
def _term_counts(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """id, n (terms with repeats) and the numbers and counts of the vocabulary's terms of every document."""
    table = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = table.value
        for b in batches:
            rows = []
            for i, text in zip(b["id"], b["text"]):
                n, found = 0, Counter()
                for some in term_lists(text):
                    n += len(some)
                    found.update(filter(known.__contains__, some))
                terms = np.array([known[t] for t in found], "<i4")
                rows.append((i, n, terms.tobytes(), np.array(list(found.values()), "<i8").tobytes()))
            yield pd.DataFrame(rows, columns=["id", "n", "terms", "counts"])

    # A null id sorts last.
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), text_bytes(text_col).alias("text"))
    return rows.mapInPandas(run, "id long, n long, terms binary, counts binary")


def _statistics(held: DataFrame, size: int) -> tuple[np.ndarray, int, int]:
    """Documents that hold each term, documents with a term, all terms with repeats."""
    chunks = -(-(size + 2) // COUNT_CHUNK)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, part = np.zeros(chunks * COUNT_CHUNK, np.int64), 0
        for b in batches:
            part = int(b["part"].iloc[0]) if len(b) else part
            total[:size] += np.bincount(np.frombuffer(b"".join(b["terms"]), "<i4"), minlength=size)[:size]
            total[size] += int((b["n"] > 0).sum())
            total[size + 1] += int(b["n"].sum())
        yield pd.DataFrame([(k, part, total[k * COUNT_CHUNK:(k + 1) * COUNT_CHUNK].tobytes()) for k in range(chunks)],
                           columns=["chunk", "part", "counts"])

    rows = held.select("n", "terms", (F.spark_partition_id() % SALTS).alias("part"))
    total = sum_arrays(rows.mapInPandas(run, "chunk int, part int, counts binary"), chunks * COUNT_CHUNK, COUNT_CHUNK, "<i8")
    return total[:size], int(total[size]), int(total[size + 1])


@dataclass
class _Best:
    """The best (score, id) of each item of a tile so far, by falling score, then id."""

    items: int
    k: int

    def __post_init__(self):
        self.item, self.id, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.ones(self.items, np.int64)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores``: items x documents.  All that tie with the k-th stay until ids decide."""
        floor = self.floor
        if scores.shape[1] > self.k:
            floor = np.maximum(floor, np.partition(scores, -self.k, axis=1)[:, -self.k])
        item, doc = np.nonzero(scores >= floor[:, None])
        if not len(item):
            return
        item, at, score = (np.concatenate(p) for p in ((self.item, item), (self.id, ids[doc]), (self.score, scores[item, doc])))
        order = np.lexsort((at, -score, item))
        item = item[order]
        nth = np.arange(len(item)) - np.searchsorted(item, item)
        order, item, nth = order[nth < self.k], item[nth < self.k], nth[nth < self.k]
        self.item, self.id, self.score = item, at[order], score[order]
        full = nth == self.k - 1
        self.floor[item[full]] = self.score[full]


def _scores(tile: Tile, numbers: np.ndarray, docs: np.ndarray, impact: np.ndarray, n: int, size: int) -> np.ndarray:
    """Items x documents: exact partial products, added as integers."""
    total = np.zeros((len(tile.rows), n), np.int64)
    for terms, weights in tile.parts:
        place = np.full(size, -1, np.int64)
        place[terms] = np.arange(len(terms))
        here = place[numbers]
        hit = here >= 0
        if hit.any():
            dense = np.zeros((len(terms), n))
            dense[here[hit], docs[hit]] = impact[hit]
            total += (weights @ dense).astype(np.int64)
    return total


def _search(held: DataFrame, tiles: list[Tile], size: int, documents: int, length: int, k: int) -> DataFrame:
    """row, id, score: the best k documents of each item in each task."""
    table = held.sparkSession.sparkContext.broadcast(tiles)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tiles = table.value
        best = [_Best(len(t.rows), k) for t in tiles]
        for b in batches:
            b = b[b["terms"].map(len) > 0]
            for at in range(0, len(b), TILE_DOCUMENTS):
                part = b.iloc[at:at + TILE_DOCUMENTS]
                numbers = np.frombuffer(b"".join(part["terms"]), "<i4")
                tf = np.frombuffer(b"".join(part["counts"]), "<i8")
                docs = np.repeat(np.arange(len(part)), part["terms"].map(len).to_numpy() // 4)
                # Whole numbers of any size until the division.
                m = np.array([25 + 75 * int(n) * documents // length for n in part["n"]], np.int64)
                impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[docs])
                ids = part["id"].to_numpy()
                for t, kept in zip(tiles, best):
                    kept.add(ids, _scores(t, numbers, docs, impact, len(part), size))
        for t, kept in zip(tiles, best):
            yield pd.DataFrame({"row": t.rows[kept.item], "id": kept.id, "score": kept.score})

    return held.mapInPandas(run, "row long, id long, score long")


def _nth(*keys: str) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "id"))


def top_documents(docs: DataFrame, items: DataFrame, *, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Each item's ``k`` best documents with a score above 0: ``item_id_col``,
    rank (from 1), ``id_col``, score.

    Document ids are integers; a null id sorts behind all others, and rows that
    share an id are documents of their own.  So are rows that share an item id,
    each with its own ranks.  Null and empty texts, and items whose terms no
    document holds, have no rows; nor has an empty table.  Other columns are
    not read.
    """
    spark: SparkSession = docs.sparkSession
    grouped = _items(items, item_id_col, item_text_col)
    parts = []
    for r in grouped.select("group").distinct().orderBy("group").toLocalIterator():
        # One group at a time: GROUP_TERMS and one item at most.
        group = grouped.where(F.col("group") == r["group"]).orderBy("row").collect()
        names = sorted({t for g in group for t in bytes(g["terms"]).split()})
        if not names:
            continue
        number = {t: i for i, t in enumerate(names)}
        held = store(spark, _term_counts(docs, number, id_col, text_col), "lexical-terms")
        df, documents, length = _statistics(held, len(names))
        weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) if n else 0 for n in df], np.int64)
        sparse = [(g["row"], np.array([number[t] for t in bytes(g["terms"]).split()], np.int64), np.frombuffer(g["counts"], "<i8"))
                  for g in group]
        tiles = item_tiles(sparse, weight)
        if tiles:
            found = _search(held, tiles, len(names), documents, length, k)
            # Tasks first in a bounded number of parts, so that no item's rows grow with the tasks.
            some = found.withColumn("salt", F.spark_partition_id() % SALTS).withColumn("rank", _nth("row", "salt")).where(F.col("rank") <= k)
            parts.append(store(spark, some.drop("salt", "rank").withColumn("rank", _nth("row")).where(F.col("rank") <= k), "lexical-best"))
    found = spark.createDataFrame([], "row long, id long, score long, rank int") if not parts else parts[0]
    for p in parts[1:]:
        found = found.unionAll(p)
    named = grouped.select("row", F.col("id").alias("item"))
    kind = {c: t for c, t in (("item", items.schema[item_id_col].dataType), ("doc", docs.schema[id_col].dataType))}
    return found.join(named, "row").select(
        F.col("item").cast(kind["item"]).alias(item_id_col), F.col("rank").cast(T.IntegerType()).alias("rank"),
        F.when(F.col("id") != NO_ID, F.col("id")).cast(kind["doc"]).alias(id_col), "score")
