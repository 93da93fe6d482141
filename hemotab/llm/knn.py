"""Exact top-k by inner product as a Voronoi join.

Queries are grouped by their nearest pivot p.  With u the largest distance of
a group's queries to p, every query q and vector x satisfy

    p.x - u |x|  <=  q.x  <=  p.x + u |x| .

The (k+1)-th largest lower bound over all vectors (each task keeps its k+1
largest per group, a summary of fixed size) is a score that every query of the
group reaches k times without its own row, so only vectors whose upper bound
reaches it are sent to the group.  A group is split into blocks of vectors and
chunks of queries of bounded size, each solved locally; the blocks' best are
merged by rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hemotab.llm.common import store

K = 20
SCALE = 64
QUERIES_PER_GROUP = 512     # aimed at, for the number of pivots
MOST_PIVOTS = 256
BLOCK_VECTORS = 16384
CHUNK_QUERIES = 1024


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """id and x = floor(scale * component); rows with a null id, a null
    vector or a null or non-finite component are left out."""
    bad = F.exists(vector_col, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & ~bad)
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(vector_col, lambda c: F.floor(F.lit(float(scale)) * c.cast("double"))).alias("x")))


def _matrix(column: pd.Series, dtype: str, dim: int) -> np.ndarray:
    """Rows of stored vectors; float64 where every inner product is exact in it."""
    raw = np.frombuffer(b"".join(column), dtype).reshape(len(column), dim)
    return raw.astype(np.int64)


def _products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    return (a.astype(float) @ b.astype(float).T).astype(np.int64) if exact else a @ b.T


def top_k(vectors: DataFrame, is_query: Column, *, k: int = K, scale: int = SCALE, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest inner products
    of quantised vectors, ties to the smaller id, its own id left out.

    ``is_query`` is a condition on a column named ``id``.  Shorter vectors
    count as padded with zeros.  Repeated rows are candidates each; a repeated
    query id is answered once, for its smallest vector.  Empty tables, or no
    query, give no rows.  Other columns are not read.
    """
    spark = vectors.sparkSession
    base = quantised(vectors, id_col, vector_col, scale)
    size = base.agg(F.max(F.size("x")).alias("dim"), F.count(F.when(is_query, 1)).alias("queries"),
                    F.max(F.array_max(F.transform("x", F.abs))).alias("largest")).first()
    dim, largest = max(size["dim"] or 1, 1), size["largest"] or 0
    dtype = "<i2" if largest < 1 << 15 else "<i4" if largest < 1 << 31 else "<i8"
    exact = dim * largest * largest < 1 << 53

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            raw = []
            for v in b["x"]:
                full = np.zeros(dim, dtype)
                full[:len(v)] = v
                raw.append(full.tobytes())
            yield pd.DataFrame({"id": b["id"], "x": raw})

    data = store(spark, base.mapInPandas(packed, "id long, x binary"), "knn-vectors")
    asked = data.where(is_query).groupBy("id").agg(F.min("x").alias("x"))

    # Pivots: a bounded sample of the vectors, the first by a hash of their id.
    most = min(MOST_PIVOTS, max(1, -(-size["queries"] // QUERIES_PER_GROUP)))
    picked = data.orderBy(F.xxhash64("id"), "id", "x").limit(most).toPandas()
    pivots = _matrix(picked["x"], dtype, dim).astype(float) if len(picked) else np.zeros((1, dim))

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = _matrix(b["x"], dtype, dim).astype(float)
            far = (x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)[None]
            cell = far.argmin(1)
            away = np.sqrt(((x - pivots[cell]) ** 2).sum(1)) if len(b) else np.zeros(0)
            yield b.assign(cell=cell.astype(np.int32), away=away)

    queries = store(spark, asked.mapInPandas(nearest, "id long, x binary, cell int, away double"), "knn-queries")
    groups = {r["cell"]: r for r in queries.groupBy("cell").agg(F.max("away").alias("radius"), F.count(F.lit(1)).alias("n")).collect()}
    cells = sorted(groups)  # MOST_PIVOTS at most
    centre = pivots[cells] if cells else np.zeros((0, dim))
    radius = np.array([groups[c]["radius"] for c in cells]) * (1 + 1e-9) + 1e-6

    def bounds(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = x.astype(float)
        middle, slack = x @ centre.T, np.sqrt((x * x).sum(1))[:, None] * radius[None]
        guard = 1e-9 * (np.abs(middle) + slack) + 1e-6
        return middle - slack - guard, middle + slack + guard

    def largest_lower(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = np.empty((0, len(cells)))
        for b in batches:
            best = np.sort(np.vstack([best, bounds(_matrix(b["x"], dtype, dim))[0]]), axis=0)[-(k + 1):]
        yield pd.DataFrame({"g": np.repeat(np.arange(len(cells)), len(best)), "low": best.T.ravel()})

    order = Window.partitionBy("g").orderBy(F.desc("low"))
    lows = (data.mapInPandas(largest_lower, "g int, low double").withColumn("nth", F.row_number().over(order))
            .where(F.col("nth") == k + 1).collect())
    reach = np.full(len(cells), -np.inf)
    for r in lows:
        reach[r["g"]] = r["low"]

    def reached(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros(len(cells), np.int64)
        for b in batches:
            n += (bounds(_matrix(b["x"], dtype, dim))[1] >= reach[None]).sum(0)
        yield pd.DataFrame({"g": np.arange(len(cells)), "n": n})

    sent = {r["g"]: r["n"] for r in data.mapInPandas(reached, "g int, n long").groupBy("g").agg(F.sum("n").alias("n")).collect()}
    blocks = np.array([max(1, -(-sent.get(g, 0) // BLOCK_VECTORS)) for g in range(len(cells))], np.int64)
    chunks = np.array([max(1, -(-groups[c]["n"] // CHUNK_QUERIES)) for c in cells], np.int64)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            hit = bounds(_matrix(b["x"], dtype, dim))[1] >= reach[None]
            for g in range(len(cells)):
                part = b[hit[:, g]]
                for chunk in range(chunks[g]):
                    yield part.assign(g=g, chunk=chunk, block=part["h"] % blocks[g]).drop(columns="h")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = {c: g for g, c in enumerate(cells)}
        for b in batches:
            for cell, part in b.groupby("cell"):
                g = place[cell]
                for block in range(blocks[g]):
                    yield pd.DataFrame({"id": part["id"], "x": part["x"], "g": g, "chunk": part["h"] % chunks[g], "block": block})

    def solve(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(v):
            v = v.sort_values("id")
            ids, scores = v["id"].to_numpy(), _products(_matrix(q["x"], dtype, dim), _matrix(v["x"], dtype, dim), exact)
            for query, row in zip(q["id"].tolist(), scores):
                able = np.flatnonzero(ids != query)
                if len(able) > k:
                    s = row[able]
                    able = able[s >= np.partition(s, len(s) - k)[len(s) - k]]
                best = able[np.argsort(-row[able], kind="stable")[:k]]
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids[best], "score": row[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

    spread = F.pmod(F.xxhash64("id"), F.lit(1 << 30)).alias("h")
    keyed = "id long, x binary, g int, chunk long, block long"
    wanted = data.select("id", "x", spread).mapInPandas(send, keyed)
    asking = queries.select("id", "x", "cell", spread).mapInPandas(ask, keyed)
    local = (asking.groupBy("g", "chunk", "block").cogroup(wanted.groupBy("g", "chunk", "block"))
             .applyInPandas(solve, "query_id long, vec_id long, score long"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return local.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
