"""Blocked lexical search against a search term by term, small tiles and edge cases."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from llm_fixtures import edge, none  # noqa: F401
from pyspark.sql import functions as F

from hemotab.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    """Sorted (item_id, rank, doc_id, score) of lists of (id, text)."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in held]
    N, L = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for (i, c), n in zip(held, sizes):
            s = 0
            for t in terms(text):
                if c[t]:
                    m = 100 - 75 + (75 * n * N) // L
                    s += math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(docs, items, **more):
    return sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in lexical.top_documents(docs, items, **more).collect()], key=str)


def pairs(df, id_col):
    return [(r[0], r[1]) for r in df.select(id_col, "text").collect()]


def test_small_tiles_groups_and_ties(spark, monkeypatch):
    """Many item groups, tiles of few terms and documents, groups of equal scores."""
    for name, value in (("GROUP_TERMS", 40), ("TILE_CELLS", 30), ("TILE_TERMS", 4), ("TILE_DOCUMENTS", 7), ("CHUNK_BYTES", 16)):
        monkeypatch.setattr(lexical, name, value)
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(30)] + ["Ünï", "X-y", "A1b2"]
    docs = [(i, " ".join(rng.choice(words, rng.integers(0, 30)))) for i in range(80)]
    docs += [(i, "w1 w2, W2 same") for i in range(100, 160)] + [(i, None) for i in range(160, 165)]
    items = [(f"q{i}", " ".join(rng.choice(words, rng.integers(0, 12)))) for i in range(25)] + [("same", "same same w2"), ("none", "zzz")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    q = spark.createDataFrame(items, "item_id string, text string").repartition(3)
    assert found(d, q, k=6) == brute(docs, items, 6)


def test_long_runs_without_a_break(monkeypatch):
    monkeypatch.setattr(lexical, "CHUNK_BYTES", 4)
    for text in ("abcdefghijk lm", "a b c d e f", "abcd efgh", "....abcdefgh....", "abcdefgh", "", " ", "ab cdefghijklmnop q", "Äbcdé fgh"):
        got = [t for some in lexical.term_lists(text.encode()) for t in some]
        assert [t.decode() for t in got] == terms(text)


def test_partial_sums_stay_exact(spark):
    """An item that repeats a term so often that one product would pass 2^53."""
    weight = np.array([25_000, 7, 0], np.int64)
    tiles = lexical.item_tiles([(0, np.array([0, 1, 2]), np.array([10**6, 3, 5], np.int64)), (1, np.array([1]), np.array([10**10], np.int64))], weight)
    whole = np.zeros((2, 3), np.int64)
    for terms_, w in tiles[0].parts:
        assert (w.sum(axis=1) * lexical.MOST_IMPACT).max() < 2**53
        for j, t in enumerate(terms_):
            whole[:, t] += w[:, j].astype(np.int64)
    assert whole.tolist() == [[25_000 * 10**6, 21, 0], [0, 7 * 10**10, 0]]
    impact, numbers, docs = np.array([999_999, 999_983]), np.array([0, 1], np.int32), np.array([0, 0])
    got = lexical._scores(tiles[0], numbers, docs, impact, 1, 3)
    assert got[:, 0].tolist() == [25_000 * 10**6 * 999_999 + 21 * 999_983, 7 * 10**10 * 999_983]


def test_edges(spark, edge, none):
    items = spark.createDataFrame([(1, "word idiot"), (1, "word idiot"), (None, "same TEXT w3"), (2, None), (3, ""), (4, "ünïcödé id"), (5, "?!")],
                                  "item_id int, text string").withColumns({"rank": F.lit(1), "score": F.lit("x"), "doc_id": F.lit(0)})
    assert found(edge, items) == brute(pairs(edge, "doc_id"), pairs(items, "item_id"))
    assert found(none, items) == [] and found(edge, items.limit(0)) == []


@pytest.mark.parametrize("k", [1, 10])
def test_documents(spark, k):
    """sf0.001, whole texts."""
    root = "/root/testdata/sf0.001"
    d, q = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "benchmark"))
    assert found(d, q, k=k) == brute(pairs(d, "doc_id"), pairs(q, "item_id"), k)
