"""kNN join, mixing, packing and the pipeline against brute force, and their edge cases."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import edge, none, small_documents, tiny_labels  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from hemotab.llm import graph, jaccard, knn, mixing, packing
from hemotab.llm.queries import QUERIES

SMALL, CHECK = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# --- kNN ------------------------------------------------------------------------------
def brute_top(vectors, queries, k):
    x = {i: [math.floor(64 * c) for c in v] for i, v in vectors}
    out = {}
    for q in queries:
        s = sorted((-sum(a * b for a, b in zip(x[q], x[i])), i) for i in x if i != q)
        out[q] = [(i, -n) for n, i in s[:k]]
    return out


@pytest.mark.parametrize("block,chunk,per_group", [(16, 3, 5), (10_000, 1000, 512)])
def test_knn_clusters_ties_and_scale(spark, monkeypatch, block, chunk, per_group):
    monkeypatch.setattr(knn, "BLOCK_VECTORS", block)
    monkeypatch.setattr(knn, "CHUNK_QUERIES", chunk)
    monkeypatch.setattr(knn, "QUERIES_PER_GROUP", per_group)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8)) * 10
    vectors = [(i, [float(c) for c in centres[i % 6] * (1 + i % 3) + rng.normal(size=8) * 0.1]) for i in range(240)]
    vectors += [(i, [0.5] * 8) for i in range(240, 300)]            # a group of copies: ties by id
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(4)
    got = defaultdict(list)
    for r in knn.top_k(df, F.col("id") % 5 == 0, k=7).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert dict(got) == brute_top(vectors, range(0, 300, 5), 7)


def test_knn_large_integers_are_exact(spark):
    vectors = [(i, [1e6 + i, -2e6 * i, 3.25]) for i in range(30)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in knn.top_k(df, F.col("id") == 3, k=5, scale=64).orderBy("rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert dict(got) == brute_top(vectors, [3], 5)


def test_knn_edges(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (None, [1.0, 1.0]),
            (5, [2.0]), (6, []), (20, [0.0, 1.0]), (20, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit("x"), "score": F.lit("y"), "rank": F.lit(0)})
    got = knn.top_k(df, F.col("id") % 20 == 0).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"]) for r in got] == [(0, 5), (0, 6), (0, 20), (0, 20), (20, 0), (20, 5), (20, 6)]
    assert knn.top_k(df.limit(0), F.col("id") % 20 == 0).count() == 0
    assert knn.top_k(df, F.lit(False)).count() == 0


# --- components -----------------------------------------------------------------------
def test_components_of_paths_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + k) for k in range(1, 50)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = {r["node"]: r["component"] for r in graph.components(spark, spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + k: 100 for k in range(50)}, **{k: 200 for k in (200, 201, 202)}}
    assert graph.components(spark, spark.createDataFrame([], "a long, b long")).count() == 0


# --- mixing ------------------------------------------------------------------------------
def plain_solve(tokens, *, target_entropy=None, most_repeats=None, budget=None):
    """(exponent, weights, repeats) by plain bisection over lists."""
    def weights(a):
        raw = [(t / sum(tokens)) ** a if t else 0.0 for t in tokens]
        return [x / sum(raw) for x in raw]

    def repeats(a):
        ratio = [w / t if t else 0.0 for w, t in zip(weights(a), tokens)]
        return [r * (budget or 1 / min(r for r in ratio if r > 0)) for r in ratio]

    def least(ok):
        low, high = 0.0, 1.0
        if ok(low):
            return low
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (low, middle) if ok(middle) else (middle, high)
        return high

    a = 1.0 if target_entropy is None and most_repeats is None else 0.0
    if target_entropy is not None:
        a = max(a, least(lambda x: -sum(w * math.log(w) for w in weights(x) if w > 0) <= target_entropy))
    if most_repeats is not None:
        a = max(a, least(lambda x: max(repeats(x)) <= most_repeats))
    return a, weights(a), repeats(a)


@pytest.mark.parametrize("options", [{"target_entropy": 0.9}, {"most_repeats": 3.0}, {"most_repeats": 100.0}, {},
                                     {"target_entropy": 0.9, "most_repeats": 2.0, "budget": 1500.0}, {"most_repeats": 1.5, "budget": 2000.0}])
def test_exponent_meets_entropy_and_repeats(spark, options):
    tokens = [1000, 300, 10, 0, 10]
    totals = spark.createDataFrame([(t,) for t in tokens], "tokens long")
    shares = mixing.Shares(totals)
    full = {"target_entropy": None, "most_repeats": None, "budget": None} | options
    a = shares.solve(**full)
    assert a == pytest.approx(plain_solve(tokens, **options)[0], abs=1e-12)
    shares.prepare([a])
    if full["target_entropy"] and not full["most_repeats"]:
        assert shares.entropy(a) == pytest.approx(0.9, abs=1e-9)
    if full["most_repeats"] == 3.0:
        assert shares.most_repeats(a, None) == pytest.approx(3.0)
    nothing = mixing.Shares(totals.where("tokens = 0"))
    assert nothing.solve(**full) == 1.0 and nothing.whole == 0


@pytest.mark.parametrize("rows_per_bucket", [3, 4096])
def test_mix_brute_force(spark, monkeypatch, rows_per_bucket):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", rows_per_bucket)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("source", F.when(F.col("doc_id") % 3 > 0, "big").when(F.col("doc_id") % 2 > 0, "small"))
    rows = mixing.mix(docs, most_repeats=1.7).collect()
    text = {r["doc_id"]: r for r in docs.collect()}
    size = {i: len((r["text"] or "").encode().split()) + 1 for i, r in text.items()}
    totals = Counter()
    for i, r in text.items():
        totals[r["source"]] += size[i]
    names = sorted(totals, key=str)
    _, weights, repeats = plain_solve([totals[s] for s in names], most_repeats=1.7)
    by = defaultdict(list)
    for r in rows:
        assert r["n_tokens"] == size[r["doc_id"]] and r["source"] == text[r["doc_id"]]["source"]
        by[r["source"], r["block"]].append(r)
    for s, times, w in zip(names, repeats, weights):
        whole = int(times + 1e-9)
        for b in range(whole):
            assert sorted(r["doc_id"] for r in by[s, b]) == sorted(i for i in text if text[i]["source"] == s)
        budget = (times - whole) * totals[s]
        part = by.get((s, whole), [])
        used = sum(r["n_tokens"] for r in part)
        assert used <= budget + 1e-6
        if budget > 1:      # the next in order would not fit
            assert used + max(size.values()) > budget
        assert all(r["weight"] == pytest.approx(w) for b in range(whole) for r in by[s, b])
    for group in by.values():
        assert sorted(r["position"] for r in group) == list(range(len(group)))
    again = Counter(r["doc_id"] for r in mixing.Mix(docs, most_repeats=1.7).documents().collect())
    assert again == Counter(r["doc_id"] for r in rows)


def test_mix_more_sources_than_are_broadcast(spark, monkeypatch):
    """Many sources, many of them with equal totals: no cap, the same rows."""
    rows = [(i, f"s{i % 300}", "w " * (1 + i % 300 % 7 + i % 11)) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    want = sorted(map(tuple, mixing.mix(docs, most_repeats=1.7).collect()))
    for name in ("BROADCAST_SOURCES", "MOST_SOURCES"):      # MOST_SOURCES: the cap that was
        monkeypatch.setattr(mixing, name, 20, raising=False)
    assert sorted(map(tuple, mixing.mix(docs, most_repeats=1.7).collect())) == want
    totals = Counter()
    for _, source, text in rows:
        totals[source] += len(text.split()) + 1
    weights = dict(zip(totals, plain_solve(list(totals.values()), most_repeats=1.7)[1]))
    assert {r[1]: r[2] for r in want} == pytest.approx(weights)


def test_mix_edges(edge, none):
    rows = mixing.mix(edge, most_repeats=2.0).collect()
    assert {r["source"] for r in rows} == {"s", "big", None}
    assert len([r for r in rows if r["block"] == 0]) == edge.count()
    assert mixing.mix(none, most_repeats=2.0).count() == 0
    out = mixing.Mix(edge, most_repeats=2.0).documents()
    assert out.columns == edge.columns and out.count() == len(rows)
    half = mixing.mix(edge, budget=50_000.0).collect()
    assert 0 < sum(r["n_tokens"] for r in half) <= 50_000


# --- packing -------------------------------------------------------------------------------
def check_packing(rows, texts, capacity):
    """Exact round trip, whole sequences without gaps."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for i, t in texts}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for i, pieces in by_doc.items():
        pieces.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        at = 0
        for r in pieces:
            part = np.array(ids[i][at:at + r["length"]], "<u4").tobytes()
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(part)
            assert r["piece"] == 0 or r["length"] == capacity
            at += r["length"]
        assert at == len(ids[i]) and len(pieces) == -(-len(ids[i]) // capacity)
    for members in by_sequence.values():
        members.sort(key=lambda r: r["offset"])
        at = 0
        for r in members:
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_sequence), sum(map(len, ids.values()))


def test_packing_round_trip(spark):
    rows = QUERIES["op9_complement_packing"](spark, SMALL).collect()
    sequences, tokens = check_packing(rows, small_documents(), 1024)
    assert sequences <= math.ceil(tokens / 1024) * 1.05


def test_packing_odd_texts(spark):
    texts = ["", None, " ", "  a  b   c", "a \n b", "\n x", "x<|endoftext|> y", "a  b", " lead", "trail ", "　 z   q", "a\t\t  \tb c  ", "word " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.pack(df, TOKENIZER, capacity=16, with_ids=True).collect()
    check_packing(rows, list(enumerate(texts)), 16)
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in rows)


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    draw = [lambda: rng.integers(1, 1025, 20_000), lambda: np.minimum(1024, rng.geometric(0.004, 20_000)),
            lambda: rng.integers(1, 1025, 40), lambda: np.full(999, 300)][seed]
    counts = Counter(draw().tolist())
    patterns, used = packing.plan(counts), Counter()
    for lengths, times in patterns:
        assert sum(lengths) <= 1024 and times > 0
        for k in lengths:
            used[k] += times
    assert used == counts
    bound = max(-(-sum(k * n for k, n in counts.items()) // 1024), sum(n for k, n in counts.items() if k > 512))
    assert sum(t for _, t in patterns) <= 1.01 * bound + (999 // 3 if seed == 3 else 2)


def test_packing_edges(edge, none):
    rows = packing.pack(edge, TOKENIZER)
    assert rows.select("doc_id").distinct().count() == edge.select("doc_id").distinct().count()
    assert rows.where("piece = 0").count() == edge.count() and packing.pack(none, TOKENIZER).count() == 0
    assert rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


# --- pipeline ------------------------------------------------------------------------------
def test_pipeline_stages(spark):
    """Every stage against a brute-force version on what its predecessor kept."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        out = stage(spark, docs, SMALL)
        after = out.collect()
        kept[name] = len(after)
        if name == "toxicity":
            assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before} and len(after) >= 0.8 * len(before)
        elif name == "exact_dedup":
            last = {}
            for r in before:
                last[r["text"] or ""] = max(r["doc_id"], last.get(r["text"] or "", -1))
            assert sorted(r["doc_id"] for r in after) == sorted(last.values())
        elif name == "jaccard_join":
            from test_text_operators import brute_components

            found = brute_components([(r["doc_id"], r["text"]) for r in before], 5, 80, 100)
            assert sorted(r["doc_id"] for r in after) == sorted(i for i, (_, c) in found.items() if i == c)
        elif name == "temperature_mixing":
            uses = Counter(r["doc_id"] for r in after)
            assert set(uses) == {r["doc_id"] for r in before} and max(uses.values()) <= 2
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
            docs = spark.createDataFrame(after, out.schema) if after else docs.limit(0)
    texts = [(k, r["text"]) for k, r in enumerate(before)]
    pieces = sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in after)
    from tokenizers import Tokenizer

    tokenizer, want = Tokenizer.from_file(TOKENIZER), []
    for k, t in texts:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        cuts = [0, *range((len(ids) - 1) % 1024 + 1, len(ids) + 1, 1024)]
        want += [(before[k]["doc_id"], p, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert pieces == sorted(want)


def test_pipeline_edges(spark, edge, none, tiny_labels, tmp_path):
    tiny_labels.write.parquet(f"file://{tmp_path}/labels.parquet")
    for docs in (edge, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, f"file://{tmp_path}")
            assert name == "complement_packing" or out.columns == docs.columns
            out.count()
