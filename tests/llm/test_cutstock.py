"""Cutting-stock packing: round trip, edge cases, the linear program."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import edge, none  # noqa: F401
from tokenizers import Tokenizer

from hemotab.llm import cutstock
from hemotab.llm.queries import QUERIES

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def reference(docs):
    """(id, ids) of every row, by the tokenizer alone."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return [(r["doc_id"], [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1])
            for r in docs.select("doc_id", "text").collect()]


def check(docs, packed, capacity):
    """Every id in one piece, checksums, places without holes, padding."""
    want, rows = reference(docs), packed.collect()
    by_id, held = defaultdict(list), defaultdict(list)
    for i, ids in want:
        by_id[i].append(ids)
    at = defaultdict(list)
    for r in rows:
        at[r["sequence_id"]].append((r["offset"], r["length"]))
        held[r["doc_id"]].append(r)
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end and length > 0
            end += length
        assert end <= capacity
    assert held.keys() == by_id.keys()
    for i, pieces in held.items():
        # Rows that share an id: their pieces are those of all their texts.
        got = Counter((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in pieces)
        starts = defaultdict(list)
        for s, n, crc, total in got.elements():
            starts[total].append((s, n, crc))
        for ids in by_id[i]:
            mine, end = starts[len(ids)], 0
            while end < len(ids):
                hit = next(p for p in sorted(mine) if p[0] == end
                           and p[2] == zlib.crc32(np.array(ids[end:end + p[1]], "<u4").tobytes()))
                mine.remove(hit)
                end += hit[1]
            assert end == len(ids)
        assert not any(starts.values())
    sizes = [sum(n for _, n in places) for places in at.values()]
    padding = sum(capacity - s for s in sizes if s & (s - 1))
    return sum(sizes), padding, sum(r["length"] < r["doc_tokens"] for r in rows)


def test_packing_without_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tokens, padding, _ = check(docs, QUERIES["op13_cutting_stock"](spark, "/root/testdata/sf0.001"), 2048)
    assert tokens == sum(len(ids) for _, ids in reference(docs)) and padding == 0


def test_packing_edges(spark, edge, none):
    _, padding, _ = check(edge, cutstock.pack(edge.repartition(5), TOKENIZER, capacity=64), 64)
    assert padding == 0
    assert cutstock.pack(none, TOKENIZER).count() == 0
    held = cutstock.pack(edge, TOKENIZER, capacity=64, with_ids=True).collect()
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in held)


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    capacity = 64
    counts = {int(k): int(n) for k, n in zip(rng.permutation(capacity)[:30] + 1, rng.integers(1, 200, 30))}
    p = cutstock.plan(counts, capacity)
    filled = defaultdict(list)
    for length, n in counts.items():
        streamed = p.streamed.get(length, 0)
        for rank in range(n):
            if rank < streamed:
                parts = list(cutstock.cuts(p, length, rank))
            else:
                first, base, at = p.slots[length]
                k = int(np.searchsorted(first, rank, side="right")) - 1
                parts = [(0, length, int(base[k]) + rank - int(first[k]), int(at[k]))]
            assert sum(x[1] for x in parts) == length
            for _, size, sequence, offset in parts:
                filled[sequence].append((offset, size))
    for places in filled.values():
        end = 0
        for offset, size in sorted(places):
            assert offset == end
            end += size
        assert end == capacity or end & (end - 1) == 0


def test_linear_program_reaches_the_known_optimum():
    """Halves and thirds with an odd rest: known fewest sequences."""
    # 90 of 40 and 60 of 60 in 100: pairs (60, 40) 60 times, (40, 40) 15 times.
    lengths, counts = np.array([40, 60]), np.array([90, 60])
    found = cutstock.fractional(lengths, counts, 100)
    assert sum(x for _, x in found) == pytest.approx(75)
    # Patterns cover each length exactly, whatever the mix; simplex steps never do worse than the first patterns.
    rng = np.random.default_rng(5)
    lengths = np.sort(rng.permutation(np.arange(20, 70))[:25])
    counts = rng.integers(1, 50, 25)
    for gap, steps in ((0.0, 0), (0.0, 500)):
        found = cutstock.fractional(lengths, counts, 128, gap, steps)
        covered = np.zeros(25)
        for p, x in found:
            assert sum(int(lengths[k]) * c for k, c in p.items()) <= 128
            for k, c in p.items():
                covered[k] += c * x
        assert covered == pytest.approx(counts)
        if not steps:
            first = sum(x for _, x in found)
    assert sum(x for _, x in found) <= first + 1e-6


def test_simplex_steps_improve_a_poor_start():
    """Lengths over a third of the capacity: two a sequence, and the prices of a
    solution without gaps mislead; the program must find the true bound."""
    lengths, counts = np.array([34, 35, 51, 52, 70]), np.array([40, 40, 40, 40, 40])
    found = cutstock.fractional(lengths, counts, 104, gap=0.0)
    # 70 + 34 (40), 52 + 52 (20), 35 + 51 (40): 100; every sequence holds two.
    assert sum(x for _, x in found) == pytest.approx(100, abs=1e-6)
