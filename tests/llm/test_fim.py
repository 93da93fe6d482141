"""Fill-in-the-middle: brute force over code points, exact round trip, edge cases."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import edge, none  # noqa: F401

from hemotab.llm import fim


def brute(key: str, text: str, plain: int = 10, spm: int = 20):
    """By slices of code points."""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    h = [int(hashlib.sha256(f"1:{key}".encode()).hexdigest()[k:k + 8], 16) for k in range(0, 32, 8)]
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < spm else f"<P>{p}<S>{s}<M>{m}"
    return n, "spm" if h[3] % 100 < spm else "psm", len(p), len(m), out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab Zé漢<>PSM\n\0😀1_", max_size=40), st.integers(0, 10_000), st.sampled_from([3, 7, 1 << 20]), st.sampled_from([1, 2, 5]))
def test_texts(text, key, scan, swap):
    held = fim.SCAN_BYTES, fim.SWAP_BYTES
    fim.SCAN_BYTES, fim.SWAP_BYTES = scan, swap
    try:
        n, form, p, m, out = fim.arrange(text.encode(), fim.draws(str(key), 1), 10, 20)
        assert (n, form, p, m, out.decode()) == brute(str(key), text)
        assert fim.rebuild(out, form) == text.encode()
    finally:
        fim.SCAN_BYTES, fim.SWAP_BYTES = held


def test_sentinels_beside_cuts():
    """Pieces of sentinels at the borders don't mislead the way back."""
    for text in ("<<S<M<P", "<", "P><S><", "<P", "S>M>P>", "<M<M<M"):
        for key in range(200):
            n, form, p, m, out = fim.arrange(text.encode(), fim.draws(str(key), 1), 0, 50)
            assert fim.rebuild(out, form).decode() == text
            assert (n, form, p, m, out.decode()) == brute(str(key), text, 0, 50)


@pytest.mark.parametrize("a,b,c", [(0, 0, 5), (0, 3, 9), (2, 9, 9), (1, 70_000, 200_001)])
def test_rotation(a, b, c):
    raw = np.random.default_rng(1).integers(0, 256, c, np.uint8).tobytes()
    buffer = bytearray(raw)
    fim.rotate(buffer, a, b)
    assert bytes(buffer) == raw[:a] + raw[b:] + raw[a:b]


def test_edges(spark, edge, none):
    rows = fim.restore(fim.transform(edge)).collect()
    want = [(r["doc_id"], r["text"] or "") for r in edge.select("doc_id", "text").collect()]
    got = [(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], bytes(r["output"]).decode(), bytes(r["restored"]).decode())
           for r in rows]
    assert sorted(map(str, got)) == sorted(str((i, *brute("" if i is None else str(i), t), t)) for i, t in want)
    assert fim.restore(fim.transform(none)).count() == 0


def test_very_long_text(spark):
    text = "wörd 12 " * 3_000_000
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    r = fim.restore(fim.transform(df)).collect()[0]
    assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], bytes(r["output"]).decode()) == brute("1", text)
    assert bytes(r["restored"]).decode() == text
