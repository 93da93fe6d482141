"""The external suffix sorter against sorting by comparison."""

from __future__ import annotations

import numpy as np
import pytest

from hemotab.llm import induced


def brute(raw, cap):
    order = sorted(range(len(raw)), key=lambda i: raw[i:], reverse=True)
    lcp = [0]
    for a, b in zip(order, order[1:]):
        n = 0
        while n < cap and max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
            n += 1
        lcp.append(n)
    return order, lcp


@pytest.mark.parametrize("most", [3, 1 << 20])
def test_order_and_common_prefixes(most):
    """``most`` = 3 sends nearly all tuples through files."""
    rng = np.random.default_rng(most)
    for trial in range(300):
        t = rng.integers(97, 97 + rng.integers(1, 5), rng.integers(1, 60)).astype(np.uint8)
        t = np.tile(t[:max(1, len(t) // 4)], 4) if trial % 3 == 0 else t
        cap = int(rng.integers(1, 20))
        pieces = list(induced.descending(t, 256, cap, most))
        order, lcp = brute(t.tobytes(), cap)
        assert np.concatenate([a for a, _ in pieces]).tolist() == order
        assert np.concatenate([x for _, x in pieces]).tolist() == lcp


def test_prefix_lengths_of_bytes_and_at_the_end():
    rng = np.random.default_rng(4)
    for cap in (0, 1, 7, 8, 9, 100):
        t = np.append(np.tile(rng.integers(0, 3, 23).astype(np.uint8), 8), np.zeros(9, np.uint8))
        a, b = rng.integers(0, len(t), 400), rng.integers(0, len(t), 400)
        wide = induced.prefix_lengths(t.astype(np.int64), a, b, cap)       # symbol by symbol
        assert induced.prefix_lengths(t, a, b, cap).tolist() == wide.tolist()


def test_doubling_sorts_only_what_is_not_settled(monkeypatch):
    """One long repeat in a string of many names: later rounds sort that alone."""
    rng = np.random.default_rng(6)
    names = rng.permutation(5000)
    names = np.concatenate([names, names[:300], [9999]])
    sizes, argsort = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda x, *a, **k: (sizes.append(len(x)), argsort(x, *a, **k))[1])
    order = induced._doubling(names)
    monkeypatch.undo()
    assert order.tolist() == sorted(range(len(names)), key=lambda i: names[i:].tolist())
    assert sum(sizes) < 3 * len(names)


def test_empty():
    assert list(induced.descending(np.zeros(0, np.uint8), 256, 5)) == []
