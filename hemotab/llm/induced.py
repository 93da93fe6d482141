"""Suffix sorting by external induced sorting.

The suffixes that start a fall-to-rise of the text (LMS suffixes) are sorted
by recursion on the string of their names.  Two scans induce all others: upwards
each suffix hands the suffix before it, if that is larger, to the queue of its
first symbol; downwards likewise for smaller ones.  A queue is first in, first
out: scans reach suffixes in their order, so what they hand on arrives in
order, and the queues together are a priority queue by (first symbol, arrival).

Each tuple carries the common prefix with its neighbour in the queue: one more
than the least among the suffixes scanned since that queue last received one.
Values are exact up to ``cap``.  Queues keep tuples in memory up to a bound
and on disk beyond it; the text and one bit per symbol stay in memory.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

WIDE = np.iinfo(np.int32).max


class Queues:
    """FIFO queues of (position, common prefix) by symbol.  When all of them
    hold more than ``most`` tuples in memory, the longest goes to its file."""

    def __init__(self, most: int):
        self.most, self.held, self.memory, self.files = most, 0, {}, {}

    def put(self, symbol: int, at: np.ndarray, lcp: np.ndarray) -> None:
        self.memory.setdefault(symbol, []).append((at, lcp))
        self.held += len(at)
        while self.held > self.most:
            longest = max(self.memory, key=lambda s: sum(len(a) for a, _ in self.memory[s]))
            # Scratch of this task alone, gone when it is closed; a task run again sorts again.
            file = self.files.setdefault(longest, None) or tempfile.TemporaryFile()
            self.files[longest] = file
            for a, l in self.memory.pop(longest):
                np.save(file, a)
                np.save(file, l)
                self.held -= len(a)

    def take(self, symbol: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """All there is for ``symbol``, in order of arrival, in few pieces."""
        out, size, file = [[]], 0, self.files.pop(symbol, None)
        if file:
            end = file.tell()
            file.seek(0)
            while file.tell() < end:
                out[-1].append((np.load(file), np.load(file)))
                size += len(out[-1][-1][0])
                if size > self.most:
                    out.append([])
                    size = 0
            file.close()
        held = self.memory.pop(symbol, [])
        self.held -= sum(len(a) for a, _ in held)
        out[-1] += held
        return [p[0] if len(p) == 1 else tuple(np.concatenate(c) for c in zip(*p)) for p in out if p]


def rising(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each suffix is smaller than the next (the empty one is the
    smallest), and how many equal symbols it starts with."""
    n = len(t)
    heads = np.flatnonzero(np.append(True, t[1:] != t[:-1]))
    sizes = np.diff(np.append(heads, n))
    up = np.append(t[heads[1:]] > t[heads[:-1]], False)
    ends = np.repeat(heads + sizes, sizes)
    return np.repeat(up, sizes), (ends - np.arange(n)).astype(np.int32)


def _by_symbol(symbols: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The values of each symbol, in order."""
    if not len(symbols):
        return
    order = np.argsort(symbols, kind="stable")
    sorted_ = symbols[order]
    heads = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
    values = values[order]
    for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(order)]):
        yield int(sorted_[a]), values[a:b]


class _Carry:
    """Least common prefix since each symbol's queue last received a tuple."""

    def __init__(self, symbols: int):
        self.least = np.full(symbols, 0, np.int32)

    def hand(self, chosen: np.ndarray, to: np.ndarray, lcp: np.ndarray, cap: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(symbol, indexes among the scanned, their common prefixes).

        ``lcp[i]`` is between scanned i and i - 1 (before the first: what was
        scanned last); ``chosen`` are the indexes that hand on, ``to`` the
        symbols they hand to.
        """
        total = lcp.min() if cap else 0
        received = {}
        for symbol, at in _by_symbol(to, chosen):
            if not cap:  # the order alone is wanted
                yield symbol, at, np.zeros(len(at), np.int32)
                continue
            starts = np.append(0, at[:-1] + 1)
            least = np.minimum.reduceat(lcp[:at[-1] + 1], starts)
            least[0] = min(least[0], self.least[symbol])
            received[symbol] = lcp[at[-1] + 1:].min() if at[-1] + 1 < len(lcp) else WIDE
            yield symbol, at, np.minimum(least + 1, cap).astype(np.int32)
        np.minimum(self.least, total, out=self.least)
        for symbol, value in received.items():
            self.least[symbol] = value


def _scan(t, up, runs, seeds: Queues, symbols: int, cap: int, most: int) -> Queues:
    """The upward scan: from sorted LMS suffixes, all falling suffixes."""
    falling, carry, kept = Queues(most), _Carry(symbols), Queues(most)
    # The last suffix follows the empty one, the smallest of all.
    falling.put(int(t[-1]), np.array([len(t) - 1]), np.array([0], np.int32))
    for c in range(symbols):
        last_run, first = 0, True
        work = falling.take(c)
        while work:
            for at, lcp in work:
                if first:
                    lcp = lcp.copy()
                    lcp[0], first = 0, False
                kept.put(c, at, lcp)
                last_run = int(runs[at[-1]])
                chosen = np.flatnonzero((at > 0) & ~up[at - 1])
                for symbol, i, l in carry.hand(chosen, t[at[chosen] - 1], lcp, cap):
                    falling.put(symbol, at[i] - 1, l)
            work = falling.take(c)
        for at, lcp in seeds.take(c):
            lcp = lcp.copy()
            if not first and last_run:
                lcp[0], last_run = min(last_run, int(runs[at[0]]), cap), 0
            elif first:
                lcp[0], first = 0, False
            chosen = np.flatnonzero(at > 0)
            for symbol, i, l in carry.hand(chosen, t[at[chosen] - 1], lcp, cap):
                falling.put(symbol, at[i] - 1, l)
    return kept


def _reversed(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Backwards; common prefixes are then with the suffix after."""
    after = 0
    for at, lcp in reversed(parts):
        yield at[::-1], np.append(np.int32(after), lcp[:0:-1])
        after = lcp[0]


def _descend(t, up, runs, falling: Queues, symbols: int, cap: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The downward scan: all suffixes, the largest first, in pieces of
    (positions, common prefix with the one before it in this order)."""
    rise, carry = Queues(most), _Carry(symbols)
    for c in range(symbols - 1, -1, -1):
        first, last_run = True, 0
        work = rise.take(c)
        while work:
            for at, lcp in work:
                if first:
                    lcp = lcp.copy()
                    lcp[0], first = 0, False
                yield at, lcp
                last_run = int(runs[at[-1]])
                chosen = np.flatnonzero((at > 0) & up[at - 1])
                for symbol, i, l in carry.hand(chosen, t[at[chosen] - 1], lcp, cap):
                    rise.put(symbol, at[i] - 1, l)
            work = rise.take(c)
        for at, lcp in _reversed(falling.take(c)):
            if last_run:
                lcp[0], last_run = min(last_run, int(runs[at[0]]), cap), 0
            elif first:
                lcp[0] = 0
            first = False
            yield at, lcp
            chosen = np.flatnonzero((at > 0) & up[at - 1])
            for symbol, i, l in carry.hand(chosen, t[at[chosen] - 1], lcp, cap):
                rise.put(symbol, at[i] - 1, l)


def _seeds(t: np.ndarray, lms: np.ndarray, lcp: np.ndarray, most: int) -> Queues:
    """LMS suffixes in the given order as queues by their first symbol."""
    out = Queues(most)
    for symbol, k in _by_symbol(t[lms], np.arange(len(lms))):
        out.put(symbol, lms[k], lcp[k])
    return out


def prefix_lengths(t: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefix, up to cap, of the suffixes at a and at b."""
    out, open_ = np.zeros(len(a), np.int32), np.arange(len(a))
    if t.dtype == np.uint8 and cap:
        return _by_eights(t, a, b, cap, out, open_)
    for k in range(cap):
        x, y = a[open_] + k, b[open_] + k
        inside = (x < len(t)) & (y < len(t))
        open_ = open_[inside]
        open_ = open_[t[x[inside]] == t[y[inside]]]
        if not len(open_):
            break
        out[open_] += 1
    return out


def _by_eights(t: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int, out: np.ndarray, open_: np.ndarray) -> np.ndarray:
    """``prefix_lengths`` of bytes, eight compared at a time; zeros follow the end."""
    eight = np.ndarray(len(t) + 1, "<u8", np.append(t, np.zeros(8, np.uint8)), strides=(1,))
    room = np.minimum(len(t) - np.maximum(a, b), cap)
    for k in range(0, cap, 8):
        x = eight[a[open_] + k] ^ eight[b[open_] + k]
        differ = x != 0
        bits = np.frexp((x[differ] & -x[differ]).astype(np.float64))[1] - 1      # the lowest one that differs
        out[open_[differ]] = k + (bits >> 3)
        open_ = open_[~differ]
        out[open_] = k + 8
        open_ = open_[room[open_] > k + 8]
        if not len(open_):
            break
    return np.minimum(out, room).astype(np.int32)


def _doubling(names: np.ndarray) -> np.ndarray:
    """Suffix order of a string over many symbols, by doubling of ranks: a rank is
    how many suffixes are smaller, and only suffixes of equal rank are sorted again."""
    n, step = len(names), 1
    order = np.argsort(names, kind="stable")
    first = np.append(True, names[order[1:]] != names[order[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    open_ = np.flatnonzero(~(first & np.append(first[1:], True)))    # places in the order that are not settled
    while len(open_):
        at = order[open_]
        nxt = np.zeros(len(at), np.int64)
        inside = at + step < n
        nxt[inside] = rank[at[inside] + step] + 1
        key = rank[at] * (n + 2) + nxt               # the rank first, so each stays within the places of its equals
        by = np.argsort(key)
        key, at = key[by], at[by]
        order[open_] = at
        first = np.append(True, key[1:] != key[:-1])
        rank[at] = open_[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        open_ = open_[~(first & np.append(first[1:], True))]
        step *= 2
    return order


def _order(names: np.ndarray, most: int) -> np.ndarray:
    """Suffix order of a string of names, by recursion while scans by symbol pay."""
    symbols = int(names.max()) + 1 if len(names) else 0
    if symbols == len(names):
        return np.argsort(names, kind="stable")
    if symbols * 64 > len(names):
        return _doubling(names)
    return np.concatenate([at for at, _ in descending(names, symbols, 0, most)])[::-1]


def _names(t: np.ndarray, up: np.ndarray, lms: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Names of the LMS substrings (each up to and with the next LMS symbol), by rank."""
    size = np.diff(np.append(lms, len(t))) + 1
    at, length = lms[order], size[order]
    same = np.append(False, length[1:] == length[:-1])
    # A substring that reaches the end of the text equals no other.
    same &= (at + length <= len(t)) & np.append(False, at[:-1] + length[:-1] <= len(t))
    open_ = np.flatnonzero(same)
    k = 0
    while len(open_):
        differ = t[at[open_] + k] != t[at[open_ - 1] + k]
        same[open_[differ]] = False
        k += 1
        open_ = open_[~differ]
        open_ = open_[length[open_] > k]
    out = np.zeros(len(lms), np.int64)
    out[order] = np.cumsum(~same) - 1
    return out


def descending(t: np.ndarray, symbols: int, cap: int, most: int = 1 << 24) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes of ``t`` (numbers below ``symbols``), the largest first, in
    pieces of (positions, common prefix with the suffix before, at most ``cap``)."""
    if not len(t):
        return
    up, runs = rising(t)
    lms = np.flatnonzero(up[1:] & ~up[:-1]) + 1
    none = np.zeros(len(lms), np.int32)
    if len(lms) > 1:
        # Induce from unsorted LMS suffixes: sorts their substrings.
        falling = _scan(t, up, runs, _seeds(t, lms, none, most), symbols, 0, most)
        is_lms = np.zeros(len(t), bool)
        is_lms[lms] = True
        sorted_ = np.concatenate([at[is_lms[at]] for at, _ in _descend(t, up, runs, falling, symbols, 0, most)])[::-1]
        names = _names(t, up, lms, np.searchsorted(lms, sorted_))
        lms = lms[_order(names, most)]
        none = np.append(np.int32(0), prefix_lengths(t, lms[1:], lms[:-1], cap))
    falling = _scan(t, up, runs, _seeds(t, lms, none, most), symbols, cap, most)
    yield from _descend(t, up, runs, falling, symbols, cap, most)
