"""Packing as a cutting-stock problem, solved by column generation.

Documents become pieces of at most ``capacity`` tokens: whole blocks of a long
document fill a sequence each, and one piece is left.  Only the histogram of
piece lengths (``capacity`` rows, however many documents there are) comes to
the driver.  There a *pattern* is a list of lengths that fit into a sequence,
and the linear program asks how often each pattern is used so that every
length is used up by the fewest sequences.  Knapsack dynamic programming over
prices of the lengths makes the columns: first over the prices of a solution
without gaps, while lengths are left, which gives a basis; then over the dual
prices of that basis, and patterns that improve it enter by simplex steps until
the bound of the dual prices shows that no solution is better by more than
``gap`` (or after ``STEPS`` steps: only the plan differs then, no row is lost).

Whole uses of patterns are taken, fractions as far as lengths are left, and
what remains is packed best-fit.  Sequences with the largest gaps are then
given up: their pieces form a stream that is cut to fill the gaps of the
others, further sequences of full length and, at the end, sequences whose
sizes are powers of two.  So no sequence is padded, and few documents are cut.

Spark gives each piece its rank among the pieces of its length (counts per
task, running sums; no task sees a whole length), and the rank names the
pattern, sequence and offset, or the place in the stream.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hemotab.llm.common import store, text_bytes
from hemotab.llm.packing import Encoder

CAPACITY = 2048
END_ID = 1
GAP = 0.002          # of the fewest sequences possible, at which the linear program stops
STEPS = 300          # of the simplex method at most
COLUMNS_A_ROUND = 128
FIRST_WEIGHT = 0.125 # of the true prices among the drawn ones
ENCODE_TEXTS = 200   # at a time


# --- the linear program -----------------------------------------------------------------
class Knapsack:
    """Patterns of most value under prices: ``best[w]`` within ``w`` tokens,
    ``last[w]`` the row of the length taken last (-1: a token stays free)."""

    def __init__(self, lengths: np.ndarray, prices: np.ndarray, capacity: int):
        self.lengths = lengths
        self.best, self.last = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
        useful = np.flatnonzero(prices > 0)
        sizes, worth = lengths[useful], prices[useful]
        upto = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
        for w in range(1, capacity + 1):
            k = upto[w]
            self.best[w] = self.best[w - 1]
            if k:
                value = self.best[w - sizes[:k]] + worth[:k]
                i = int(value.argmax())
                if value[i] > self.best[w]:
                    self.best[w], self.last[w] = value[i], useful[i]

    def fill(self, room: int, pattern: Counter, most: np.ndarray | None = None, free: int | None = None) -> Counter | None:
        """``pattern`` with the best rows within ``room``, no row beyond ``most``;
        none if more than ``free`` tokens would stay free."""
        while room > 0:
            i = int(self.last[room])
            if i >= 0 and (most is None or pattern[i] < most[i]):
                pattern[i] += 1
                room -= int(self.lengths[i])
            else:
                room -= 1
                if free is not None:
                    free -= 1
                    if free < 0:
                        return None
        return pattern


Use = tuple[Counter, int, list[int]]


def first_patterns(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[Use]:
    """(pattern, times, rows it uses up) in turn: patterns that the knapsack
    prices, each used until a length runs out.  Prices are the lengths, a
    little more a token for long ones; patterns with gaps wait until none
    without is left."""
    left, out, free = counts.copy(), [], 0
    while left.any():
        rows = np.flatnonzero(left)
        worth = np.zeros(len(lengths))
        worth[rows] = lengths[rows] / capacity * (1 + 1e-4 * lengths[rows] / capacity)
        sack, found = Knapsack(lengths, worth, capacity), False
        for i in rows[::-1].tolist():
            p = sack.fill(capacity - int(lengths[i]), Counter((i,)), left, free) if left[i] else None
            if p:
                times = min(int(left[k]) // c for k, c in p.items())
                for k, c in p.items():
                    left[k] -= times * c
                out.append((p, times, [k for k in p if not left[k]]))
                found = True
        if not found:
            free = max(1, 2 * free)
    return out


def fractional(lengths: np.ndarray, counts: np.ndarray, capacity: int, gap: float = GAP,
               steps: int = STEPS) -> list[tuple[Counter, float]]:
    """Patterns (row -> how many) and how often each is used, fractions allowed:
    within ``gap`` of the fewest sequences, or after ``steps`` simplex steps.

    The first patterns are a basis, since each uses up a length that later ones
    don't hold; those that use up none stay as they are.  Pricing is stabilised:
    the knapsack sees the prices drawn towards ``length / capacity``, the prices
    of a solution without gaps, and only patterns that the true prices accept
    enter.
    """
    ideal, m = lengths / capacity, len(lengths)
    first = first_patterns(lengths, counts, capacity)
    settled = [(p, float(times)) for p, times, rows in first if not rows]
    counts = counts.copy()
    for p, times in settled:
        counts[list(p)] -= np.array(list(p.values())) * int(times)
    basis, used = [], []
    for p, times, rows in first:
        if rows:
            basis += [p, *[Counter({k: capacity // int(lengths[k])}) for k in rows[1:]]]
            used += [float(times), *[0.0] * (len(rows) - 1)]
    fewest, used = float(counts @ ideal), np.array(used)
    if used.sum() > (1 + gap) * fewest:
        matrix = np.zeros((m, m))
        for j, p in enumerate(basis):
            matrix[list(p), j] = list(p.values())
        inverse = np.linalg.inv(matrix)              # rows: basis, columns: lengths
        prices, weight = inverse.sum(axis=0), 1.0
    while used.sum() > (1 + gap) * fewest and steps > 0:
        drawn = weight * prices + (1 - weight) * ideal
        sack = Knapsack(lengths, drawn, capacity)
        # Prices divided by the best value are feasible for the dual: a bound.
        fewest = max(fewest, float(drawn @ counts) / max(1.0, sack.best[capacity]))
        # The best pattern that holds each length, most promising first.
        value, entered = drawn + sack.best[capacity - lengths], 0
        for i in np.argsort(-value)[:4 * COLUMNS_A_ROUND].tolist():
            column = sack.fill(capacity - int(lengths[i]), Counter((i,)))
            rows, n = np.array(list(column)), np.array(list(column.values()), float)
            saved = float(prices[rows] @ n) - 1      # the prices move with each step
            if saved <= 1e-7 or entered == COLUMNS_A_ROUND:
                continue
            step = inverse[:, rows] @ n
            able = np.flatnonzero(step > 1e-7)
            r = int(able[(used[able] / step[able]).argmin()])
            amount = used[r] / step[r]
            used = np.maximum(used - amount * step, 0)
            used[r] = amount
            row = inverse[r] / step[r]
            prices = prices - saved * row
            others = np.flatnonzero(np.abs(step) > 1e-12)
            inverse[others] -= step[others, None] * row
            inverse[r] = row
            basis[r] = column
            entered += 1
        if not entered and weight == 1:
            break
        steps -= max(entered, 1)
        weight = min(1.0, 2 * weight) if entered < COLUMNS_A_ROUND // 8 else FIRST_WEIGHT
    return settled + [(p, float(x)) for p, x in zip(basis, used) if x > 1e-9]


# --- whole sequences ---------------------------------------------------------------------
Pattern = tuple[int, ...]


def whole_patterns(counts: dict[int, int], capacity: int, gap: float = GAP) -> list[tuple[Pattern, int]]:
    """(lengths of a sequence, how many such sequences), using every count up:
    whole parts of the linear program's solution, its fractions as far as
    lengths are left, then best fit."""
    out: list[tuple[Pattern, int]] = []
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n

    def use(pattern: Counter, most: int) -> None:
        times = min([most, *[int(left[k]) // c for k, c in pattern.items()]])
        if times > 0:
            for k, c in pattern.items():
                left[k] -= times * c
            out.append((tuple(sorted(pattern.elements(), reverse=True)), times))

    use(Counter({capacity: 1}), int(left[capacity]))
    while True:
        lengths = np.flatnonzero(left)
        before = int(left.sum())
        if not before:
            break
        solution = [(Counter({int(lengths[i]): c for i, c in p.items()}), x)
                    for p, x in fractional(lengths, left[lengths], capacity, gap)]
        for p, x in solution:
            use(p, int(x + 1e-6))
        for p, x in sorted(solution, key=lambda s: -(s[1] % 1)):
            use(p, 1)
        # Another linear program for the rest while each takes most of it.
        if 2 * int(left.sum()) > before or int(left.sum()) < 64:
            break
    while left.any():
        pattern, room, free = Counter(), capacity, left.copy()
        while room:
            fits = np.flatnonzero(free[:room + 1])
            if not len(fits):
                break
            k = int(fits[-1])
            pattern[k] += 1
            free[k] -= 1
            room -= k
        use(pattern, int(left.sum()))
    return out


@dataclass
class Plan:
    """Where each piece goes.  ``slots``: length -> first rank, first sequence
    and offset of its places, in order of rank.  Ranks below ``streamed`` of a
    length belong to the stream, from token ``base`` on.  ``targets``: places
    the stream fills: first token, size, first sequence and offset."""

    slots: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    streamed: dict[int, int]
    base: dict[int, int]
    targets: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def plan(counts: dict[int, int], capacity: int = CAPACITY, gap: float = GAP) -> Plan:
    patterns = [(capacity - sum(p), p, n) for p, n in whole_patterns(counts, capacity, gap)]
    patterns.sort(key=lambda x: x[0])
    # As many sequences as possible stay, those with small gaps first, while
    # the pieces of the others can fill the gaps.
    rest = sum((capacity - g) * n for g, _, n in patterns)
    room, kept, given_up = 0, [], Counter()
    for g, p, n in patterns:
        # room + k * g <= rest - k * (capacity - g)
        k = min(n, max(0, (rest - room) // capacity))
        room, rest = room + k * g, rest - k * (capacity - g)
        if k:
            kept.append((g, p, k))
        for length in p:
            given_up[length] += n - k
    taken, slots, targets, sequence, at = Counter(given_up), {}, [], 0, 0
    for g, p, n in kept:
        offset = 0
        for length in p:
            slots.setdefault(length, []).append((taken[length], sequence, offset))
            taken[length] += n
            offset += length
        if g:
            targets.append((at, g, sequence, offset))
            at += g * n
        sequence += n
    base, total = {}, 0
    for length, n in given_up.items():
        if n:
            base[length] = total
            total += length * n
    full, tail = divmod(total - at, capacity)
    targets.append((at, capacity, sequence, 0))
    sequence, at = sequence + full, at + full * capacity
    for bit in reversed(range(capacity.bit_length())):
        if tail >> bit & 1:
            targets.append((at, 1 << bit, sequence, 0))
            sequence, at = sequence + 1, at + (1 << bit)
    return Plan({k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in slots.items()},
                {k: n for k, n in given_up.items() if n}, base,
                tuple(np.array(c, np.int64) for c in zip(*targets)))


def cuts(p: Plan, length: int, rank: int) -> Iterator[tuple[int, int, int, int]]:
    """(start in the piece, length, sequence, offset) of the parts of a piece in the stream."""
    first, size, sequence, offset = p.targets
    at, start = p.base[length] + rank * length, 0
    while start < length:
        k = int(np.searchsorted(first, at, side="right")) - 1
        nth, inside = divmod(at - int(first[k]), int(size[k]))
        n = min(length - start, int(size[k]) - inside)
        yield start, n, int(sequence[k]) + nth, int(offset[k]) + inside
        at, start = at + n, start + n


# --- Spark -------------------------------------------------------------------------------
def pieces(docs: DataFrame, tokenizer: str, capacity: int, id_col: str, text_col: str, keep_all: bool) -> DataFrame:
    """id, start, length, ids_crc32, doc_tokens, ids of every piece, with the
    task's number and the rank of the piece among the task's of its length.
    Full blocks are never cut again and need no ids."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, ranks = Encoder(tokenizer), Counter()
        for b in batches:
            for at in range(0, len(b), ENCODE_TEXTS):
                part, rows = b.iloc[at:at + ENCODE_TEXTS], []
                for key, task, ids in zip(part["id"], part["task"], encoder(list(part["text"]))):
                    ids += np.array([END_ID], "<u4").tobytes()
                    n = len(ids) // 4
                    for start in range(0, n, capacity):
                        length = min(capacity, n - start)
                        raw = ids[4 * start:4 * (start + length)]
                        held = raw if keep_all or length < capacity else b""
                        rows.append((key, start, length, zlib.crc32(raw), n, held, task, ranks[length]))
                        ranks[length] += 1
                yield pd.DataFrame(rows, columns=["id", "start", "length", "ids_crc32", "doc_tokens", "ids", "task", "nth"])

    # The id travels as text: pandas would turn integers beside nulls into floats.
    rows = docs.select(F.col(id_col).cast("string").alias("id"), text_bytes(text_col).alias("text"),
                       F.spark_partition_id().cast("long").alias("task"))
    return rows.mapInPandas(cut, "id string, start long, length long, ids_crc32 long, doc_tokens long, ids binary, "
                                 "task long, nth long")


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, gap: float = GAP, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: ``id_col``, start, length, ids_crc32, doc_tokens,
    sequence_id, offset (and ids, little-endian, with ``with_ids``).

    Null and empty texts are a piece of the end id alone.  Null and repeated
    ids, and repeated rows, are packed like any other row; an empty table
    gives no rows; other columns are not read.  ``tokenizer`` is a file that
    every executor can open; ``capacity`` is a power of two.
    """
    spark = docs.sparkSession
    cut = store(spark, pieces(docs, tokenizer, capacity, id_col, text_col, with_ids), "cutstock-pieces")
    per_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    per_task = store(spark, per_task.withColumn("before", F.coalesce(before, F.lit(0))), "cutstock-counts")
    # At most ``capacity`` rows.
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(plan(counts, capacity, gap))
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = table.value
        for b in batches:
            sequence, offset = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            lengths, ranks = b["length"].to_numpy(), b["rank"].to_numpy()
            streamed = np.zeros(len(b), bool)
            order = np.argsort(lengths, kind="stable")
            for group in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(b) else []:
                length = int(lengths[group[0]])
                streamed[group] = ranks[group] < p.streamed.get(length, 0)
                group = group[~streamed[group]]
                if len(group):
                    first, base, at = p.slots[length]
                    k = np.searchsorted(first, ranks[group], side="right") - 1
                    sequence[group], offset[group] = base[k] + ranks[group] - first[k], at[k]
            b = b.assign(sequence_id=sequence, offset=offset)
            yield b.loc[~streamed, names]
            rows = []
            for r in b[streamed].itertuples(index=False):
                for start, n, seq, off in cuts(p, r.length, r.rank):
                    raw = r.ids[4 * start:4 * (start + n)]
                    crc = r.ids_crc32 if n == r.length else zlib.crc32(raw)
                    rows.append((r.id, r.start + start, n, crc, r.doc_tokens, seq, off, *([raw] * with_ids)))
            if rows:
                yield pd.DataFrame(rows, columns=names)

    ranked = (cut.join(per_task.select("length", "task", "before"), ["length", "task"])
              .select("id", "start", "length", "ids_crc32", "doc_tokens", "ids", (F.col("before") + F.col("nth")).alias("rank")))
    placed = ranked.mapInPandas(place, "id string, start long, length long, ids_crc32 long, doc_tokens long, "
                                       "sequence_id long, offset long" + ", ids binary" * with_ids)
    return placed.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).withColumnRenamed("id", id_col)
