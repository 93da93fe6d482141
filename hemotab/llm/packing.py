"""Best-fit packing by exact complements.

Documents become pieces of at most ``capacity`` tokens.  Only the histogram
of piece lengths (``capacity`` rows at most, however many documents there
are) comes to the driver.  There, lengths from the longest down are completed
by a single length, a pair or a triple whose sum fills their gap exactly,
found in indexes of sums under the counts still available; what is left over
is packed best-fit decreasing.  Both give *patterns*, a list of lengths to be
used so many times, and every step uses up a length, so there are at most a
few thousand.  Spark then gives each piece its rank among the pieces of its
length (counts per task, running sums, no task sees a whole length), and the
rank names the pattern, the sequence and the offset.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hemotab.llm.common import store, text_bytes

CAPACITY = 1024
END_ID = 2
CACHED_PARTS = 300_000

# A blank before white space or the end.  Only there can a cut in front of a blank fall inside a pre-token.
_UNSAFE = re.compile(rb"\x20(?:[\x09-\x0D\x1C-\x20]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]"
                     rb"|\xe2\x81\x9f|\xe3\x80\x80|\Z)")


# The pre-tokens of byte-level BPE (fixed value).
PRE_TOKENS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_symbols() -> dict[str, int]:
    """Byte-level BPE writes bytes as printable characters: those that are
    printable in Latin-1 as themselves, the others from U+0100 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def _ranks(path: str) -> tuple[dict[bytes, int] | None, list[bytes]]:
    """(token bytes -> id, if the file is a plain byte-level BPE whose merges
    stand in the order of their ids, else None; the added tokens)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    added = [t["content"].encode() for t in spec.get("added_tokens", [])]
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if (model.get("type", "BPE") != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel"
            or pre.get("add_prefix_space", True) or not pre.get("use_regex", True)):
        return None, added
    symbol = _byte_symbols()
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [model["vocab"].get(m, -1) for m in merged]
    if ids != sorted(set(ids)) or not set(symbol) <= set(model["vocab"]):
        return None, added
    return {bytes(symbol[c] for c in t): i for t, i in model["vocab"].items() if t.encode() not in added}, added


class Encoder:
    """Token ids of texts as little-endian uint32 bytes, equal to the
    tokenizer file's without special tokens.

    A pre-token begins at every blank before a word, so the parts of a text
    from blank to blank can be encoded, and remembered, on their own.  Where the file is a
    plain byte-level BPE, new parts are encoded together by the faster library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.known, self.fast = Tokenizer.from_file(path), {}, None
        ranks, self.added = _ranks(path)
        if ranks:
            import tiktoken

            self.fast = tiktoken.Encoding("parts", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})
            self.size = np.zeros(max(ranks.values()) + 1, np.int64)
            self.size[list(ranks.values())] = [len(t) for t in ranks]

    def _slow(self, parts: list[bytes]) -> list[bytes]:
        texts = [p.decode("utf-8", "replace") for p in parts]
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _alone(self, texts: list[bytes]) -> list[bytes]:
        if not self.fast:
            return self._slow(texts)
        plain = [t for t in texts if not any(a in t for a in self.added)]
        try:
            done = {t: np.array(self.fast.encode_ordinary(t.decode("utf-8")), "<u4").tobytes() for t in plain}
        except UnicodeDecodeError:
            return self._slow(texts)
        rest = [t for t in texts if t not in done]
        done.update(zip(rest, self._slow(rest)))
        return [done[t] for t in texts]

    def _together(self, parts: list[bytes]) -> list[bytes]:
        """Parts that each start with a blank: their tokens never reach across."""
        ids = np.array(self.fast.encode_ordinary(b"".join(parts).decode("utf-8")), "<u4")
        cuts = np.searchsorted(np.cumsum(self.size[ids]), np.cumsum([len(p) for p in parts]))
        raw, at = ids.tobytes(), [0, *(4 * (cuts + 1)).tolist()]
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def _encode(self, parts: list[bytes]) -> dict[bytes, bytes]:
        blank = []
        if self.fast:
            odd = any(t in b"\0".join(parts) for t in self.added)
            blank = [p for p in parts if p[:1] == b" " and not (odd and any(t in p for t in self.added))]
        try:
            out = dict(zip(blank, self._together(blank))) if blank else {}
        except UnicodeDecodeError:
            out = {}
        rest = [p for p in parts if p not in out]
        out.update(zip(rest, self._alone(rest)))
        return out

    def __call__(self, texts: list[bytes]) -> list[bytes]:
        parts, whole = [], set()
        for t in texts:
            if _UNSAFE.search(t):
                parts.append((t,))
                whole.add(t)
            else:
                first, *rest = t.split(b" ")
                parts.append([first, *[b" " + r for r in rest]])
        if len(self.known) > CACHED_PARTS:
            self.known.clear()
        # A whole text and a part that reads the same are the same to the tokenizer,
        # but it may not be joined with parts.
        new = set().union(*parts) - self.known.keys()
        self.known.update(self._encode(list(new - whole)))
        if whole:
            self.known.update(zip(whole, self._alone(list(whole))))
        out = [b"".join(map(self.known.__getitem__, p)) for p in parts]
        for t in whole:  # not worth remembering
            self.known.pop(t, None)
        return out


def pieces(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """id, piece, start, length, ids_crc32 (and ids) of every document, with
    the task's number and the rank of the piece among the task's of its length."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, ranks = Encoder(tokenizer), Counter()
        for b in batches:
            for at in range(0, len(b), 200):
                part = b.iloc[at:at + 200]
                rows = []
                for key, task, ids in zip(part["id"], part["task"], encoder(list(part["text"]))):
                    ids += np.array([END_ID], "<u4").tobytes()
                    n, start, k = len(ids) // 4, 0, 0
                    while start < n:
                        # The first piece takes what the whole pieces after it leave.
                        length = (n - 1) % capacity + 1 if k == 0 else capacity
                        raw = ids[4 * start:4 * (start + length)]
                        rows.append((key, k, start, length, zlib.crc32(raw), task, ranks[length], *([raw] * with_ids)))
                        ranks[length] += 1
                        start, k = start + length, k + 1
                yield pd.DataFrame(rows, columns=names)

    names = ["id", "piece", "start", "length", "ids_crc32", "task", "nth", *["ids"] * with_ids]
    # The id travels as text: pandas would turn integers beside nulls into floats.
    rows = docs.select(F.col(id_col).cast("string").alias("id"), text_bytes(text_col).alias("text"),
                       F.spark_partition_id().cast("long").alias("task"))
    return rows.mapInPandas(cut, "id string, piece int, start long, length long, ids_crc32 long, task long, nth long"
                            + ", ids binary" * with_ids)


class _Lengths:
    """Available lengths with their counts; which sums of one or two remain."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.n = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.n[length] = n

    def single(self, gap: int, used: Counter) -> int | None:
        return gap if 0 < gap <= self.capacity and self.n[gap] > used[gap] else None

    def pair(self, gap: int, used: Counter) -> tuple[int, int] | None:
        """a >= b with a + b = gap, a as long as can be."""
        a = np.arange(gap - 1, (gap - 1) // 2, -1)
        ok = (self.n[a] > 0) & (self.n[gap - a] > 0)
        for x in a[ok].tolist():
            need = Counter((x, gap - x))
            if all(self.n[k] >= used[k] + c for k, c in need.items()):
                return x, gap - x
        return None

    def triple(self, gap: int, used: Counter) -> tuple[int, int, int] | None:
        for a in range(gap - 2, (gap - 1) // 3, -1):
            if self.n[a] > used[a]:
                rest = self.pair(gap - a, used + Counter((a,)))
                if rest and rest[0] <= a:
                    return (a, *rest)
        return None

    def times(self, pattern: list[int]) -> int:
        return min(int(self.n[k]) // c for k, c in Counter(pattern).items())

    def use(self, pattern: list[int]) -> int:
        m = self.times(pattern)
        for k in pattern:
            self.n[k] -= m
        return m


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths of a sequence, how many such sequences), using every count up."""
    left, out = _Lengths(counts, capacity), []
    for longest in range(capacity, 0, -1):
        # Exact fills of this length, by one, two, then three others.
        while left.n[longest]:
            used, gap = Counter((longest,)), capacity - longest
            found = () if gap == 0 else None
            if gap:
                one = left.single(gap, used)
                found = (one,) if one else left.pair(gap, used) if gap > 1 else None
                found = found or (left.triple(gap, used) if gap > 2 else None)
            if found is None:
                break
            out.append(((longest, *found), left.use([longest, *found])))
        # Residuals of this length: best fit, the longest that still goes in each time.
        while left.n[longest]:
            pattern, gap = [longest], capacity - longest
            used = Counter(pattern)
            while gap:
                fits = np.flatnonzero(left.n[:gap + 1] > 0)[::-1].tolist()
                best = next((k for k in fits if left.n[k] > used[k]), None)
                if best is None:
                    break
                pattern.append(best)
                used[best] += 1
                gap -= best
            # As often as whole patterns can be had; a pattern that needs its
            # own leftovers is used once.
            out.append((tuple(pattern), left.use(pattern)))
    return out


def slots(patterns: list[tuple[list[int], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """length -> first rank, first sequence and offset of each of its slots."""
    taken, out, sequence = Counter(), {}, 0
    for lengths, times in patterns:
        offset = 0
        for length in lengths:
            out.setdefault(length, []).append((taken[length], sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in out.items()}


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: ``id_col``, piece, start, length, ids_crc32,
    sequence_id, offset (and ids, little-endian, with ``with_ids``).

    Null and empty texts are a piece of the end id alone.  Null and repeated
    ids, and repeated rows, are packed like any other row; an empty table
    gives no rows; other columns are not read.  ``tokenizer`` is a file that
    every executor can open.
    """
    spark = docs.sparkSession
    cut = store(spark, pieces(docs, tokenizer, capacity=capacity, id_col=id_col, text_col=text_col,
                              with_ids=with_ids), "packing-pieces")
    per_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    per_task = store(spark, per_task.withColumn("before", F.coalesce(before, F.lit(0))), "packing-counts")
    # At most ``capacity`` rows.
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(slots(plan(counts, capacity)))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sequence, offset = np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)
            lengths, ranks = b["length"].to_numpy(), b["rank"].to_numpy()
            order = np.argsort(lengths, kind="stable")
            for group in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(b) else []:
                first, base, at = table.value[int(lengths[group[0]])]
                k = np.searchsorted(first, ranks[group], side="right") - 1
                sequence[group], offset[group] = base[k] + ranks[group] - first[k], at[k]
            yield b.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    ranked = (cut.join(per_task.select("length", "task", "before"), ["length", "task"])
              .select("id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids,
                      (F.col("before") + F.col("nth")).alias("rank")))
    placed = ranked.mapInPandas(place, "id string, piece int, start long, length long, ids_crc32 long"
                                + ", ids binary" * with_ids + ", sequence_id long, offset long")
    return placed.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).withColumnRenamed("id", id_col)
