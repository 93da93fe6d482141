"""Removal of repeated substrings by external suffix sorting.

A byte is removed if a ``length``-byte string that also starts earlier covers
it.  Equal strings must meet in one shard, so each string is dealt by its
*anchor*, the gram of ``gram`` bytes with the least hash in it (the leftmost of
equals), and by a second gram on the side of the anchor where the string holds
more.  Neighbouring strings have the same two grams, so a shard gets a short
stretch of text for each such key, not each string.  Keys that occur once in
the corpus go no further.

Stretches of a key are first compared by hash.  Where all of them are alike,
the earliest stays and the others are covered whole.  Only keys with different
stretches send their bytes to a shard, which sorts the suffixes of its distinct
stretches by external induced sorting (``induced``), which carries common
prefixes along.  Runs of neighbours with ``length`` bytes in common are groups
of equal strings; all but the first of a group (by document, then start) cover
their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hemotab.llm import induced
from hemotab.llm.common import store, text_bytes

LENGTH = 100
GRAM = 32
FILTER_BITS = 30           # the largest filter: 128 MB
FILTER_CHUNK = 15          # bits of a filter go to the driver in chunks of 2 ** 15
HELD_STRETCHES = 150_000
BATCH_BYTES = 1 << 19      # longer texts are read in windows
TUPLES = 1 << 23           # suffix tuples that a shard's queues keep in memory


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (width - size)], x[width - size:]) if width > size else x


def _grams(b: np.ndarray, gram: int) -> np.ndarray:
    """Hashes of all grams; ``gram`` is a power of two."""
    h, factor, size = b.astype(np.uint64) + np.uint64(1), 0x100000001B3, 1
    while size < gram:
        left = h[:-size] * np.uint64(factor)
        h = np.add(left, h[size:], out=left)
        factor = factor * factor % (1 << 64)
        size *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _mixed(a: np.ndarray, b: np.ndarray, side: np.ndarray) -> np.ndarray:
    k = a * np.uint64(0x9E3779B97F4A7C15) + b + side.astype(np.uint64)
    k ^= k >> np.uint64(29)
    k *= np.uint64(0xBF58476D1CE4E5B9)
    return k ^ (k >> np.uint64(32))


def keyed_runs(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text number, key, first string's start, strings) of each run of strings
    with one key: their anchor and the gram that ends or starts with it or lies
    next to it, on the side where the strings hold at least half of the rest."""
    sizes = np.array([len(t) for t in texts])
    none = tuple(np.zeros(0, d) for d in (np.int64, np.uint64, np.int64, np.int64))
    if not len(texts) or sizes.max() < length:
        return none
    b = np.frombuffer(b"".join(texts), np.uint8)
    h, width = _grams(b, gram), length - gram + 1
    # The place in the hash's last bits: the least of a window tells its anchor, and
    # grams alike in the others are taken by place, as in any equal string.
    low = np.uint64((1 << len(h).bit_length()) - 1)
    least = _least((h & ~low) | np.arange(len(h), dtype=np.uint64), width)     # of the string at each position
    first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    place = (least[first] & low).astype(np.int64)
    ends = np.cumsum(sizes)
    owner = np.searchsorted(ends, place, side="right")
    begin = np.maximum(first, (ends - sizes)[owner])
    end = np.minimum(np.append(first[1:], len(least)), ends[owner] - length + 1)
    half = (length - gram) // 2
    turn = np.clip(place - half, begin, np.maximum(begin, end))     # from here: room for ``half`` bytes or more after the anchor, else before it
    starts = np.column_stack([begin, turn]).ravel()
    strings = np.column_stack([turn, end]).ravel() - starts
    some = np.flatnonzero(strings > 0)
    right, at = (some & 1).astype(bool), some >> 1
    owner, place, starts = owner[at], place[at], starts[some]
    beside = place + np.where(right, 1, -1) * min(half, gram)
    return owner, _mixed(h[place], h[beside], right), starts - (ends - sizes)[owner], strings[some]


def _groups_of(texts: pd.Series, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """(text number, offset in it) and bytes of pieces of about BATCH_BYTES
    together.  Longer texts come in windows that share ``length`` - 1 bytes, so
    that each string lies in one window."""
    held, owner, offset, size = [], [], [], 0
    for k, t in enumerate(texts):
        for at in range(0, max(len(t) - length + 1, 1), BATCH_BYTES):
            piece = t if len(t) < BATCH_BYTES else t[at:at + BATCH_BYTES + length - 1]
            held.append(piece), owner.append(k), offset.append(at)
            size += len(piece)
            if size >= BATCH_BYTES:
                yield np.array(owner), np.array(offset), held
                held, owner, offset, size = [], [], [], 0
    if held:
        yield np.array(owner), np.array(offset), held


def _bit_set(keys: DataFrame, most: int) -> np.ndarray:
    """Bit set of the first bits of the keys (h): 8 to 16 bits a key, but at
    most 2 ** ``most``.  Beyond that more keys pass, which changes no result."""
    bits = min(most, max(FILTER_CHUNK, (8 * keys.count()).bit_length()))
    chunk = min(bits, FILTER_CHUNK)
    small = 1 << chunk

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(small, np.uint8)
        flags[rows["bit"].to_numpy() % small] = 1
        return pd.DataFrame({"chunk": rows["chunk"][:1], "flags": [np.packbits(flags, bitorder="little").tobytes()]})

    at = keys.select(F.shiftrightunsigned("h", 64 - bits).alias("bit")).distinct()
    packed = at.withColumn("chunk", F.shiftright("bit", chunk).cast("int")).groupBy("chunk").applyInPandas(pack, "chunk int, flags binary")
    out = np.zeros(1 << bits - 3, np.uint8)
    for r in packed.toLocalIterator():
        out[r["chunk"] * small // 8:(r["chunk"] + 1) * small // 8] = np.frombuffer(r["flags"], np.uint8)
    return out


def _repeated(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """The keys (h) that occur more than once."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, _, texts in _groups_of(b["text"], length):
                h, n = np.unique(keyed_runs(texts, length, gram)[1], return_counts=True)
                yield pd.DataFrame({"h": h.view(np.int64), "n": n})

    many = rows.select("text").mapInPandas(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")
    return store(rows.sparkSession, many.select("h"), "suffix-keys")


def _stretches(rows: DataFrame, keys: DataFrame, length: int, gram: int, bits: int, by_hash: bool) -> DataFrame:
    """Stretches with one of ``keys`` (h, body, id, dg, at, until), each distinct
    one once a task for its earliest place; the other places are covered: done,
    without h and body.  ``body`` is a hash of the bytes, or the bytes."""
    shared = rows.sparkSession.sparkContext.broadcast(_bit_set(keys, bits))
    names = ["h", "body", "id", "dg", "at", "until", "done"]
    nothing = 0 if by_hash else b""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, tuple] = {}
        flags, digest = shared.value, xxhash.xxh3_64_intdigest
        shift = np.uint64(64 - (8 * len(flags)).bit_length() + 1)
        for b in batches:
            covered = []
            ids, dgs = b["id"].astype(object).to_numpy(), b["dg"].to_numpy()
            for of, offset, texts in _groups_of(b["text"], length):
                owner, h, at, strings = keyed_runs(texts, length, gram)
                bit = (h >> shift).astype(np.int64)
                hit = np.flatnonzero((flags[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1)
                owner, at, size = owner[hit], at[hit], strings[hit] + length - 1
                row = of[owner]
                places = zip(ids[row].tolist(), dgs[row].tolist(), (at + offset[owner]).tolist(), size.tolist())
                for k, key, a, z, here in zip(owner.tolist(), h[hit].view(np.int64).tolist(), at.tolist(), (at + size).tolist(), places):
                    body = texts[k][a:z]
                    known = key, digest(body) - (1 << 63) if by_hash else body
                    best = held.setdefault(known, here)
                    if best is here or best == here:
                        continue
                    if here < best:
                        held[known], here = here, best
                    covered.append(here)
                if len(covered) > HELD_STRETCHES:
                    yield _covered(covered)
                    covered = []
            if covered:
                yield _covered(covered)
            if len(held) > HELD_STRETCHES:
                yield _rows(held)
                held.clear()
        if held:
            yield _rows(held)

    def _places(places: list[tuple], done: bool) -> pd.DataFrame:
        key, dg, at, size = zip(*places)
        at = np.array(at, np.int64)
        return pd.DataFrame({"id": pd.Series(key), "dg": np.array(dg, np.int64), "at": at, "until": at + np.array(size, np.int64), "done": done})

    def _covered(places: list[tuple]) -> pd.DataFrame:
        return _merged(_places(places, True)).assign(h=0, body=nothing)[names]

    def _rows(held: dict) -> pd.DataFrame:
        h, body = zip(*held)
        return _places(list(held.values()), False).assign(h=h, body=body)[names]

    kind = "long" if by_hash else "binary"
    return rows.mapInPandas(run, f"h long, body {kind}, id {rows.schema['id'].dataType.simpleString()}, dg long, at int, until int, done boolean")


def _dealt() -> Column:
    """Ranges that are done go along, dealt by their document."""
    return F.when(F.col("done"), F.xxhash64("id", "at")).otherwise(F.col("h"))


def _compared(found: DataFrame) -> DataFrame:
    """Of stretches by hash: the covered ranges, and the keys (h) of different
    stretches (done false).  A key has a row a task for each of its stretches."""
    of_key = Window.partitionBy("deal", "done")
    alike = Window.partitionBy("deal", "done", "body").orderBy("id", "dg", "at")
    open_ = F.col("low") != F.col("high")
    return (found.withColumn("deal", _dealt())
            .withColumn("low", F.min("body").over(of_key)).withColumn("high", F.max("body").over(of_key))
            .withColumn("nth", F.dense_rank().over(alike))     # a row that repeats is one place
            .where(F.col("done") | (open_ & (F.col("body") == F.col("low")) & (F.col("nth") == 1)) | (~open_ & (F.col("nth") > 1)))
            .select("h", "id", "dg", "at", "until", (F.col("done") | ~open_).alias("done")))


def _merged(ranges: pd.DataFrame) -> pd.DataFrame:
    """Overlapping or touching ranges of a document as one."""
    r = ranges.sort_values(["id", "dg", "at"], ignore_index=True)
    key = r.groupby(["id", "dg"], sort=False).ngroup().to_numpy()
    at, until = r["at"].to_numpy(np.int64), r["until"].to_numpy(np.int64)
    step = int(until.max()) + 1     # documents side by side, so that one running maximum serves all
    reach = np.maximum.accumulate(until + key * step)
    first = np.append(True, at[1:] + key[1:] * step > reach[:-1])
    heads = np.flatnonzero(first)
    tails = np.append(heads[1:], len(r)) - 1
    return r.iloc[heads].assign(until=reach[tails] - key[heads] * step)


def equal_strings(bodies: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(group, position in the joined bodies) of every string of ``length``
    bytes in the bodies, by suffix sorting."""
    t = np.frombuffer(b"".join(bodies), np.uint8)
    sizes = np.array([len(x) for x in bodies])
    ends = np.cumsum(sizes)
    starts = np.zeros(len(t), bool)
    room = np.zeros(len(t) + 1, np.int32)
    np.add.at(room, ends - sizes, 1)
    np.add.at(room, ends - length + 1, -1)
    starts = np.cumsum(room[:-1]) > 0
    group, positions, breaks = [], [], 0
    for at, lcp in induced.descending(t, 256, length, TUPLES):
        number = breaks + np.cumsum(lcp < length)
        breaks = int(number[-1])
        ours = starts[at]
        group.append(number[ours])
        positions.append(at[ours])
    return np.concatenate(group), np.concatenate(positions)


def solve(shard: pd.DataFrame, length: int) -> pd.DataFrame:
    """Covered places (id, dg, at, until) of one shard's stretches."""
    # Tasks that hold the same row each give its stretches: one place, not a copy.
    shard = shard.drop_duplicates(["h", "body", "id", "dg", "at"])
    shard = shard.sort_values(["id", "dg", "at"], ignore_index=True)  # earlier rows start earlier
    size = shard["body"].map(len).to_numpy()
    repeats = shard.duplicated(["h", "body"]).to_numpy()
    whole = shard.loc[repeats, ["id", "dg", "at"]].assign(until=shard.loc[repeats, "at"] + size[repeats])
    alone = ~shard["h"].duplicated(keep=False).to_numpy()
    kinds = shard[~repeats].groupby("h")["body"].transform("size")
    left = shard.loc[~repeats][(kinds > 1).to_numpy() & ~alone[~repeats]]
    if not len(left):
        return whole
    left = left.reset_index(drop=True)
    sizes = left["body"].map(len).to_numpy()
    group, position = equal_strings(left["body"].tolist(), length)
    alike = group[1:] == group[:-1]                # groups come in order; those of one string cover nothing
    several = np.append(False, alike) | np.append(alike, False)
    group, position = group[several], position[several]
    order = np.lexsort((position, group))          # in a group, the earliest place first
    group, position = group[order], position[order]
    later = position[np.append(False, group[1:] == group[:-1])]
    ends = np.cumsum(sizes)
    later = np.sort(later)
    owner = np.searchsorted(ends, later, side="right")
    first = np.append(True, (later[1:] != later[:-1] + 1) | (owner[1:] != owner[:-1])) if len(later) else np.zeros(0, bool)
    heads = np.flatnonzero(first)
    tails = np.append(heads[1:], len(later)) - 1
    o = owner[heads]
    start = left["at"].to_numpy()[o] + later[heads] - (ends - sizes)[o]
    until = left["at"].to_numpy()[o] + later[tails] - (ends - sizes)[o] + length
    part = left.iloc[o][["id", "dg"]].reset_index(drop=True).assign(at=start, until=until)
    return pd.concat([whole, part])


def repeated_spans(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, filter_bits: int = FILTER_BITS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, dg, at, until): covered byte ranges, possibly overlapping; dg is a
    hash of the text, which tells rows that share an id apart."""
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"),
                                                        F.xxhash64(text_bytes(text_col)).alias("dg"))
    known = store(docs.sparkSession, _compared(_stretches(rows, _repeated(rows, length, gram), length, gram, filter_bits, True)), "suffix-ranges")
    found = _stretches(rows, known.where("NOT done").select("h"), length, gram, filter_bits, False)
    kind = rows.schema["id"].dataType.simpleString()

    def sort(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = []
        for b in batches:
            done = b["done"].to_numpy(bool)
            if done.any():
                yield b.loc[done, ["id", "dg", "at", "until"]]
            if not done.all():
                parts.append(b.loc[~done, ["h", "body", "id", "dg", "at"]])
        if parts:
            spans = solve(pd.concat(parts, ignore_index=True), length)
            if len(spans):
                yield _merged(spans)

    sorted_ = found.repartition(_dealt()).mapInPandas(sort, f"id {kind}, dg long, at int, until int")
    return sorted_.unionAll(known.where("done").select("id", "dg", "at", "until"))


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, filter_bits: int = FILTER_BITS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_bytes, n_removed, n_spans, kept_sha256 and kept (the
    remaining bytes) of every row.

    Null text counts as empty; texts shorter than ``length`` lose nothing.
    Matches never cross rows.  Rows with a null id neither lose bytes nor count
    as earlier; rows that share an id are ordered by a hash of their text, and
    fully repeated rows count as one document (each gets its result).  An empty
    table gives no rows; other columns are not read.
    """
    spans = repeated_spans(docs, length=length, gram=gram, filter_bits=filter_bits, id_col=id_col, text_col=text_col)
    # A document's ranges: no more than its bytes.
    per_doc = (spans.groupBy("id", "dg").agg(F.sort_array(F.collect_set(F.struct("at", "until"))).alias("ranges"))
               .select("id", "dg", F.col("ranges.at").alias("starts"), F.col("ranges.until").alias("ends")))
    rows = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"), F.xxhash64(text_bytes(text_col)).alias("dg"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for key, text, starts, ends in zip(b["id"], b["text"], b["starts"], b["ends"]):
                kept, at, until, n, removed = [], 0, -1, 0, 0
                for s, e in zip(starts, ends) if starts is not None else ():
                    if s > until:
                        kept.append(text[at:s])
                        n += 1
                        until = s
                    removed += max(0, e - until)
                    at = until = max(until, e)
                kept = b"".join([*kept, text[at:]])
                out.append((key, len(text), removed, n, hashlib.sha256(kept).hexdigest(), kept))
            yield pd.DataFrame(out, columns=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    joined = (rows.join(per_doc.hint("shuffle_hash"), ["id", "dg"], "left")
              .select(F.col("id").cast("string").alias("id"), "text", "starts", "ends"))
    result = joined.mapInPandas(cut, "id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return result.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).withColumnRenamed("id", id_col)
