"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents whose sets of word shingles have a Jaccard similarity of at least
num / den are linked; the result is the component of each document.

First every shingle of every distinct set is counted, exactly but for its hash
(``_census``): blocks of documents send their shingles, sorted and packed, to
the shingle's bucket, and get back which of them no other set holds.  With s
shared shingles, a set of n has an overlap of at most s with any other, so a
document with s < t n links with none and goes no further, and a pair's overlap
is bounded by the lesser s.

Shingles of the others are ordered by frequency, the rarest first (a cell of the
sketch holds the largest frequency among its shingles).  Two linked sets r and s
share at least l shingles of their l-prefixes, the first |r| - ceil(t |r|) + l.
Each document chooses its own l by what its prefix is estimated to cost in
candidates, so a pair is verified only if it shares l = min(l of r, l of s)
prefix shingles.  A pair's own sizes ask for an overlap of o = ceil(t (|r| + |s|)
/ (1 + t)), so only matches at places up to |r| - o + l and |s| - o + l count.

Equal sets count once.  First, in rounds, each document is verified against one
partner of another component, the one most of its l-prefix leads to, which joins
groups of copies by as many pairs as they have members.  Then all other pairs that
may link and are not yet in one component are verified, so no link between
components is missed.  That last join is by shingle, and the l-prefixes' common
shingles would make it grow with the square of a group of unlinked near copies: it
takes only the places that l = 1 asks for, and a pair only if its sets' parities
agree enough.  Parities are BITS bits a set, each telling whether an even or odd
number of its shingles fall there; sets that differ in d shingles differ in d bits
at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hemotab.llm.common import store, text_bytes, words
from hemotab.llm.graph import components

CACHED_WORDS = 200_000
PRIME = np.uint64(0x9E3779B97F4A7C15)
FILTER_CHUNK = 15          # bits of a filter go to the driver in chunks of 2 ** 15
STAR_ROUNDS = 1
OPEN = ("id", "n", "place", "component", "shared", "parity")
STAR_ORDERS = 4            # partners a round for a document, at most
BLOCK_SHINGLES = 1 << 20   # a block of documents ends at so many shingles
BLOCK_DOCS = 1 << 16       # or documents: numbers within a block take two bytes
BUCKET_BYTES = 1 << 22     # text whose shingles share a bucket, about
BITS = 1024                # parities of a set
PARITY_DOCS = 1024         # sets whose parities are counted at a time
BATCH_ROWS = 500           # texts, or pairs of sets, that go to Python at a time
CENSUS = ("id string, n long, digest binary, parity binary, block long, number int, own int, "
          "bucket int, keys binary, who binary, many binary, times binary, cells binary")


@dataclass(frozen=True)
class Config:
    shingle: int = 5
    num: int = 80              # similarity of at least num / den
    den: int = 100
    sketch_bits: int | None = None   # cells of the frequency sketch: 2 ** bits (None: 16 a document, 2 ** 16 to 2 ** 23)
    filter_bits: int | None = None   # bits of the filters for documents: 2 ** bits (None: 8 a document, at most 2 ** 28)
    longest: int | None = None       # largest l (None: no limit)
    cost_step: float = 64.0    # l is 1, and 1 more for each doubling of the estimated candidates beyond this
    salted_from: int = 4096    # a shingle with more documents is dealt to several groups


class Shingles:
    """Sorted distinct shingle hashes of texts; remembers words within a bound."""

    def __init__(self, n: int):
        self.n, self.known = n, {}

    def __call__(self, text: bytes) -> np.ndarray:
        tokens = words(text)
        if not tokens:
            return np.zeros(0, np.uint64)
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        for w in set(tokens).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
        n = min(self.n, len(h))
        out = np.full(len(h) - n + 1, n, np.uint64)
        for k in range(n):
            out = out * PRIME + h[k:len(h) - n + 1 + k]
            out ^= out >> np.uint64(29)
        out *= np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(32)
        return np.unique(out)


def _bits(n: int, least: int, most: int) -> int:
    return min(most, max(least, (max(int(n), 1) - 1).bit_length()))


def _aside(k: int) -> int:
    """A number below 0, different for most k: rows under it only pass through."""
    return -1 - (k * 0x9E3779B97F4A7C15 >> 20) % (1 << 30)


def _parities(hashes: list[np.ndarray]) -> list[bytes]:
    """Of each set, whether an odd number of its shingles fall to each of BITS bits."""
    out = []
    for first in range(0, len(hashes), PARITY_DOCS):
        part = hashes[first:first + PARITY_DOCS]
        at = np.concatenate([(s & np.uint64(BITS - 1)).astype(np.int64) + k * BITS for k, s in enumerate(part)])
        odd = (np.bincount(at, minlength=BITS * len(part)) & 1).astype(bool)
        out += [x.tobytes() for x in np.packbits(odd.reshape(-1, BITS), axis=1)]
    return out


def _packed(block: int, hashes: list[np.ndarray], bits: int) -> tuple[np.ndarray, dict[str, list]]:
    """A block's shingles by bucket, the first ``bits`` bits; and how many of each
    document's another document of the block holds too."""
    h = np.concatenate(hashes)
    who = np.repeat(np.arange(len(hashes), dtype=np.uint16), [len(x) for x in hashes])
    order = np.argsort(h, kind="stable")
    h, who = h[order], who[order]
    heads = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    times = np.diff(np.append(heads, len(h)))
    own = np.bincount(who[np.repeat(times > 1, times)], minlength=len(hashes))
    bucket = (h[heads] >> np.uint64(64 - bits)).astype(np.int64)
    key = (h[heads] >> np.uint64(32 - bits)).astype(np.uint32)     # the 32 bits after the bucket's
    out = {k: [] for k in ("block", "bucket", "keys", "who", "many", "times")}
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    for at, end in zip(starts, np.append(starts[1:], len(bucket))):
        t, k = times[at:end], key[at:end]
        once = t == 1
        out["block"].append(block)
        out["bucket"].append(bucket[at])
        out["keys"].append(k[once].tobytes())
        out["who"].append(who[heads[at:end][once]].tobytes())
        out["many"].append(k[~once].tobytes())
        out["times"].append(t[~once].astype(np.uint32).tobytes())
    return own, out


def _census(docs: DataFrame, config: Config, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """(id, n, digest) of every document; (id, shared, parity) of those that may link,
    shared being how many of their shingles another set holds, parity null where
    rows of one id differ in it; and the frequency sketch.  Equal sets of one task count once.  A shingle is known by its
    bucket's bits and 32 more: two that agree in them count as held by two sets,
    which can only let more documents through.  Blocks are named by task and place,
    so ``docs`` must give a task's rows in the same order again, as files do."""
    spark = docs.sparkSession
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text_bytes(text_col))).alias("bytes")).first()
    bits = _bits((size["bytes"] or 0) // BUCKET_BYTES, 6, 23)
    cell_bits = max(bits, config.sketch_bits or _bits(16 * size["n"], 16, 23))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, seen, block, hashes, kept, held = Shingles(config.shingle), set(), 0, [], [], 0

        def close() -> Iterator[pd.DataFrame]:
            own, packed = _packed(block, hashes, bits)
            yield pd.DataFrame(kept, columns=["id", "n", "digest"]).assign(
                parity=_parities(hashes), block=block, number=range(len(kept)), own=own, bucket=_aside(block))
            rows = pd.DataFrame(packed)
            for at in range(0, len(rows), 1024):
                yield rows.iloc[at:at + 1024]

        for seq, b in enumerate(batches):
            alike = []
            for key, text, task in zip(b["id"], b["text"], b["task"]):
                s = shingles(text)
                row = (key, len(s), xxhash.xxh3_128_digest(s.tobytes()))
                if not len(s) or key is None or row[2] in seen:
                    alike.append(row)
                    continue
                seen.add(row[2])
                hashes.append(s)
                kept.append(row)
                held += len(s)
                if held >= BLOCK_SHINGLES or len(kept) == BLOCK_DOCS:
                    block = (int(task) << 24) + (block & 0xFFFFFF)
                    yield from map(shaped, close())
                    block, hashes, kept, held = block + 1, [], [], 0
            yield shaped(pd.DataFrame(alike, columns=["id", "n", "digest"]).assign(number=-1, bucket=_aside((int(task) << 24) + seq)))
        if kept:
            block = (int(task) << 24) + (block & 0xFFFFFF)
            yield from map(shaped, close())

    names = [x.split()[0] for x in CENSUS.split(", ")]

    def shaped(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.reindex(columns=names)
        for c in ("id", "digest", "parity", "keys", "who", "many", "times", "cells"):
            rows[c] = rows[c].astype(object).where(rows[c].notna(), None)
        return rows.astype({c: "Int64" for c in ("n", "block", "number", "own", "bucket")})

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["bucket"].iloc[0] < 0:
            return rows                              # documents only pass through
        ones = [np.frombuffer(x, np.uint32) for x in rows["keys"]]
        many = np.concatenate([np.frombuffer(x, np.uint32) for x in rows["many"]])
        key = np.concatenate([*ones, many])
        times = np.concatenate([np.ones(len(key) - len(many), np.uint32), *(np.frombuffer(x, np.uint32) for x in rows["times"])])
        order = np.argsort(key, kind="stable")
        heads = np.flatnonzero(np.append(True, key[order[1:]] != key[order[:-1]]))
        total = np.add.reduceat(times[order], heads, dtype=np.int64)
        wide = cell_bits - bits
        cells = np.zeros(1 << wide, np.uint32)
        cell = (key[order[heads]] >> np.uint32(32 - wide)).astype(np.int64) if wide else np.zeros(len(heads), np.int64)
        first = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        cells[cell[first]] = np.minimum(np.maximum.reduceat(total, first), 0xFFFFFFFF)
        shared = np.zeros(len(key), bool)
        shared[order] = np.repeat(total > 1, np.diff(np.append(heads, len(key))))
        at, who = 0, []
        for x, w in zip(ones, rows["who"]):
            who.append(np.frombuffer(w, np.uint16)[shared[at:at + len(x)]].tobytes())
            at += len(x)
        head = pd.DataFrame({"bucket": rows["bucket"].iloc[:1].to_numpy(), "cells": [cells.tobytes()]})
        return shaped(pd.concat([pd.DataFrame({"block": rows["block"].to_numpy(), "who": who}), head]))

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        mine = rows[rows["id"].notna()].sort_values("number")
        shared = mine["own"].to_numpy(np.int64)
        told = np.frombuffer(b"".join(x for x in rows["who"] if x is not None), np.uint16)
        shared = shared + np.bincount(told, minlength=len(mine))
        n = mine["n"].to_numpy(np.int64)
        parity = [np.frombuffer(x, np.int64) for x in mine["parity"]]
        return pd.DataFrame({"id": mine["id"].to_numpy(), "shared": shared, "parity": parity})[config.den * shared >= config.num * n]

    # The id travels as text: pandas would turn integers beside nulls into floats.
    rows = docs.select(F.col(id_col).cast("string").alias("id"), text_bytes(text_col).alias("text"), F.spark_partition_id().alias("task"))
    sent = rows.mapInPandas(run, CENSUS)
    out = store(spark, sent.groupBy("bucket").applyInPandas(count, CENSUS), "jaccard-census", BATCH_ROWS)
    kind = docs.schema[id_col].dataType
    each = out.where("digest IS NOT NULL").select(F.col("id").cast(kind).alias("id"), "n", "digest")
    able = (out.where("block IS NOT NULL").select("block", "id", "n", "number", "own", "who", "parity").groupBy("block")
            .applyInPandas(choose, "id string, shared int, parity array<long>").select(F.col("id").cast(kind).alias("id"), "shared", "parity"))
    able = store(spark, able.groupBy("id").agg(F.max("shared").alias("shared"), _same("parity").alias("parity")), "jaccard-able")
    cells = np.ones(1 << cell_bits, np.uint32)       # 32 MB at most, unless set larger
    wide = 1 << cell_bits - bits
    for r in out.where("cells IS NOT NULL").select("bucket", "cells").toLocalIterator():
        cells[r["bucket"] * wide:(r["bucket"] + 1) * wide] = np.frombuffer(r["cells"], np.uint32)
    return each, able, cells


def _prefixes(docs: DataFrame, able: DataFrame, cells: np.ndarray, config: Config, id_col: str, text_col: str) -> DataFrame:
    """id, n, l, token, place, groups of the l-prefix of every document in ``able``;
    equal sets of one task count once.  ``groups`` is how many groups the token is
    dealt to.  A few other documents pass the filter too."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(cells)     # 4 bytes a cell
    bits, members = _filter(spark, able.select("id"), config)
    few = spark.sparkContext.broadcast(members)
    usual = float(cells.mean())
    shift = np.uint64(64 - int(len(cells)).bit_length() + 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, seen, counters = Shingles(config.shingle), set(), shared.value
        for b in batches:
            b = b[_hits(few.value, b["bit"])]
            for at in range(0, len(b), 500):
                part, out = b.iloc[at:at + 500], []
                ids, ns, ls, sizes = [], [], [], []
                for key, text in zip(part["id"], part["text"]):
                    s = shingles(text)
                    digest = xxhash.xxh3_128_digest(s.tobytes())
                    if not len(s) or digest in seen:
                        continue
                    seen.add(digest)
                    f = counters[(s >> shift).astype(np.int64)]
                    size = len(s)
                    need = -(-config.num * size // config.den)
                    order = np.lexsort((s, f))
                    cost = np.maximum(f[order[:size - need + 1]] - usual, 0).sum()
                    extra = min(need, config.longest or need, 1 + int(np.log2(1 + cost / config.cost_step)))
                    keep = size - need + extra
                    s, f = s[order[:keep]], f[order[:keep]]
                    out.append((s, f))
                    ids.append(key), ns.append(size), ls.append(extra), sizes.append(keep)
                if out:
                    f = np.concatenate([x for _, x in out])
                    yield pd.DataFrame({
                        "id": np.repeat(np.array(ids, dtype=part["id"].dtype), sizes), "n": np.repeat(ns, sizes),
                        "l": np.repeat(ls, sizes), "token": np.concatenate([x for x, _ in out]).view(np.int64),
                        "place": np.concatenate([np.arange(1, k + 1, dtype=np.int32) for k in sizes]),
                        "groups": np.ceil(np.maximum(f / config.salted_from, 1)).astype(np.int32)})

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"), _bit(F.col(id_col), bits).alias("bit"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInPandas(run, f"id {kind}, n int, l int, token long, place int, groups int")


def _same(col: str) -> Column:
    """The value of all rows of a group; null where one differs or is null."""
    return F.when((F.count(col) == F.count(F.lit(1))) & (F.min(col) == F.max(col)), F.max(col))


def _bit(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(1 << bits))


def _hits(words: np.ndarray, bit: pd.Series) -> np.ndarray:
    at = bit.to_numpy()
    return ((words[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)


def _filter(spark: SparkSession, ids: DataFrame, config: Config) -> tuple[int, np.ndarray]:
    """Bits of the hash of ids, and the bit set of those hashes: 2 ** bits bits,
    at most 32 MB.  Beyond that size it lets more through; nothing relies on it."""
    bits = max(FILTER_CHUNK, config.filter_bits or _bits(8 * ids.count(), FILTER_CHUNK, 28))
    small = 1 << FILTER_CHUNK

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        flags = np.zeros(small, np.uint8)
        flags[rows["bit"].to_numpy() % small] = 1
        return pd.DataFrame({"chunk": rows["chunk"][:1], "flags": [np.packbits(flags, bitorder="little").tobytes()]})

    at = ids.select(_bit(F.col("id"), bits).alias("bit")).distinct()
    packed = at.withColumn("chunk", F.shiftright("bit", FILTER_CHUNK).cast("int")).groupBy("chunk").applyInPandas(pack, "chunk int, flags binary")
    out = np.zeros(1 << bits - 3, np.uint8)
    for r in packed.toLocalIterator():
        out[r["chunk"] * small // 8:(r["chunk"] + 1) * small // 8] = np.frombuffer(r["flags"], np.uint8)
    return bits, out


def verify(docs: DataFrame, pairs: DataFrame, config: Config, id_col: str, text_col: str) -> DataFrame:
    """The (a, b) of ``pairs`` that are similar enough, by their whole sets."""
    spark = docs.sparkSession
    ids = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id")))
    size, members = _filter(spark, ids, config)
    shared = spark.sparkContext.broadcast(members)

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = Shingles(config.shingle)
        for b in batches:
            hit = b[_hits(shared.value, b["bit"])]
            yield pd.DataFrame({"id": hit["id"], "s": [shingles(t).tobytes() for t in hit["text"]]})

    def similar(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ok = []
            for x, y in zip(b["x"], b["y"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(config.den * both >= config.num * (len(x) + len(y) - both))
            yield b.loc[np.array(ok, bool), ["a", "b"]]

    rows = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), text_bytes(text_col).alias("text"),
        _bit(F.col(id_col), size).alias("bit"))
    kind = rows.schema["id"].dataType.simpleString()
    held = store(spark, rows.mapInPandas(sets, f"id {kind}, s binary"), "jaccard-held", BATCH_ROWS)
    with_a = pairs.join(held.select(F.col("id").alias("a"), F.col("s").alias("x")), "a")
    with_both = with_a.join(held.select(F.col("id").alias("b"), F.col("s").alias("y")), "b")
    return with_both.select("a", "b", "x", "y").mapInPandas(similar, f"a {kind}, b {kind}")


def _labelled(rows: DataFrame, found: DataFrame | None) -> DataFrame:
    """Rows with the component found for their id so far."""
    if found is None:
        return rows.withColumn("component", F.col("id"))
    return (rows.join(found.withColumnsRenamed({"node": "id"}), "id", "left")
            .withColumn("component", F.coalesce("component", "id")))


def _conditions(config: Config) -> tuple[str, str, str]:
    """What sets of n and m must meet to be linked: by their sizes and shared
    shingles, and by their parities; and the overlap they need."""
    overlap = f"ceil({config.num} * (n + m) / {float(config.num + config.den)} - 1e-9)"
    able_to = (f"a <> b AND ca <> cb AND {config.den} * least(n, m) >= {config.num} * greatest(n, m) "
               f"AND {overlap} <= least(sa, sb)")
    apart = " + ".join(f"bit_count(xa[{k}] ^ xb[{k}])" for k in range(BITS // 64))
    return able_to, f"coalesce({apart}, 0) <= n + m - 2 * {overlap}", overlap


def _meetings(open_: DataFrame, config: Config) -> DataFrame:
    """(a, b) that may link, a row for each shingle at which they meet."""
    able_to, agree, overlap = _conditions(config)
    x = open_.select("token", *[F.col(c).alias(d) for c, d in zip(OPEN, ("a", "n", "pa", "ca", "sa", "xa"))])
    y = open_.select("token", *[F.col(c).alias(d) for c, d in zip(OPEN, ("b", "m", "pb", "cb", "sb", "xb"))])
    alike = F.expr(f"{able_to} AND pa <= n - {overlap} + 1 AND pb <= m - {overlap} + 1 AND {agree}")
    return x.join(y, "token").where("a < b").where(alike).select("a", "b")


def jaccard_components(docs: DataFrame, config: Config = Config(), *, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """``id_col``, n_shingles, component_id of every row.

    component_id is the smallest id reachable by links, the row's own if it
    has none.  Null or empty texts have no shingle and no link; texts shorter
    than a shingle are one shingle of all their words.  Rows that share an id
    count as one document in links; rows with a null id are never linked
    (component_id null).  An empty table gives no rows; other columns are not
    read.
    """
    spark = docs.sparkSession
    each, able, cells = _census(docs, config, id_col, text_col)
    smallest = store(spark, each.where("n > 0 AND id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("rep")), "jaccard-classes")
    members = store(spark, each.join(smallest, "digest", "left").select(
        "id", "n", F.when(F.col("id").isNotNull(), F.coalesce("rep", "id")).alias("rep")), "jaccard-members")
    of = members.where("n > 0 AND id IS NOT NULL").select("id", "rep").distinct().join(able, "id")

    # One shuffle of the prefix shingles; those of a single document go no further.
    prefixes = _prefixes(docs, able, cells, config, id_col, text_col)
    group = Window.partitionBy("token", "salt")
    met = (prefixes.withColumn("salt", F.pmod(F.xxhash64("id"), F.col("groups")))
           .withColumn("size", F.count(F.lit(1)).over(group)).where("size > 1 OR groups > 1")
           .select("token", "id", "n", "l", "place", "groups"))
    met = store(spark, met, "jaccard-met", BATCH_ROWS)
    by_rep = (met.join(of, "id").groupBy("token", F.col("rep").alias("id"), "n", "groups")
              .agg(F.min("l").alias("l"), F.min("place").alias("place"), F.max("shared").alias("shared")))
    shared = store(spark, by_rep, "jaccard-shared")

    # Stars: each document with those of other components that most of its shingles
    # lead to and whose parities agree enough, among the first of each shingle's
    # documents in a few orders, so that near copies meet several of their kind.
    parity = store(spark, of.groupBy(F.col("rep").alias("id")).agg(_same("parity").alias("parity")), "jaccard-parity")
    able_to, agree, overlap = _conditions(config)
    near = F.expr(f"{able_to} AND pa <= n - {overlap} + least(la, lb) AND pb <= m - {overlap} + least(la, lb)")
    parts = ("nth", "component", "id", "n", "l", "place", "shared")
    links, found = None, None
    for _ in range(STAR_ROUNDS):
        lone = (_labelled(shared, found).withColumn("salt", F.pmod(F.xxhash64("id"), F.col("groups")))
                .withColumn("nth", F.xxhash64("id", F.pmod("token", F.lit(STAR_ORDERS)))).withColumn("mine", F.struct(*parts)))
        heads = lone.withColumn("head", F.min("mine").over(group))
        across = (heads.where("groups > 1").select("token", F.col("head").alias("mine")).distinct()
                  .withColumn("head", F.min("mine").over(Window.partitionBy("token"))))
        led = (heads.select("mine", "head").unionAll(across.select("mine", "head"))
               .select(*[F.col(f"mine.{x}").alias(y) for x, y in zip(parts[1:], ("ca", "a", "n", "la", "pa", "sa"))],
                       *[F.col(f"head.{x}").alias(y) for x, y in zip(parts[1:], ("cb", "b", "m", "lb", "pb", "sb"))]))
        tallied = (led.where(near).groupBy("a", "b", "n", "m").agg(F.count(F.lit(1)).alias("hits"))
                   .join(parity.toDF("a", "xa"), "a").join(parity.toDF("b", "xb"), "b").where(agree))
        nearest = Window.partitionBy("a").orderBy(F.desc("hits"), "b")
        best = tallied.withColumn("nth", F.row_number().over(nearest)).where(F.col("nth") <= STAR_ORDERS).select("a", "b").distinct()
        stars = store(spark, best, "jaccard-stars")
        new = store(spark, verify(docs, stars, config, id_col, text_col), "jaccard-links", BATCH_ROWS)
        links = new if links is None else links.unionAll(new)
        found = store(spark, components(spark, links), "jaccard-components")

    # All other pairs: different components, a shingle shared at the places that l = 1
    # asks for, parities that differ no more than linked sets may.
    first = _labelled(shared, found).where(f"place <= n - ceil({config.num} * n / {float(config.den)} - 1e-9) + 1")
    spread = first.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("token")
    open_ = first.join(spread, "token").join(parity, "id").select("token", *OPEN)
    open_ = store(spark, open_, "jaccard-open")
    pairs = _meetings(open_, config).distinct()
    pairs = store(spark, pairs, "jaccard-pairs")
    more = store(spark, verify(docs, pairs, config, id_col, text_col), "jaccard-links", BATCH_ROWS)
    last = found if more.isEmpty() else store(spark, components(spark, links.unionAll(more)), "jaccard-components")
    return (members.join(last.withColumnsRenamed({"node": "rep"}), "rep", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.coalesce("component", "rep").alias("component_id")))


def one_of_each(docs: DataFrame, config: Config = Config(), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose id names their component (rows with a null id stay),
    with all their columns.  Rows that share such an id all stay."""
    found = jaccard_components(docs, config, id_col=id_col, text_col=text_col)
    dropped = (found.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("__id")).distinct())
    dropped = store(docs.sparkSession, dropped, "jaccard-dropped")
    return docs.join(dropped.hint("shuffle_hash"), docs[id_col] == dropped["__id"], "left_anti")
