"""Language-model scoring by Brown class-based bigrams.

Exchange clustering puts words into classes so that class bigrams keep as much
mutual information as they can: the most frequent words until no move helps,
then, in one distributed round, every other training word by its counts of
(word, neighbouring class); in that round the neighbours that are not among the
most frequent count by their shape, which any task can tell without a look-up.
Transitions are then counted anew over the classes of all words.  Only words
unseen in training stay in classes by shape, whose transitions are those of
words seen once.  A text's probability is the product of smoothed class
transitions and, within the classes, of word emissions.

The vocabulary, its neighbours and classes are tables, counted and joined by
Spark.  Texts are cut into words twice, to count the vocabulary and to store
them as numbers; all later passes read the numbers.  Only bounded parts reach
the driver: ``Config.known`` frequent words, which tasks look up themselves,
and the bigram counts of ``Config.clustered`` words.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemotab.llm.common import store, sum_arrays, text_bytes, words

END = b" "           # no word holds a space
SHAPES = 16
CACHED_WORDS = 300_000
CHUNK = 1 << 12
HELD_SLOTS = 4_000_000     # neighbours that a task holds (8 bytes each) before it gives them out
HELD_WORDS = 400_000       # words that it holds, repeats included
HELD_BYTES = 1 << 26       # their bytes
GIVEN_WORDS = 20_000       # in a batch that it gives out
BLOCK = 1 << 8             # known words whose neighbours go together
FEW = 8
ENTRIES = 1 << 15          # (word, neighbouring class) counts weighed at once
NONE = (1 << 16) - 1


@dataclass(frozen=True)
class Config:
    clustered: int = 512       # words that the driver exchanges until none moves; the others follow in one round
    classes: int = 48
    known: int = 1 << 17       # words whose counts tasks look up themselves
    rounds: int = 6
    pull: float = 4.0          # weight of the class unigram in a transition


def shape(word: bytes) -> int:
    return 8 * (len(word) > 6) + 4 * (not word[-1:].isalnum() and word[-1] < 128) + 2 * (not word.isascii()) + (not word.isalpha())


def vocabulary(training: DataFrame) -> DataFrame:
    """word, c: every training word and the end, counted in the tasks first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Counter()
        out = lambda: pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], ["word", "c"])
        for b in batches:
            for t in b["text"]:
                found.update(words(t.as_py()))
            found[END] += b.num_rows
            if len(found) > 1_000_000:
                yield out()
                found.clear()
        yield out()

    return training.mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class _Numbers(dict):
    """word -> its number, or ``base`` + shape for others (remembered within a bound)."""

    def __init__(self, numbers: dict[bytes, int], base: int):
        super().__init__(numbers)
        self.base, self.first = base, numbers

    def __missing__(self, word: bytes) -> int:
        if len(self) > len(self.first) + CACHED_WORDS:
            self.clear()
            self.update(self.first)
        self[word] = k = self.first.get(word, self.base + shape(word))
        return k


def _values(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a column of bytes, row after row, and where each row begins
    and the last one ends.  (Rows without any come with one offset or none.)"""
    if not len(column):
        return np.zeros(0, kind), np.zeros(1, np.int64)
    _, at, raw = column.buffers()
    at = np.frombuffer(at, np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(raw or b"", np.uint8)[at[0]:at[-1]]
    return raw.view(kind), (at.astype(np.int64) - at[0]) // np.dtype(kind).itemsize


def _bytes(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """A column of bytes: row r holds ``values[at[r]:at[r + 1]]``."""
    raw = np.ascontiguousarray(values[at[0]:at[-1]])
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [
        None, pa.py_buffer(((at - at[0]) * values.itemsize).astype(np.int32)), pa.py_buffer(raw)])


def encoded(docs: DataFrame, known: list[bytes], held_out, id_col: str, text_col: str) -> DataFrame:
    """row, id, held_out, codes, words: the texts as int32 numbers.  A word of
    ``known`` is its place there, the end (once, last) is ``len(known)``, and
    others are above by their shape and their place in ``words``, which holds
    each once."""
    k = len(known)
    shared = docs.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(known)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, nth = _Numbers(shared.value, k + 1), 0
        for whole in batches:
            for at in range(0, whole.num_rows, 200):
                b, codes, others = whole.slice(at, 200), [], []
                for text in b["text"]:
                    tokens = words(text.as_py())
                    i = np.full(len(tokens) + 1, k, np.int32)
                    i[:-1] = np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens))
                    rare = {}
                    which = np.flatnonzero(i > k)
                    if len(which):
                        i[which] += SHAPES * np.fromiter((rare.setdefault(tokens[j], len(rare)) for j in which.tolist()), np.int32, len(which))
                    codes.append(i.tobytes())
                    others.append(list(rare))
                row = (b["task"].to_numpy().astype(np.int64) << 33) + np.arange(nth, nth + b.num_rows)
                nth += b.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row), b["id"], b["held_out"], pa.array(codes, pa.binary()), pa.array(others, pa.list_(pa.binary()))],
                    ["row", "id", "held_out", "codes", "words"])

    rows = docs.select(F.col(id_col).cast("string").alias("id"), held_out.alias("held_out"), text_bytes(text_col).alias("text"),
                       F.spark_partition_id().alias("task"))
    return rows.mapInArrow(run, "row long, id string, held_out boolean, codes binary, words array<binary>")


def _look_up(codes: np.ndarray, table: np.ndarray, first_shape: int) -> np.ndarray:
    """``table``, of the known words and the end, at the codes; numbers by shape for other words."""
    k = len(table) - 1
    out = table[np.minimum(codes, k)]
    others = codes > k
    out[others] = first_shape + (codes[others] - k - 1) % SHAPES
    return out


def _summed(rows: DataFrame, count, side: int) -> np.ndarray:
    """Sum of ``count(batch)``, numbers below ``side`` squared with how often each came, over all batches."""
    size = -(-side * side // CHUNK) * CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        total, task = np.zeros(size, np.int64), None
        for b in batches:
            if b.num_rows:
                task = b["task"][0].as_py()
                total += np.bincount(count(b), minlength=size)
        if task is not None:
            yield pa.RecordBatch.from_pandas(pd.DataFrame({
                "chunk": np.arange(size // CHUNK, dtype=np.int32), "part": np.int32(task % 256), "counts": [c.tobytes() for c in total.reshape(-1, CHUNK)]}))

    partial = rows.withColumn("task", F.spark_partition_id()).mapInArrow(run, "chunk int, part int, counts binary")
    return sum_arrays(partial, size, CHUNK, "int64")[:side * side].reshape(side, side)


def bigrams(training: DataFrame, slots: np.ndarray, m: int) -> np.ndarray:
    """Counts of neighbours over ``m`` clustered words, shapes and the end (last).
    ``slots``: each known word's number among these, and the end's."""
    side = m + SHAPES + 1
    shared = training.sparkSession.sparkContext.broadcast(slots)

    def count(b: pa.RecordBatch) -> np.ndarray:
        s = np.append(side - 1, _look_up(_values(b["codes"], np.int32)[0], shared.value, m))
        return s[:-1] * side + s[1:]

    return _summed(training.select("codes"), count, side)


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(b: np.ndarray, config: Config) -> np.ndarray:
    """Class of every row of ``b``: its last SHAPES + 1 rows are classes of
    their own; the others are moved, the most frequent first, to the class
    that keeps the most mutual information, until a round moves none."""
    m = len(b) - SHAPES - 1
    c = max(1, min(config.classes, m))
    own = np.concatenate([np.arange(m) % c, c + np.arange(SHAPES + 1)])
    g = c + SHAPES + 1
    b = b.astype(float)
    n = np.zeros((g, g))
    np.add.at(n, (own[:, None], own[None]), b)
    diagonal = np.arange(c)
    for _ in range(config.rounds):
        moved = 0
        for w in range(m):
            a, s = own[w], b[w, w]
            out = np.bincount(own, b[w], g)
            into = np.bincount(own, b[:, w], g)
            out[a] -= s
            into[a] -= s
            n[a] -= out
            n[:, a] -= into
            n[a, a] -= s
            rows, cols = n[:c], n[:, :c].T
            gain_out, gain_in = _f(rows + out) - _f(rows), _f(cols + into) - _f(cols)
            corner = n[diagonal, diagonal]
            gain = (gain_out.sum(1) - gain_out[diagonal, diagonal] + gain_in.sum(1) - gain_in[diagonal, diagonal]
                    + _f(corner + out[:c] + into[:c] + s) - _f(corner))
            left, right = n[:c].sum(1), n[:, :c].sum(0)
            gain -= _f(left + out.sum() + s) - _f(left) + _f(right + into.sum() + s) - _f(right)
            best = int(gain.argmax())
            best = a if gain[best] <= gain[a] + 1e-9 else best
            moved += best != a
            own[w] = best
            n[best] += out
            n[:, best] += into
            n[best, best] += s
        if not moved:
            break
    return own


def contexts(training: DataFrame, own: np.ndarray, slots: np.ndarray, m: int) -> DataFrame:
    """word, slots, counts: how often each word outside the clustered ones
    stands before (slot = class) and after (slot = classes + class) each class.

    Known words come in blocks, so that a task gives out few rows for them: a
    row named by the end and the block's number (no word holds a space) holds
    place in the block * 2 * classes + slot instead."""
    g, k = int(own[-1]) + 1, len(slots) - 1
    shared = training.sparkSession.sparkContext.broadcast(own[slots])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        known, places, found, held, named, size = [], [], [], 0, 0, 0

        def give(names, at, places, counts) -> Iterator[pa.RecordBatch]:
            for x in range(0, len(names), GIVEN_WORDS):
                cut = at[x:x + GIVEN_WORDS + 1]
                yield pa.RecordBatch.from_arrays([names[x:x + GIVEN_WORDS], _bytes(places, cut), _bytes(counts, cut)], ["word", "slots", "counts"])

        def out() -> Iterator[pa.RecordBatch]:
            if known:
                key, n = np.unique(np.concatenate(known), return_counts=True)
                block, key = key // (BLOCK * 2 * g), (key % (BLOCK * 2 * g)).astype(np.int32)
                heads = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
                names = pa.array([END + b"%d" % x for x in block[heads].tolist()], pa.binary())
                yield from give(names, np.append(heads, len(key)), key, n.astype(np.int32))
            if places:
                names = pa.concat_arrays(found).dictionary_encode()
                at = np.concatenate(places)
                key, n = np.unique((names.indices.to_numpy().astype(np.int64)[at >> 16] << 16) + (at & NONE), return_counts=True)
                word = key >> 16      # every one of the dictionary, in its order
                heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                yield from give(names.dictionary, np.append(heads, len(key)), (key & NONE).astype(np.uint16), n.astype(np.int32))

        for b in batches:
            if not b.num_rows:
                continue
            codes, at = _values(b["codes"], np.int32)
            s = np.append(own[-1], _look_up(codes, table, int(own[-1]) - SHAPES))
            mine = np.flatnonzero((codes >= m) & (codes < k))
            if len(mine):
                i = codes[mine].astype(np.int64) * 2 * g
                known += [i + s[mine + 2], i + s[mine] + g]
                held += 2 * len(mine)
            theirs = np.flatnonzero(codes > k)
            if len(theirs):
                lists = b["words"]
                first = np.append(0, np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))
                i = (named + np.repeat(first[:-1], np.diff(at))[theirs] + (codes[theirs] - k - 1) // SHAPES) << 16
                places += [i + s[theirs + 2], i + s[theirs] + g]
                found.append(lists.flatten())
                held, named, size = held + 2 * len(theirs), named + int(first[-1]), size + found[-1].nbytes
            if held > HELD_SLOTS or named > HELD_WORDS or size > HELD_BYTES:
                yield from out()
                known, places, found, held, named, size = [], [], [], 0, 0, 0
        yield from out()

    return training.select("codes", "words").mapInArrow(count, "word binary, slots binary, counts binary")


def best_classes(word: np.ndarray, slot: np.ndarray, count: np.ndarray, n: np.ndarray, classes: int) -> np.ndarray:
    """The class, below ``classes``, that keeps the most mutual information for
    each word, given the class bigrams ``n``: (word, slot) are distinct and in order."""
    g = len(n)
    table = np.concatenate([n[:classes].T, n[:, :classes]])     # slot x class
    kept = _f(table)
    heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    left, right = n[:classes].sum(1), n[:, :classes].sum(0)
    after = np.add.reduceat(np.where(slot < g, count, 0), heads)
    before = np.add.reduceat(np.where(slot < g, 0, count), heads)
    moved = np.empty((len(count), classes))
    few = count <= FEW      # most counts: what they change is looked up
    moved[few] = (_f(table + np.arange(FEW + 1)[:, None, None]) - kept)[count[few].astype(np.int64), slot[few]]
    moved[~few] = _f(table[slot[~few]] + count[~few][:, None]) - kept[slot[~few]]
    gain = np.add.reduceat(moved, heads, axis=0)
    for margin, more in ((left, after), (right, before)):
        more, where = np.unique(more, return_inverse=True)
        gain -= (_f(margin + more[:, None]) - _f(margin))[where.ravel()]
    nth = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(word))))
    out, into = np.zeros((len(heads), classes)), np.zeros((len(heads), classes))
    ours, theirs = slot < classes, (slot >= g) & (slot < g + classes)
    out[nth[ours], slot[ours]] = count[ours]
    into[nth[theirs], slot[theirs] - g] = count[theirs]
    w, c = np.nonzero((out > 0) & (into > 0))   # both go to one corner
    o, i, corner = out[w, c], into[w, c], n[c, c]
    gain[w, c] += _f(corner + o + i) + _f(corner) - _f(corner + o) - _f(corner + i)
    return gain.argmax(1)


def assign(found: DataFrame, n: np.ndarray, classes: int) -> DataFrame:
    """word, number, class, c of every word of ``contexts``, given the class
    bigrams: known words by their number, others by the word."""
    shared = found.sparkSession.sparkContext.broadcast(n)
    g = len(n)
    names = ["word", "number", "class", "c"]

    def batch(word: pa.Array, number: pa.Array, of: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([word, number, pa.array(of.astype(np.int32)), pa.array(c.astype(np.int64))], names)

    def weigh(key: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Classes and counts of words, given distinct ``key`` = word * 2 * classes + slot in order."""
        word, slot = key // (2 * g), key % (2 * g)
        heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        return best_classes(word, slot, count, shared.value, classes), np.add.reduceat(np.where(slot < g, count, 0), heads)

    def known(block: int, total: np.ndarray) -> Iterator[pa.RecordBatch]:
        key = np.flatnonzero(total)
        number = block * BLOCK + np.unique(key // (2 * g))
        yield batch(pa.nulls(len(number), pa.binary()), pa.array(number.astype(np.int32)), *weigh(key, total[key].astype(float)))

    def others(b: pa.RecordBatch, new: np.ndarray) -> Iterator[pa.RecordBatch]:
        """``new``: whether a row's word is another than the row's before."""
        slots, at = _values(b["slots"], np.uint16)
        counts, _ = _values(b["counts"], np.int32)
        heads = np.flatnonzero(new)
        begins, x = at[heads], 0
        while x < len(heads):
            y = int(np.searchsorted(begins, begins[x] + ENTRIES))
            first, last = heads[x], heads[y] if y < len(heads) else len(new)
            nth = np.cumsum(new[first:last]) - 1
            key, where = np.unique(np.repeat(nth, np.diff(at[first:last + 1])) * 2 * g + slots[at[first]:at[last]], return_inverse=True)
            count = np.bincount(where, counts[at[first]:at[last]], len(key))
            yield batch(b["word"].take(pa.array(heads[x:y])), pa.nulls(y - x, pa.int32()), *weigh(key, count))
            x = y

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total, open_ = None, None, []     # open_: rows of the last word so far
        for b in batches:   # sorted by word
            if not b.num_rows:
                continue
            raw, at = _values(b["word"], np.uint8)
            mine = raw[at[:-1]] == END[0]
            for r in np.flatnonzero(mine).tolist():
                name = int(b["word"][r].as_py()[1:])
                if name != block:
                    if block is not None:
                        yield from known(block, total)
                    block, total = name, np.zeros(BLOCK * 2 * g, np.int64)
                total[np.frombuffer(b["slots"][r].as_py(), np.int32)] += np.frombuffer(b["counts"][r].as_py(), np.int32)
            if mine.any():
                b = b.filter(pa.array(~mine))
            if not b.num_rows:
                continue
            if open_ and open_[-1]["word"][-1] == b["word"][0] == b["word"][-1]:
                open_.append(b)
                continue
            b = pa.Table.from_batches([*open_, b]).combine_chunks().to_batches()[0]
            new = np.append(True, pc.not_equal(b["word"][1:], b["word"][:-1]).to_numpy(zero_copy_only=False))
            last = int(np.flatnonzero(new)[-1])
            if last:
                yield from others(b[:last], new[:last])
            open_ = [b[last:]]
        if block is not None:
            yield from known(block, total)
        if open_:
            b = pa.Table.from_batches(open_).combine_chunks().to_batches()[0]
            yield from others(b, np.arange(b.num_rows) == 0)

    return (found.repartition("word").sortWithinPartitions("word")
            .mapInArrow(run, "word binary, number int, class int, c long"))


def class_bigrams(sequences: DataFrame, g: int) -> np.ndarray:
    """Class bigrams of the training texts; words seen once also count as
    unseen ones, in their shape's class (``other``)."""
    def count(b: pa.RecordBatch) -> np.ndarray:
        s = np.append(g - 1, _values(b["s"], np.uint16)[0].astype(np.int64))     # the end is the last class
        other = _values(b["other"], np.uint16)[0].astype(np.int64)
        at = np.flatnonzero(other != NONE)
        return np.concatenate([s[:-1] * g + s[1:], s[at] * g + other[at], other[at] * g + s[at + 2]])

    return _summed(sequences.where("not held_out").select("s", "other"), count, g)


def _by_class(b: np.ndarray, own: np.ndarray) -> np.ndarray:
    g = int(own.max()) + 1
    n = np.zeros((g, g))
    np.add.at(n, (own[:, None], own[None]), b.astype(float))
    return n


def _transitions(n: np.ndarray, pull: float) -> np.ndarray:
    """log10 P(next class | class)."""
    g = len(n)
    unigram = (n.sum(0) + 1) / (n.sum() + g)
    return np.log10((n + pull * unigram[None]) / (n.sum(1)[:, None] + pull))


def _frequent(vocab: DataFrame, most: int) -> pd.DataFrame:
    """The words from a count upwards that are ``most`` at most."""
    fine = F.floor(F.log2("c") * 16).cast("int")
    bins = {r["bin"]: r["n"] for r in vocab.groupBy(fine.alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect()}  # under 1024
    total, least = 0, 1024
    for k in sorted(bins, reverse=True):
        if total + bins[k] > most:
            break
        total, least = total + bins[k], k
    return vocab.where(fine >= least).select("word", "c").toPandas()


def score(docs: DataFrame, held_out, *, config: Config = Config(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, held_out, n_tokens, n_known, train_tokens, base_score, score
    (both log10) and perplexity.

    Learns from the rows for which the condition ``held_out`` is false, scores
    all.  Null and empty texts are the end token alone; null and repeated ids
    and repeated rows are rows like any other; with no training row every base
    probability is 1.  An empty table gives no rows; other columns are not
    read.
    """
    spark = docs.sparkSession
    vocab = store(spark, vocabulary(docs.where(~held_out).select(text_bytes(text_col).alias("text"))), "brown-vocabulary")
    totals = vocab.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = totals["n"] or 0, totals["v"]
    top = _frequent(vocab, config.known)
    top["word"] = [bytes(w) for w in top["word"]]
    top = top.sort_values(["c", "word"], ascending=[False, True], ignore_index=True)
    end_count = int(top.loc[top["word"] == END, "c"].sum())
    if not end_count:  # the end is rarer than the known words
        end_count = (vocab.where(F.col("word") == F.lit(END)).agg(F.sum("c")).first()[0]) or 0
    top = top[top["word"] != END].reset_index(drop=True)
    counts, shapes = top["c"].to_numpy(float), np.array([shape(w) for w in top["word"]], np.int64)
    k = len(top)
    m = min(config.clustered, k)
    mine = store(spark, encoded(docs, top["word"].tolist(), held_out, id_col, text_col), "brown-codes")
    training = mine.where("not held_out")
    slots = np.concatenate([np.arange(m), m + shapes[m:], [m + SHAPES]])
    b = bigrams(training, slots, m)
    own = exchange(b, config)
    first_shape, g = int(own[m]), int(own[-1]) + 1
    rest = store(spark, assign(contexts(training, own, slots, m), _by_class(b, own), first_shape), "brown-classes")

    classes = np.concatenate([own[:m], np.zeros(k - m, np.int64), own[-1:]])     # of the known words and the end
    found = rest.where("number IS NOT NULL").select("number", "class").toPandas()     # config.known words at most
    classes[found["number"].to_numpy(np.int64)] = found["class"].to_numpy(np.int64)
    # Emissions: all classes' totals over the whole vocabulary.
    within = np.bincount(own[:m], counts[:m], first_shape) if m else np.zeros(first_shape)
    for r in rest.groupBy("class").agg(F.sum("c").alias("n")).collect():
        within[r["class"]] += r["n"]
    whole = math.log10(n + 0.5 * (v + 1))
    shared = spark.sparkContext.broadcast({  # four numbers of each known word and of the end
        "classes": classes, "emit": np.append(np.log10(counts / within[classes[:k]]), 0.0),
        "base": np.append(np.log10(counts + 0.5), math.log10(end_count + 0.5)) - whole,
        "other": np.append(np.where(counts == 1, first_shape + shapes, NONE), NONE)})
    end_known = int(end_count > 0)
    # The words that tasks can't look up: their classes and counts come by a join.
    others = rest.where("number IS NULL").select("word", "class", "c")
    each = mine.select("row", F.posexplode("words").alias("nth", "word"))
    known = (each.join(others, "word").groupBy("row")
             .agg(F.collect_list(F.struct("nth", "class", "c")).alias("x"))
             .select("row", F.col("x.nth").alias("nth"), F.col("x.class").alias("class"), F.col("x.c").alias("c")))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, at = _values(batch["codes"], np.int32)
            place, starts = np.minimum(codes, k), at[:-1]
            s, base, emit, other = (held[x][place] for x in ("classes", "base", "emit", "other"))
            n_known = (codes < k).astype(np.int64)
            theirs = np.flatnonzero(codes > k)
            if len(theirs):
                which, form = np.divmod(codes[theirs] - k - 1, SHAPES)
                first = np.append(0, np.cumsum(batch["n_words"].to_numpy()))
                c, of = np.zeros(first[-1], np.int64), np.zeros(first[-1], np.int64)
                joined = pc.fill_null(pc.list_value_length(batch["nth"]), 0).to_numpy(zero_copy_only=False)
                into = np.repeat(first[:-1], joined) + batch["nth"].flatten().to_numpy()
                c[into], of[into] = batch["c"].flatten().to_numpy(), batch["class"].flatten().to_numpy()
                which = which + np.repeat(first[:-1], np.diff(at))[theirs]
                c, of = c[which], of[which]
                seen, once, form = c > 0, c == 1, first_shape + form
                n_known[theirs] = seen
                base[theirs] = np.log10(c + 0.5) - whole
                emit[theirs[seen]] = np.log10(c[seen] / within[of[seen]])
                other[theirs[once]] = form[once]
                s[theirs] = np.where(seen, of, form)
            sums = [pa.array(x) for x in (np.diff(at), np.add.reduceat(n_known, starts) + end_known, np.add.reduceat(base, starts), np.add.reduceat(emit, starts))]
            yield pa.RecordBatch.from_arrays([batch["id"], batch["held_out"], *sums, _bytes(s.astype(np.uint16), at), _bytes(other.astype(np.uint16), at)],
                                             ["id", "held_out", "n_tokens", "n_known", "base", "emit", "s", "other"])

    wide = (mine.select("row", "id", "held_out", "codes", F.size("words").alias("n_words")).join(known, "row", "left")
            .select("id", "held_out", "codes", "n_words", "nth", "class", "c"))
    sequences = store(spark, wide.mapInArrow(fill, "id string, held_out boolean, n_tokens long, n_known long, base double, emit double, "
                                             "s binary, other binary"), "brown-sequences")
    step = spark.sparkContext.broadcast(_transitions(class_bigrams(sequences, g), config.pull))

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                s, at = _values(b["s"], np.uint16)
                steps = np.add.reduceat(step.value[np.append(g - 1, s[:-1]), s], at[:-1])
                yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(b["emit"].to_numpy() + steps)],
                                                 ["id", "held_out", "n_tokens", "n_known", "base", "emit"])

    scored = sequences.select("id", "held_out", "n_tokens", "n_known", "base", "emit", "s").mapInArrow(
        total, "id string, held_out boolean, n_tokens long, n_known long, base double, emit double")
    result = scored.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "held_out", "n_tokens", "n_known",
        F.lit(n).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), F.col("emit").alias("score"))
    return result.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
