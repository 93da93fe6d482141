"""Fill-in-the-middle transformation by in-place block rotation.

A text becomes a bytearray.  Its units (``[A-Za-z]+|[^A-Za-z]`` over code
points) are scanned chunk by chunk, first to count them and then to find the
two cuts.  The sentinels are inserted at the cuts in the order prefix, middle,
suffix, and neighbouring blocks are exchanged by three reversals in place:
``<P>prefix<M>middle<S>suffix`` turns into psm or spm by one rotation.
``restore`` finds the sentinels, applies the inverse rotation and takes the
sentinels out again.

Cuts and form of a document depend on its id and ``seed`` alone, so a task
that runs again gives the same rows.  There is no shuffle; a task holds one
slice of rows and the document it works on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemotab.llm.common import text_bytes

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SCAN_BYTES = 1 << 20       # of a text at a time when scanning for units
SWAP_BYTES = 1 << 16       # exchanged at a time when reversing
SLICE_BYTES = 8 << 20      # of texts handed on at a time

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def _starts(text: bytes | bytearray) -> Iterator[tuple[int, np.ndarray]]:
    """(place of the chunk, which of its bytes begin a unit), chunk by chunk.
    A unit begins at a letter after a non-letter and at every other code point."""
    before = False
    for at in range(0, len(text), SCAN_BYTES):
        b = np.frombuffer(text, np.uint8, min(SCAN_BYTES, len(text) - at), at)
        letter = _LETTER[b]
        begins = (b & 0xC0) != 0x80
        begins[1:] &= ~(letter[1:] & letter[:-1])
        begins[0] &= not (before and letter[0])
        if at == 0:
            begins[0] = True
        before = bool(letter[-1])
        yield at, begins


def count_units(text: bytes | bytearray) -> int:
    return sum(int(np.count_nonzero(b)) for _, b in _starts(text))


def unit_places(text: bytes | bytearray, units: list[int]) -> list[int]:
    """Byte place at which so many units have ended, for each of ``units`` (ascending)."""
    out, seen, left = [], 0, list(units)
    for at, begins in _starts(text):
        n = int(np.count_nonzero(begins))
        if left and left[0] < seen + n:
            where = np.flatnonzero(begins)
            while left and left[0] < seen + n:
                out.append(at + int(where[left.pop(0) - seen]))
        if not left:
            break
        seen += n
    return out + [len(text)] * len(left)


def code_points(text: bytes | bytearray, start: int, end: int) -> int:
    return sum(int(np.count_nonzero((np.frombuffer(text, np.uint8, min(SCAN_BYTES, end - at), at) & 0xC0) != 0x80))
               for at in range(start, end, SCAN_BYTES))


def reverse(b: np.ndarray) -> None:
    """Reverse the bytes in place, a bounded stretch from each end at a time."""
    lo, hi = 0, len(b)
    while hi - lo > 1:
        k = min(SWAP_BYTES, (hi - lo) // 2)
        head = b[lo:lo + k].copy()
        b[lo:lo + k] = b[hi - k:hi][::-1]
        b[hi - k:hi] = head[::-1]
        lo, hi = lo + k, hi - k


def rotate(buffer: bytearray, start: int, middle: int) -> None:
    """Exchange the neighbouring blocks ``[start, middle)`` and ``[middle, end)``
    in place: each block reversed, then both together."""
    b = np.frombuffer(buffer, np.uint8)[start:]
    reverse(b[:middle - start])
    reverse(b[middle - start:])
    reverse(b)


def draws(key: str, seed: int) -> list[int]:
    """Four numbers of 32 bits from the id."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in range(0, 32, 8)]


def arrange(text: bytes, h: list[int], plain_percent: int, spm_percent: int) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, code points of prefix and middle, output) of a text."""
    n = count_units(text)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= 100 - plain_percent:
        return n, PLAIN, None, None, text
    a, b = unit_places(text, sorted((h[0] % (n + 1), h[1] % (n + 1))))
    sizes = code_points(text, 0, a), code_points(text, a, b)
    buffer = bytearray(text)
    for at, sentinel in ((b, SUFFIX), (a, MIDDLE), (0, PREFIX)):
        buffer[at:at] = sentinel
    middle, suffix = len(PREFIX) + a, len(PREFIX) + len(MIDDLE) + b
    spm = h[3] % 100 < spm_percent
    rotate(buffer, 0 if spm else middle, suffix)
    return n, SPM if spm else PSM, *sizes, bytes(buffer)


def rebuild(output: bytes, form: str) -> bytes:
    """The text that ``arrange`` was given."""
    if form == PLAIN:
        return output
    buffer = bytearray(output)
    # The text holds no sentinel and none can arise across a border, so each is found once.
    if form == PSM:
        start, suffix, middle = 0, output.index(SUFFIX), output.index(MIDDLE)
        rotate(buffer, suffix, middle)
        middle, suffix = suffix, suffix + len(output) - middle
    else:
        start, middle = output.index(PREFIX), output.index(MIDDLE)
        rotate(buffer, 0, start)
        middle, suffix, start = middle - start, len(output) - start, 0
    for at, sentinel in ((suffix, SUFFIX), (middle, MIDDLE), (start, PREFIX)):
        del buffer[at:at + len(sentinel)]
    return bytes(buffer)


def _slices(batch: pd.DataFrame, col: str) -> Iterator[pd.DataFrame]:
    """The batch in slices of about SLICE_BYTES of ``col``."""
    part = np.cumsum(batch[col].map(len).to_numpy(np.int64)) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(batch)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.iloc[a:b]


def transform(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
              plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """One row per document: ``id_col``, n (units), form, prefix_chars,
    middle_chars (null if plain) and output (binary).

    Null and empty texts and texts that hold a sentinel stay as they are
    (plain).  A null id draws like an empty one; equal ids draw alike;
    repeated rows give repeated rows; an empty table gives no rows; other
    columns are not read.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b in _slices(batch, "text"):
                rows = [(i, *arrange(t, draws(i or "", seed), plain_percent, spm_percent))
                        for i, t in zip(b["id"], b["text"])]
                out = pd.DataFrame(rows, columns=["id", "n", "form", "prefix_chars", "middle_chars", "output"])
                yield out.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    rows = docs.select(F.col(id_col).cast("string").alias("id"), text_bytes(text_col).alias("text"))
    out = rows.mapInPandas(run, "id string, n long, form string, prefix_chars long, middle_chars long, output binary")
    return out.withColumn("id", F.col("id").cast(docs.schema[id_col].dataType)).withColumnRenamed("id", id_col)


def restore(arranged: DataFrame, *, output_col: str = "output", form_col: str = "form") -> DataFrame:
    """``arranged`` with the text rebuilt from output and form, as binary ``restored``."""
    arranged = arranged.drop("restored")
    names = arranged.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b in _slices(batch, output_col):
                yield b.assign(restored=[rebuild(bytes(o), f) for o, f in zip(b[output_col], b[form_col])])[[*names, "restored"]]

    # Integers beside nulls would turn into floats in pandas; text keeps them.
    kinds = {f.name: f.dataType for f in arranged.schema.fields}
    shown = [F.col(c) if c == output_col else F.col(c).cast("string").alias(c) for c in names]
    schema = ", ".join(f"`{c}` {'binary' if c == output_col else 'string'}" for c in names) + ", restored binary"
    out = arranged.select(*shown).mapInPandas(run, schema)
    return out.select(*[F.col(c) if c == output_col else F.col(c).cast(kinds[c]).alias(c) for c in names], "restored")
