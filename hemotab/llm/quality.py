"""Quality classifier: a factorisation machine.

Features of a text are its hashed words (tf damped, unit norm), binned
structure statistics and binned metadata.  A factorisation machine adds to
their linear weights the pairwise interactions of low-rank factors, scored
in time linear in the features by the sum-of-squares identity

    sum_{i<j} <v_i, v_j> x_i x_j  =  1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

Fitted by AdaGrad on a bounded sample of labelled training rows
(``Config.sample_rows``); scoring is one map pass over all texts.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from hemotab.llm import labelled
from hemotab.llm.common import words

BINS = 12
STATS = 13
CACHED_WORDS = 200_000

# Byte classes: 0 lower, 1 upper, 2 digit, 3 space, 4 line end, 5 punctuation, 6 symbol, 7 beyond ASCII.
_CLASS = np.full(256, 6, np.uint8)
_CLASS[[*range(97, 123)]] = 0
_CLASS[[*range(65, 91)]] = 1
_CLASS[[*range(48, 58)]] = 2
_CLASS[[9, 11, 12, 13, 32]] = 3
_CLASS[10] = 4
_CLASS[[*b".,;:!?'\"()-"]] = 5
_CLASS[128:] = 7


@dataclass(frozen=True)
class Config:
    sample_rows: int = 8000      # bound on the labelled rows fitted on
    bits: int = 16               # word buckets: 2 ** bits
    factors: int = 8
    epochs: int = 4
    rate: float = 0.15
    decay: float = 1e-5

    @property
    def size(self) -> int:
        return (1 << self.bits) + (STATS + 8) * BINS


class _Buckets(dict):
    """word -> bucket; forgets all when full, so memory is bounded."""

    def __init__(self, mask: int):
        self.mask = mask

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = b = zlib.crc32(word) & self.mask
        return b


def _bin(share: float) -> int:
    """0 to BINS-1, finer near 0."""
    return min(BINS - 1, int(np.sqrt(max(share, 0.0)) * BINS))


def _log_bin(n: float) -> int:
    return min(BINS - 1, int(np.log2(n + 1) * 0.6))


def features(text: bytes, meta: list, buckets: _Buckets, size_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers and their values."""
    tokens = words(text)
    n = len(tokens)
    ids = np.fromiter(map(buckets.__getitem__, tokens), np.int64, n)
    ids, tf = np.unique(ids, return_counts=True)
    x = np.log1p(tf)
    x /= max(np.sqrt((x * x).sum()), 1e-9)
    share = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=8) / max(len(text), 1)
    lines = text.count(b"\n") + 1
    bins = [_log_bin(len(text)), _log_bin(n), *map(_bin, share[:8]),
            _bin(len(ids) / max(n, 1)), _bin(tf.max() / n if n else 1.0), _log_bin(n / lines)]
    for value in meta:
        bins.append(0 if value is None or value != value or value < 0 else 1 + min(BINS - 2, _log_bin(value)))
    at = size_words + np.arange(len(bins)) * BINS + bins
    return np.concatenate([ids, at]), np.concatenate([x, np.full(len(bins), 1 / np.sqrt(len(bins)))])


def margin(model: dict, i: np.ndarray, x: np.ndarray) -> float:
    vx = model["v"][i] * x[:, None]
    s = vx.sum(0)
    return float(model["w0"] + model["w"][i] @ x + 0.5 * ((s * s).sum() - (vx * vx).sum()))


def _probability(m: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(m, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], config: Config) -> dict:
    """AdaGrad on the log loss.  With no rows the score is 0.5 everywhere."""
    rng = np.random.default_rng(7)
    w, v = np.zeros(config.size), rng.normal(0, 0.02, (config.size, config.factors))
    gw, gv = np.full(config.size, 1e-3), np.full((config.size, config.factors), 1e-3)
    ys = np.array([y for _, _, y in rows])
    base = np.clip(ys.mean(), 0.01, 0.99) if len(rows) else 0.5
    model = {"w0": float(np.log(base / (1 - base))), "w": w, "v": v}
    g0 = 1e-3
    for _ in range(config.epochs):
        for r in rng.permutation(len(rows)):
            i, x, y = rows[r]
            vx = v[i] * x[:, None]
            s = vx.sum(0)
            m = model["w0"] + w[i] @ x + 0.5 * ((s * s).sum() - (vx * vx).sum())
            g = _probability(m) - y
            dw, dv = g * x + config.decay * w[i], g * (x[:, None] * (s - vx)) + config.decay * v[i]
            gw[i] += dw * dw
            gv[i] += dv * dv
            w[i] -= config.rate * dw / np.sqrt(gw[i])
            v[i] -= 0.3 * config.rate * dv / np.sqrt(gv[i])
            g0 += g * g
            model["w0"] -= config.rate * g / np.sqrt(g0)
    return {"w0": model["w0"], "w": w.astype(np.float32), "v": v.astype(np.float32)}


def _meta(batch: pd.DataFrame, cols: tuple[str, ...]) -> list[list]:
    return [[r[k] for k in range(len(cols))] for r in zip(*[batch[f"x_{c}"] for c in cols])] if cols else [[]] * len(batch)


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", *, config: Config = Config(),
          id_col: str = "doc_id", text_col: str = "text", metadata: tuple[str, ...] = ()) -> dict:
    """The model, from at most ``config.sample_rows`` labelled rows outside fold 0."""
    rows, _ = labelled.sample(docs, labels, target, config.sample_rows, id_col=id_col, text_col=text_col, extra=metadata)

    def vectors(batches):
        buckets = _Buckets((1 << config.bits) - 1)
        for b in batches:
            got = [features(t, m, buckets, 1 << config.bits) for t, m in zip(b["text"], _meta(b, metadata))]
            yield pd.DataFrame({"id": b["id"].astype(str), "y": b["y"], "i": [i.astype(np.int32).tobytes() for i, _ in got],
                                "x": [x.astype(np.float32).tobytes() for _, x in got]})

    got = rows.mapInPandas(vectors, "id string, y int, i binary, x binary").toPandas().sort_values(["id", "y"])
    return fit([(np.frombuffer(i, np.int32), np.frombuffer(x, np.float32).astype(float), y)
                for i, x, y in zip(got["i"], got["x"], got["y"])], config)


def score(docs: DataFrame, model: dict, *, config: Config = Config(), id_col: str = "doc_id",
          text_col: str = "text", metadata: tuple[str, ...] = (), threshold: float = 0.3) -> DataFrame:
    """``id_col``, held_out, score (0 to 1) and predicted of every row.

    Null text counts as empty (scored by its statistics alone), null
    metadata has a bin of its own, null and repeated ids are rows like any
    other, an empty table gives no rows.  ``metadata`` names numeric columns;
    no other column is read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** bits rows of 1 + factors floats

    def scorer():
        held, buckets = shared.value, _Buckets((1 << config.bits) - 1)
        return lambda b: [_probability(margin(held, *features(t, m, buckets, 1 << config.bits)))
                          for t, m in zip(b["text"], _meta(b, metadata))]

    return labelled.score_texts(docs, scorer, id_col=id_col, text_col=text_col, extra=metadata, threshold=threshold)
