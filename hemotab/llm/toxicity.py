"""Toxicity by class-conditional Kneser-Ney models.

Two models, of toxic and of ordinary texts, spell words byte by byte
(n-grams of ``Config.order`` within a word), so that inflections of a stem
share its evidence.  Both are interpolated Kneser-Ney models: the class's own
counts at the top, its continuation counts below, and from ``Config.shared``
bytes down continuation counts of both classes together, so that spelling
rare in either says nothing about the class.

A text's log-likelihood difference is normalised by length twice: per token
over the whole text, and per token in the run of ``Config.window`` words where
it is largest, which an insult in a very long text still moves.  A logistic
curve over the two, fitted on labelled rows that the counts did not see, gives
the score.

Counts come from a bounded labelled sample and are summed by Spark; scoring is
one map pass over all texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemotab.llm import labelled
from hemotab.llm.common import text_bytes, words

CACHED_WORDS = 400_000
START, END = b" ", b"\n"   # no word holds them


@dataclass(frozen=True)
class Config:
    sample_rows: int = 4000      # bound on the labelled rows of each class
    order: int = 5               # bytes in an n-gram, 7 at most
    shared: int = 3              # levels of this many bytes or fewer are common to both classes
    discount: float = 0.75
    window: int = 4
    calibrate: int = 4           # one in so many sampled rows fits the curve


def _grams(vocabulary: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of all words as integers, and the first of each word."""
    if not vocabulary:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pad = START * (order - 1)
    whole = np.frombuffer(b"".join(pad + w + END for w in vocabulary), np.uint8).astype(np.int64)
    lengths = np.fromiter(map(len, vocabulary), np.int64, len(vocabulary)) + 1
    first = np.cumsum(lengths) - lengths
    # The k-th symbol of word j ends its gram at offset (order - 1) * (j + 1) + first_j + k.
    at = np.arange(lengths.sum()) + np.repeat((np.arange(len(vocabulary)) + 1) * (order - 1), lengths)
    key = np.zeros(len(at), np.int64)
    for back in range(order - 1, -1, -1):
        key = (key << 8) | whole[at - back]
    return key, first


def _level(keys: np.ndarray, n: np.ndarray) -> dict:
    context, at = np.unique(keys >> 8, return_inverse=True)
    return {"keys": keys, "n": n.astype(np.float64), "context": context,
            "total": np.bincount(at, weights=n, minlength=len(context)), "kinds": np.bincount(at, minlength=len(context))}


def _lookup(keys: np.ndarray, wanted: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    if not len(keys):
        return [np.zeros(len(wanted)) for _ in values]
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    found = keys[at] == wanted
    return [np.where(found, v[at], 0.0) for v in values]


def estimate(counts: pd.DataFrame, config: Config) -> dict:
    """Level tables from (y, gram, n)."""
    own = []
    for y in (0, 1):
        part = counts[counts["y"] == y].sort_values("gram")
        keys, n = part["gram"].to_numpy(np.int64), part["n"].to_numpy(float)
        levels = {config.order: _level(keys, n)}
        for k in range(config.order - 1, config.shared, -1):
            keys, n = np.unique(keys & ((1 << 8 * k) - 1), return_counts=True)
            levels[k] = _level(keys, n)
        own.append(levels)
    above = np.union1d(own[0][config.shared + 1]["keys"], own[1][config.shared + 1]["keys"])
    common = {}
    for k in range(config.shared, 0, -1):
        above, n = np.unique(above & ((1 << 8 * k) - 1), return_counts=True)
        common[k] = _level(above, n)
    return {"own": own, "common": common}


def _step(level: dict, gram: np.ndarray, below: np.ndarray, discount: float) -> np.ndarray:
    (n,) = _lookup(level["keys"], gram, level["n"])
    total, kinds = _lookup(level["context"], gram >> 8, level["total"], level["kinds"])
    seen = np.maximum(total, 1)
    return np.where(total > 0, (np.maximum(n - discount, 0) + discount * kinds * below) / seen, below)


def word_differences(model: dict, vocabulary: list[bytes], config: Config) -> np.ndarray:
    """log P(word | toxic) - log P(word | ordinary) of each word."""
    if not vocabulary:
        return np.zeros(0)
    grams, first = _grams(vocabulary, config.order)
    kinds, at = np.unique(grams, return_inverse=True)
    p = np.full(len(kinds), 1 / 256)
    for k in range(1, config.shared + 1):
        p = _step(model["common"][k], kinds & ((1 << 8 * k) - 1), p, config.discount)
    logs = []
    for levels in model["own"]:
        q = p
        for k in range(config.shared + 1, config.order + 1):
            q = _step(levels[k], kinds & ((1 << 8 * k) - 1), q, config.discount)
        logs.append(np.log(q))
    return np.add.reduceat((logs[1] - logs[0])[at], first)


class Scorer:
    """(mean, largest window mean) per text; remembers words within a bound."""

    def __init__(self, model: dict, config: Config):
        self.model, self.config, self.known = model, config, {}

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros((len(texts), 2))
        for start in range(0, len(texts), 200):
            tokens = [words(t) for t in texts[start:start + 200]]
            if len(self.known) > CACHED_WORDS:
                self.known.clear()
            new = list(set().union(*tokens) - self.known.keys())
            self.known.update(zip(new, word_differences(self.model, new, self.config).tolist()))
            for k, t in enumerate(tokens):
                if t:
                    out[start + k] = self._of(np.fromiter(map(self.known.__getitem__, t), float, len(t)))
        return out

    def _of(self, d: np.ndarray) -> tuple[float, float]:
        w = self.config.window
        if len(d) <= w:
            return d.mean(), d.sum() / w
        sums = np.concatenate([[0.0], np.cumsum(d)])
        return d.mean(), (sums[w:] - sums[:-w]).max() / w


def curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
    """Logistic fit by Newton's method with a small ridge; without both
    classes, the sign of the window difference decides."""
    if not len(y) or y.min() == y.max():
        return {"centre": np.zeros(2), "scale": np.ones(2), "beta": np.array([0.0, 4.0, 0.0])}
    centre, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([(x - centre) / scale, np.ones(len(x))])
    beta = np.zeros(3)
    ridge = np.diag([0.5, 0.05, 1e-6])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + ridge + 1e-9 * np.eye(3),
                               z.T @ (weight * (p - y)) + ridge @ beta)
        beta -= np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return {"centre": centre, "scale": scale, "beta": beta}


def probability(fitted: dict, x: np.ndarray) -> np.ndarray:
    m = (x - fitted["centre"]) / fitted["scale"] @ fitted["beta"][:2] + fitted["beta"][2]
    return 1 / (1 + np.exp(-np.clip(m, -30, 30)))


def gram_counts(rows: DataFrame, config: Config) -> DataFrame:
    """y, gram, n: n-grams of the class's words, a word counted once in a row."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for y, group in b.groupby("y"):
                found = Counter()
                for t in group["text"]:
                    found.update(set(words(t)))
                grams, first = _grams(list(found), config.order)
                keys, at = np.unique(grams, return_inverse=True)
                each = np.diff(np.append(first, len(grams)))
                weights = np.repeat(np.fromiter(found.values(), float, len(found)), each)
                yield pd.DataFrame({"y": y, "gram": keys, "n": np.bincount(at, weights, len(keys)).astype(np.int64)})

    return rows.mapInPandas(count, "y int, gram long, n long").groupBy("y", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, labels: DataFrame, target: str = "toxic", *, config: Config = Config(),
          id_col: str = "doc_id", text_col: str = "text") -> dict:
    """The models and the curve, from at most ``config.sample_rows`` labelled
    rows of each class outside fold 0."""
    rows, totals = labelled.sample(docs, labels, target, config.sample_rows, id_col=id_col, text_col=text_col, per_class=True)
    aside = F.pmod(F.xxhash64("id", F.lit("curve")), F.lit(config.calibrate)) == 0
    model = estimate(gram_counts(rows.where(~aside), config).toPandas(), config)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value, config)
        for b in batches:
            x = scorer(list(b["text"]))
            yield pd.DataFrame({"y": b["y"].to_numpy(), "mean": x[:, 0], "top": x[:, 1]})

    got = rows.where(aside).mapInPandas(measure, "y int, mean double, top double").toPandas()
    y = got["y"].to_numpy()
    weight = np.array([totals.get(k, 0) / (y == k).sum() for k in y], float)
    model["curve"] = curve(got[["mean", "top"]].to_numpy(), y, weight * len(y) / max(weight.sum(), 1e-9))
    return model


def score(docs: DataFrame, model: dict, *, config: Config = Config(), id_col: str = "doc_id",
          text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``id_col``, held_out, score (0 to 1) and predicted of every row.

    Null text counts as empty; a text without words has both differences 0.
    Null and repeated ids are rows like any other, an empty table gives no
    rows, and no other column is read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def scorer():
        measure = Scorer(shared.value, config)
        return lambda b: probability(shared.value["curve"], measure(list(b["text"])))

    return labelled.score_texts(docs, scorer, id_col=id_col, text_col=text_col, threshold=threshold)


def clean_documents(docs: DataFrame, model: dict, *, config: Config = Config(), text_col: str = "text",
                    threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` scored below the threshold, with all columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        measure = Scorer(shared.value, config)
        for t in texts:
            yield pd.Series(probability(shared.value["curve"], measure(list(t))) < threshold)

    return docs.where(clean(text_bytes(text_col)))
