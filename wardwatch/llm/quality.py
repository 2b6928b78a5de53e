"""Text quality by positive-unlabelled learning.

Known: texts trusted to be good, and the texts of the corpus itself, labelled or
not, whose quality is unknown. A text is
described by counts that do not depend on its topic (kinds of characters,
repetition of words, word pairs and lines, lengths); the model adds one weight
for each feature's quantile bin.

* Prior. The share of good texts among the unknown ones is estimated without a
  label of a bad text: of all score thresholds of a first model that tells
  trusted from unknown, the least ratio of the unknown texts' share above it to
  the trusted texts' share above it bounds the prior (with a confidence term).
* Risk. With prior p and logistic loss l, the non-negative unbiased risk
  ``p E_pos[l(f)] + max(0, E_unl[l(-f)] - p E_pos[l(-f)])`` is minimised; where the
  second part falls below zero, its gradient is followed upwards instead.

Scale: the fit uses about ``sample`` trusted texts and twice as many unknown ones (a
documented parameter; rows are drawn by a 64-bit hash of their id, which spreads over all data
and is the same in every run), one row an id, joined to their texts by a broadcast
of the drawn ids. Scoring is one narrow pass over all texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 20_000
BINS = 12
STEPS = 300

# kinds of bytes whose shares are features
KINDS = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\r\n", b"!", b"|", b"*#$%&@^~",
         b"=+<>/\\_`", b".,;:?", b"\"'()[]{}-", bytes(range(128, 256))]
_kind = np.zeros(256, np.uint8)
for _k, _members in enumerate(KINDS):
    _kind[list(_members)] = _k + 1


def features(text: str | None) -> list[float]:
    """The description of a text; a null one is empty."""
    raw = (text or "").encode()
    words, lines = raw.split(), raw.split(b"\n")
    n, nw = max(1, len(raw)), max(1, len(words))
    shares = np.bincount(_kind[np.frombuffer(raw, np.uint8)], minlength=len(KINDS) + 1) / n
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    return [np.log1p(len(raw)), np.log1p(len(words)), len(raw) / nw, len(counts) / nw, len(counts) / nw ** 0.5,
            pairs / max(1, nw - 1), max(counts.values(), default=0) / nw, sum(map(eq, words, words[1:])) / nw,
            len(set(lines)) / len(lines), np.log1p(n / len(lines)), *shares.tolist()]


class Model:
    """An additive model over quantile bins, fitted on features of trusted and unknown texts."""

    def __init__(self, trusted: np.ndarray, unknown: np.ndarray, prior: float | None = None):
        both = np.concatenate((trusted, unknown))
        self.edges = [np.unique(np.quantile(both[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(both.shape[1])]
        self.places = np.concatenate(([0], np.cumsum([len(e) + 1 for e in self.edges])))
        p, u = self._bins(trusted), self._bins(unknown)
        if prior is None and min(len(p), len(u)) < 2:
            prior = 0.5         # no rows left to estimate it from
        if prior is None:
            half, other = np.arange(len(p)) % 2 == 0, np.arange(len(u)) % 2 == 0
            first = self._fit(p[half], u[other], 0.5, flat=True)
            prior = _prior(self._sum(first, p[~half]), self._sum(first, u[~other]))
        self.prior = float(np.clip(prior, 0.02, 0.98))
        self.weights = self._fit(p, u, self.prior)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._sum(self.weights, self._bins(x)), -30, 30)))

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], axis=1) + self.places[:-1]

    def _sum(self, weights: np.ndarray, bins: np.ndarray) -> np.ndarray:
        return weights[bins].sum(axis=1) + weights[-1]

    def _fit(self, p: np.ndarray, u: np.ndarray, prior: float, flat: bool = False) -> np.ndarray:
        """Weights by Adam on the whole sample; ``flat``: plain trusted against unknown."""
        size = int(self.places[-1]) + 1
        w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)

        def pull(bins, slope):      # gradient of the mean of a loss whose slope by row is given
            g = np.zeros(size)
            for j in range(bins.shape[1]):
                g += np.bincount(bins[:, j], weights=slope, minlength=size)
            g[-1] = slope.sum()
            return g / len(bins)

        for step in range(1, STEPS + 1):
            at_p, at_u = (1 / (1 + np.exp(-np.clip(self._sum(w, b), -30, 30))) for b in (p, u))
            if flat:
                grad = 0.5 * pull(p, at_p - 1) + 0.5 * pull(u, at_u)
            else:
                below = -np.log(1 - at_u + 1e-12).mean() + prior * np.log(1 - at_p + 1e-12).mean()
                bad = pull(u, at_u) - prior * pull(p, at_p)
                grad = prior * pull(p, at_p - 1) + bad if below >= 0 else -bad
            grad += 1e-4 * w
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
            w -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
        return w


def _prior(trusted: np.ndarray, unknown: np.ndarray) -> float:
    """Least ratio of shares above a threshold, unknown to trusted, thresholds with too few rows paying a margin."""
    at = np.unique(np.quantile(trusted, np.linspace(0, 0.95, 96)))
    above = lambda x: 1 - np.searchsorted(np.sort(x), at, "left") / len(x)
    p, u = np.maximum(above(trusted), 1e-9), above(unknown)
    slack = np.sqrt(np.log(4 / 0.1) / 2 / len(trusted)) + np.sqrt(np.log(4 / 0.1) / 2 / len(unknown))
    best = int(np.argmin((u + slack) / p))
    return min(1.0, u[best] / p[best])


def held_out(id_col: Column) -> Column:
    """Rows kept out of all learning: crc32 of the id as text, mod 5, is 0 (false for a null id)."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 5 == 0, F.lit(False))


def _below(share: float) -> Column:
    """Whether the id's hash falls into that share of all 64-bit hashes."""
    return F.xxhash64("doc_id") <= F.lit(min(2 ** 63 - 1, int(share * 2 ** 64) - 2 ** 63))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """The model of ``labels`` (doc_id, quality), learnt from rows that are not held out.

    Trusted: texts whose label is quality 1. Unknown: texts of ``docs``, with or
    without a label, which is not looked at. About ``sample`` ids of the trusted ones at most,
    twice as many rows of the unknown; of an id's rows the one of the smallest hash. None if there is no trusted or no
    unknown text.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.where("doc_id is not null").where(~held_out(F.col("doc_id")))
    good = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null")
    good = good.where(~held_out(F.col("doc_id"))).distinct()
    n_good, n_all = good.count(), texts.count()
    trusted = good.where(_below(sample / max(1, n_good))).withColumn("trusted", F.lit(True))
    unknown = _below(2 * sample / max(1, n_all))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([*batch.columns[:4], pa.array([features(t.as_py()) for t in batch.column(4)],
                                                                pa.list_(pa.float64()))], names=["doc_id", "trusted", "unknown", "order", "x"])

    rows = (texts.join(F.broadcast(trusted), "doc_id", "left").withColumn("unknown", unknown)
            .where(F.col("trusted") | F.col("unknown"))
            .select("doc_id", F.coalesce("trusted", F.lit(False)).alias("trusted"), "unknown", F.xxhash64("text").alias("order"), "text")
            .mapInArrow(describe, "doc_id long, trusted boolean, unknown boolean, order long, x array<double>")
            .groupBy("doc_id").agg(F.first("trusted").alias("trusted"), F.first("unknown").alias("unknown"), F.min_by("x", F.struct("order", "x")).alias("x")).collect())
    rows.sort(key=lambda r: r.doc_id)
    sets = [np.array([r.x for r in rows if r[kind]], float) for kind in ("trusted", "unknown")]
    return Model(*sets) if all(map(len, sets)) else None


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted), one row per row of ``docs`` (doc_id, text).

    ``score``: estimated probability of good quality, from the text alone; a null
    or empty text has the score of the empty text, a very long one is described
    whole. ``predicted``: 1 if score >= threshold. Label rows with a null id or
    without a document teach nothing; repeated label rows count once. Without a
    trusted text every score is 0.5, with a single one the prior is; an empty table
    has no rows. Null and repeated
    ids keep their rows; other columns are not read.
    """
    model = fit(docs, labels, sample)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(_scores(model, batch.column(2)))],
                                  names=["doc_id", "held_out", "score"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                        F.col("text").cast("string").alias("text"))
            .mapInArrow(score, "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more; all columns kept. See :func:`score_documents`."""
    model = fit(docs, labels, sample)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).cast(pa.string())
            yield batch.filter(pa.array(_scores(model, texts) >= threshold))

    return docs.mapInArrow(keep, docs.schema)


def _scores(model: Model | None, texts: pa.Array) -> np.ndarray:
    if model is None or not len(texts):
        return np.full(len(texts), 0.5)
    return model.scores(np.array([features(t.as_py()) for t in texts], float))
