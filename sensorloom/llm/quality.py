"""Quality classifier learnt from trusted positives and unlabelled text.

The model is linear in features of the whole text and minimises the non-negative unbiased risk of
positive-unlabelled learning: with the class prior p, the loss l and the scores of positives (P)
and unlabelled texts (U),

    p * mean_P l(+) + max(0, mean_U l(-) - p * mean_P l(-)).

The prior is estimated from how the scores of a first model are spread over P and U.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sensorloom.llm.common import require, span_hashes, text_bytes, text_slices

# The model is fitted on at most so many positives and so many unlabelled texts.
SAMPLE_ROWS = 12_000
THRESHOLD = 0.3
# Scores are probabilities; the loss has this much weight decay.
DECAY, STEPS, RATE = 1e-3, 400, 0.05

_GROUPS = (
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" ",
    b"\t\r\n",
    b".",
    b",;:",
    b"!?",
    b"'\"`",
    b"()[]{}",
    b"|",
    b"<>/\\",
    b"-_=+~",
    b"#$%&*@^",
)
CLASSES = 16
CLASS_OF = np.full(256, 14, np.int64)
CLASS_OF[128:] = 15
for _number, _group in enumerate(_GROUPS):
    CLASS_OF[list(_group)] = _number
EXTRA = 4
FEATURES = CLASSES * CLASSES + EXTRA


def features(column: pa.Array) -> np.ndarray:
    """A row for each text: square roots of the shares of adjacent pairs of character classes, the
    share of words that repeat the word before, the mean word length, the share of lines that are
    short, and the logarithm of the length. An empty or null text has zeros."""
    raw, offsets = text_bytes(column)
    count, lengths = len(offsets) - 1, np.diff(offsets)
    out = np.zeros((count, FEATURES))
    if not len(raw):
        return out
    owner = np.repeat(np.arange(count), lengths)
    kind = CLASS_OF[raw]
    pair = owner[:-1] * CLASSES * CLASSES + kind[:-1] * CLASSES + kind[1:]
    pair = pair[owner[:-1] == owner[1:]]
    pairs = np.bincount(pair, minlength=count * CLASSES * CLASSES).reshape(count, -1)
    out[:, :-EXTRA] = np.sqrt(pairs / np.maximum(lengths - 1, 1)[:, None])
    inside = np.concatenate([[False], (kind != 3) & (kind != 4), [False]])
    border = np.zeros(len(raw) + 1, bool)
    border[offsets] = True  # a word ends where its text does
    edge = (inside[1:] != inside[:-1]) | (border & inside[1:] & inside[:-1])
    starts, ends = np.flatnonzero(edge & inside[1:]), np.flatnonzero(edge & inside[:-1])
    if len(starts):
        words = span_hashes(raw, starts, ends)
        of = owner[starts]
        same = (words[1:] == words[:-1]) & (of[1:] == of[:-1])
        total = np.maximum(np.bincount(of, minlength=count), 1)
        out[:, -4] = np.bincount(of[1:][same], minlength=count) / total
        out[:, -3] = np.bincount(of, ends - starts, minlength=count) / total / 10
    lines = np.bincount(owner[raw == 10], minlength=count) + 1
    out[:, -2] = np.where(lengths > 0, np.minimum(lines / np.maximum(lengths, 1) * 20, 1), 0)
    out[:, -1] = np.log1p(lengths) / 10
    return out


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -8, 8) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(both: np.ndarray, n: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the non-negative risk, with the logistic loss, from rows of which
    the first ``n`` are positives and whose last column is 1."""
    w, m, v = (np.zeros(both.shape[1]) for _ in range(3))
    w[-1] = np.log(prior / (1 - prior))
    for step in range(1, STEPS + 1):
        z = both @ w
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        soft = np.logaddexp(0, z)  # the loss of calling a row negative
        negative_risk = soft[n:].mean() - prior * soft[:n].mean()
        grad = np.zeros(len(z))
        if negative_risk >= 0:
            grad[:n] = prior * (p[:n] - 1) / n - prior * p[:n] / n
            grad[n:] = p[n:] / (len(z) - n)
        else:
            # The negative part has become less than nothing: only undo that.
            grad[:n] = prior * p[:n] / n
            grad[n:] = -p[n:] / (len(z) - n)
        g = grad @ both
        g[:-1] += DECAY * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives in U from scores: of all thresholds that keep enough of P, the one
    where U exceeds it by the smallest factor, with a margin for chance."""
    cuts = np.quantile(positive, np.linspace(0.02, 0.9, 89))
    over_p = (positive[:, None] >= cuts).mean(axis=0)
    over_u = (unlabelled[:, None] >= cuts).mean(axis=0)
    margin = np.sqrt(1 / len(positive)) + np.sqrt(1 / len(unlabelled))
    best = np.argmin((over_u + margin) / np.maximum(over_p, 1e-9))
    return float(np.clip(over_u[best] / max(over_p[best], 1e-9), 0.02, 0.98))


def fit_rows(positive: np.ndarray, unlabelled: np.ndarray) -> Model:
    """The model from feature rows. Without positives or unlabelled rows every score is 1."""
    if not len(positive) or not len(unlabelled):
        zeros = np.zeros(FEATURES)
        return Model(zeros, zeros + 1, zeros, 30.0, 1.0)
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0)
    scale = np.where(scale < 1e-4, 1.0, scale)
    # One table holds all rows; what they were made from is let go as soon as they stand in it.
    n = len(positive)
    both = np.ones((n + len(unlabelled), FEATURES + 1))
    for rows, out in ((positive, both[:n, :-1]), (unlabelled, both[n:, :-1])):
        np.subtract(rows, mean, out=out)
        np.divide(out, scale, out=out)
        np.clip(out, -8, 8, out=out)
    del positive, unlabelled, rows
    w, b = _descend(both, n, 0.5)
    p, u = (np.ascontiguousarray(rows) @ w + b for rows in (both[:n, :-1], both[n:, :-1]))
    prior = estimated_prior(p, u)
    w, b = _descend(both, n, prior)
    return Model(mean, scale, w, b, prior)


def held_out(doc_id: Column) -> Column:
    """The fold that labels are never learnt from; a null id is not in it."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(False))


def _sampled(rows: DataFrame, key: str, count: int, most: int) -> DataFrame:
    """About ``most`` rows of ``count``, chosen by a hash of the key; all where there are fewer."""
    share = min(1.0, most / max(count, 1))
    parts = 1 << 20
    return rows.filter(F.pmod(F.xxhash64(key, F.lit(7)), F.lit(parts)) < F.lit(int(share * parts)))


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "text"):
            values = pa.array(features(part.column(0)).reshape(-1), pa.float64())
            rows = pa.FixedSizeListArray.from_arrays(values, FEATURES).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([rows], names=["features"])


def _collected(texts: DataFrame, most: int) -> np.ndarray:
    """Feature rows of a sample of bounded size."""
    rows = texts.select("text").mapInArrow(_feature_rows, "features array<double>").limit(most)
    table = rows.toArrow()
    flat = table["features"].combine_chunks().flatten()
    return np.asarray(flat, dtype=np.float64).reshape(-1, FEATURES)


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from ``documents`` (doc_id, text) and ``labels`` (doc_id, quality).

    Trusted positives are documents outside the held-out fold whose labels are all 1; the
    unlabelled rows are documents drawn from all, whose labels are not looked at. At most
    ``sample_rows`` of each are used. Null labels and ids are ignored.
    """
    documents = require(documents, ["doc_id", "text"])
    trusted = (
        require(labels, ["doc_id", "quality"])
        .filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .filter("quality = 1")
        .select("doc_id")
    )
    known = trusted.count()
    chosen = _sampled(trusted, "doc_id", known, sample_rows).limit(2 * sample_rows)
    positive = documents.join(F.broadcast(chosen), "doc_id")
    unlabelled = _sampled(documents, "doc_id", documents.count(), sample_rows)
    return fit_rows(_collected(positive, sample_rows), _collected(unlabelled, sample_rows))


SCHEMA = "doc_id bigint, score double"


def score(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text; other columns are ignored): doc_id,
    held_out, score and predicted. A null text is empty and is scored as such; null ids and
    repeated rows give a row each. Nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).cast(pa.int64()),
                        pa.array(model.scores(features(part.column(1))), pa.float64()),
                    ],
                    names=["doc_id", "score"],
                )

    scored = require(documents, ["doc_id", "text"]).mapInArrow(run, SCHEMA)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def accepted(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents``, with all their columns, that are not rejected."""
    names, place = documents.columns, documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text"):
                keep = model.scores(features(part.column(place))) >= threshold
                yield part.filter(pa.array(keep))

    assert names.count("text") == 1
    return documents.mapInArrow(run, documents.schema)
