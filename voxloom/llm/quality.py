"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Features of a text are hashed counts of its words, word pairs, word shapes and shape pairs (a shape
keeps the kind of the first and of the last two bytes, so that shouting or table rows share
features; a word that repeats the one before makes a pair of its own). Counts enter as square
roots, scaled to unit length. Weights are learnt with per-coordinate FTRL-proximal steps over a
bounded labelled sample in numpy; L1 keeps them sparse. Every whole text is then scored as a sparse
dot product in Arrow batches; the weights are ``2^BITS`` floats, the only thing broadcast.

Null and empty texts get the score of the intercept alone; ties, repeated rows and further columns
of any name have no effect; very long texts are scored whole, alone in their slice; an empty table gives no rows; without labels of both classes every score is 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from voxloom.llm import training, words
from voxloom.session import ship_package

BITS = 18
ROWS_PER_CLASS = 4000
MAX_CHARS = 60_000_000
THRESHOLD = 0.3
EPOCHS = 3
#: Step size, smoothing, L1 and L2 of the learner.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.1

_U = np.uint64
_K = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]

_KIND = np.arange(256, dtype=np.uint64)  # punctuation stands for itself
_KIND[ord("a"): ord("z") + 1] = ord("a")
_KIND[ord("A"): ord("Z") + 1] = ord("A")
_KIND[ord("0"): ord("9") + 1] = ord("0")
_KIND[128:] = 128


def _pairs(h: np.ndarray, first: np.ndarray, seed: np.uint64) -> np.ndarray:
    """Hash of each element with the one before it; the first of a text is paired with nothing."""
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[first] = 0
    return words.mix(np.where(before == h, seed, before * _K[0] + h) + seed)


def features(texts: words.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value), sorted by row; the values of a row have unit length."""
    rows = len(texts.offsets) - 1
    h = texts.hashes()
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    row = np.repeat(np.arange(rows), np.diff(texts.doc_first))
    first = texts.doc_first[:-1][np.diff(texts.doc_first) > 0]
    last = texts.ends - 1
    kind = _KIND[texts.data]
    shape = words.mix((kind[texts.starts] * _U(257) + kind[np.maximum(last - 1, texts.starts)]) * _U(257)
                      + kind[last] + _K[1])
    hashed = np.concatenate([h, _pairs(h, first, _K[1]), shape, _pairs(shape, first, _K[2])])
    keys = np.tile(row, 4) << BITS | (hashed >> _U(64 - BITS)).astype(np.int64)
    keys, counts = np.unique(keys, return_counts=True)
    row, value = keys >> BITS, np.sqrt(counts)
    norm = np.sqrt(np.bincount(row, counts, rows))
    return row, keys & ((1 << BITS) - 1), value / norm[row]


def fit(texts: pa.Array | list[str], labels: list[int]) -> tuple[np.ndarray, float]:
    """(weights, intercept)."""
    examples = []
    for part in words.slices(pa.array(texts, pa.string()) if isinstance(texts, list) else texts):
        row, feature, value = features(part)
        feature, value = feature.astype(np.int32), value.astype(np.float32)
        at = np.searchsorted(row, np.arange(len(part.offsets)))
        examples += [(feature[a:b], value[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    z0 = n0 = 0.0
    if len(set(labels)) < 2:
        return z, 0.0

    def weights(z, n):
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(EPOCHS):
        for (feature, value), y in zip(examples, labels, strict=True):
            w, w0 = weights(z[feature], n[feature]), -z0 * ALPHA / (BETA + n0 ** 0.5)
            error = 1 / (1 + np.exp(-(w @ value + w0))) - y
            step = error * value
            grown = n[feature] + step * step
            z[feature] += step - (np.sqrt(grown) - np.sqrt(n[feature])) / ALPHA * w
            n[feature] = grown
            z0 += error - ((n0 + error * error) ** 0.5 - n0 ** 0.5) / ALPHA * w0
            n0 += error * error
    return weights(z, n), -z0 * ALPHA / (BETA + n0 ** 0.5)


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", rows_per_class: int = ROWS_PER_CLASS,
          max_chars: int = MAX_CHARS) -> tuple[np.ndarray, float]:
    """Fit, in a task, on the bounded sample of labelled rows that are not held out."""
    return training.fitted(training.sample_rows(docs, labels, label, rows_per_class, max_chars), fit)


def score(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs`` (doc_id, text)."""
    return training.score_documents(docs, scorer(docs.sparkSession, model), threshold)


def scorer(spark, model):
    weights, intercept = model
    shared = spark.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches):
        for batch in batches:
            scores = [np.zeros(0)]
            for part in words.slices(words.plain_column(batch, "text")):
                row, feature, value = features(part)
                margin = np.bincount(row, shared.value[feature] * value, len(part.offsets) - 1) + intercept
                scores.append(1 / (1 + np.exp(-np.clip(margin, -500, 500))))
            yield pa.RecordBatch.from_arrays(
                [words.plain_column(batch, "doc_id"), pa.array(np.concatenate(scores))], ["doc_id", "score"])

    return run


def keep(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose whole text scores ``threshold`` or more; no shuffle."""
    ship_package(docs.sparkSession)
    score_batches = scorer(docs.sparkSession, model)

    def run(batches):
        for batch in batches:
            text = words.plain_column(batch, "text")
            [scored] = score_batches([pa.RecordBatch.from_arrays([text, text], ["doc_id", "text"])])
            yield batch.filter(pc.greater_equal(scored.column(1), threshold))

    return docs.mapInArrow(run, docs.schema)
