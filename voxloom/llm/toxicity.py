"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A text is the bag of its character n-grams (``SHORTEST`` to ``LONGEST`` bytes of the lower-cased
text, blanks mark where words begin and end, none crosses a blank), hashed into ``2^BITS`` rows of
an embedding table. The mean of the bag's rows goes through a linear softmax of two classes;
embeddings (plain steps that shrink) and softmax (Adagrad) are learnt together over a bounded
labelled sample. A misspelt word shares most n-grams with the word it stands for, so it needs no row of its own.
Because mean and softmax are linear, scoring needs one number per row, ``E (w1 - w0)``: that table
of ``2^BITS`` floats is the only thing broadcast, and every whole text is scored in Arrow batches.

Null and empty texts get the score of the softmax bias alone; ties, repeated rows and further
columns of any name have no effect; very long texts are scored whole, alone in their slice; an empty table gives no rows; without labels of both classes every score
is 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from voxloom.llm import training, words

BITS = 18
SHORTEST, LONGEST = 3, 6
DIM = 8
ROWS_PER_CLASS = 2500
MAX_CHARS = 40_000_000
THRESHOLD = 0.5
EPOCHS = 5
#: Step sizes of the embeddings (large: shares of n-grams are tiny), the softmax weights and its bias.
RATE, WEIGHT_RATE, BIAS_RATE = 3000.0, 0.1, 0.05

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_BYTE = words.mix(np.arange(1, 257, dtype=np.uint64) * _U(0xC2B2AE3D27D4EB4F))
_BLANK = 0x20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32
_LOWER[words.SPACE] = _BLANK


def grams(texts: words.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every character n-gram."""
    offsets = texts.offsets
    data = np.append(np.insert(words.lower(texts.data, _LOWER), offsets[:-1], _BLANK), np.uint8(_BLANK))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets) + 1)
    blanks = np.concatenate(([0], np.cumsum(data == _BLANK)))
    code = _BYTE[data]
    h, rows, buckets = code, [], []
    for n in range(2, LONGEST + 1):
        h = h[:-1] * _BASE + code[n - 1:]
        if n < SHORTEST or not len(h):
            continue
        count = len(h)
        at = np.flatnonzero(blanks[n - 1: n - 1 + count] == blanks[1: 1 + count])  # none inside
        rows.append(row[at])
        buckets.append((words.mix(h[at] + _U(n)) >> _U(64 - BITS)).astype(np.int64))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(buckets)


def fit(texts: pa.Array | list[str], labels: list[int], seed: int = 0) -> tuple[np.ndarray, float]:
    """(one number per bucket, bias): the margin of class 1 over class 0."""
    if len(set(labels)) < 2:
        return np.zeros(1 << BITS, np.float32), 0.0
    examples = []
    for part in words.slices(pa.array(texts, pa.string()) if isinstance(texts, list) else texts):
        row, bucket = grams(part)
        keys, counts = np.unique(row << BITS | bucket, return_counts=True)
        at = np.searchsorted(keys >> BITS, np.arange(len(part.offsets)))
        keys = (keys & ((1 << BITS) - 1)).astype(np.int32)
        examples += [(keys[a:b], (counts[a:b] / max(counts[a:b].sum(), 1)).astype(np.float32))
                     for a, b in zip(at[:-1], at[1:], strict=True)]
    random = np.random.default_rng(seed)
    table = random.normal(0, 0.01, (1 << BITS, DIM)).astype(np.float32)
    softmax = random.normal(0, 0.5, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen_softmax, seen_bias = np.full((DIM, 2), 1e-8), np.full(2, 1e-8)
    order = np.arange(len(examples))
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        random.shuffle(order)
        for i in order:
            bucket, share = examples[i]
            own = table[bucket]
            mean = share @ own
            logits = mean @ softmax + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[labels[i]] -= 1
            back, slope = softmax @ error, np.outer(mean, error)
            seen_softmax += slope * slope
            softmax -= (WEIGHT_RATE * slope / np.sqrt(seen_softmax)).astype(np.float32)
            seen_bias += error * error
            bias -= (BIAS_RATE * error / np.sqrt(seen_bias)).astype(np.float32)
            table[bucket] = own - (rate * share)[:, None] * back.astype(np.float32)
    return table @ (softmax[:, 1] - softmax[:, 0]), float(bias[1] - bias[0])


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows_per_class: int = ROWS_PER_CLASS,
          max_chars: int = MAX_CHARS) -> tuple[np.ndarray, float]:
    """Fit, in a task, on the bounded sample of labelled rows that are not held out."""
    return training.fitted(training.sample_rows(docs, labels, label, rows_per_class, max_chars), fit)


def score(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs`` (doc_id, text)."""
    return training.score_documents(docs, scorer(docs.sparkSession, model), threshold)


def scorer(spark, model):
    margins, bias = model
    shared = spark.sparkContext.broadcast(margins.astype(np.float32))

    def run(batches):
        for batch in batches:
            scores = [np.zeros(0)]
            for part in words.slices(words.plain_column(batch, "text"), 1 << 18):
                row, bucket = grams(part)
                rows = len(part.offsets) - 1
                total = np.bincount(row, shared.value[bucket], rows)
                margin = total / np.maximum(np.bincount(row, minlength=rows), 1) + bias
                scores.append(1 / (1 + np.exp(-np.clip(margin, -500, 500))))
            yield pa.RecordBatch.from_arrays(
                [words.plain_column(batch, "doc_id"), pa.array(np.concatenate(scores))], ["doc_id", "score"])

    return run
