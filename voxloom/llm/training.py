"""Which labelled rows a classifier learns from, its fit in a task, and its scores as a DataFrame.

The bounded sample of texts is fitted in one task; the driver sees ids and lengths of the rows that
may be taken (at most ``rows_per_class`` of each class) and the fitted numbers, no text.

Rows are split by ``crc32(doc_id as text) mod 5``: remainder 0 is held out, the rest may be learnt
from. A null ``doc_id`` counts as the empty text, hence as held out.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.session import ship_package

FOLDS = 5


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % FOLDS == 0


def sample_rows(docs: DataFrame, labels: DataFrame, label: str, rows_per_class: int, max_chars: int) -> DataFrame | None:
    """rank, doc_id, y, text of the rows to learn from; ``rank`` and ``doc_id`` order them.

    Of each class the ``rows_per_class`` rows with the smallest hash of ``doc_id`` are taken. A text
    that no longer fits into ``max_chars`` is passed over, not cut, and those behind it still count:
    a bounded sample, whatever the size of the tables or of a single text. Labels that are null or
    not 0/1, and rows that are held out, are left out. Of repeated rows of a ``doc_id`` the smallest
    text counts; null texts are empty. None if there is no such row.
    """
    rank = F.xxhash64("doc_id")
    known = labels.filter(F.col(label).isin(0, 1)).filter(~held_out()).groupBy("doc_id").agg(
        F.min(label).alias("_y"))
    sizes = docs.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).alias("_n")).join(known, "doc_id")
    chosen, chars = [], 0
    for y in (0, 1):
        rows = (sizes.filter(F.col("_y") == y).groupBy("doc_id", "_y").agg(F.max("_n").alias("_n"))
                .orderBy(rank, "doc_id").limit(rows_per_class).collect())
        budget = max_chars // 2
        for r in rows:
            if r["_n"] <= budget:
                budget -= r["_n"]
                chosen.append((r["doc_id"], y))
    if not chosen:
        return None
    wanted = docs.sparkSession.createDataFrame(chosen, "doc_id long, _y int")
    # Two sides of at most 2 x rows_per_class rows: the chosen ids are proven small.
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(wanted), "doc_id").groupBy("doc_id", "_y").agg(F.min("text").alias("text"))
            .select(rank.alias("rank"), "doc_id", F.col("_y").alias("y"), "text"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows_per_class: int,
                    max_chars: int) -> tuple[list[str], list[int]]:
    """Texts and 0/1 labels of ``sample_rows`` in their order, for small samples and tests."""
    sample = sample_rows(docs, labels, label, rows_per_class, max_chars)
    rows = sample.orderBy("rank", "doc_id").collect() if sample is not None else []
    return [r["text"] for r in rows], [r["y"] for r in rows]


def fitted(sample: DataFrame | None, fit: Callable) -> tuple[np.ndarray, float]:
    """``fit`` (texts as an Arrow array, labels) -> (numbers, intercept), in the one task that holds the sample."""
    if sample is None:
        return fit(pa.array([], pa.string()), [])
    ship_package(sample.sparkSession)

    def run(batches):
        whole = pa.Table.from_batches(list(batches), pa.schema([("y", pa.int32()), ("text", pa.string())])).combine_chunks()
        labels, texts = whole.column("y").to_pylist(), whole.column("text").combine_chunks()
        del whole
        numbers, intercept = fit(texts, labels)
        pa.default_memory_pool().release_unused()
        yield pa.RecordBatch.from_arrays(
            [pa.array([numbers.astype(np.float32).tobytes()], pa.binary()), pa.array([float(intercept)])], ["numbers", "intercept"])

    # All rows of the bounded sample go to one task, in the order that they are learnt in.
    row = (sample.repartition(1).sortWithinPartitions("rank", "doc_id").select("y", "text")
           .mapInArrow(run, "numbers binary, intercept double").first())
    return np.frombuffer(bytes(row["numbers"]), np.float32), row["intercept"]


def score_documents(docs: DataFrame, scorer: Callable, threshold: float) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, scored from its whole text.

    ``scorer`` maps Arrow batches (doc_id, text) to batches (doc_id, score).
    """
    ship_package(docs.sparkSession)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        scorer, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
