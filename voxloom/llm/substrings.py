"""Repeated passages: documents against the indexed blocks of all smaller ones.

In place of the greedy longest-match parse of relative Lempel-Ziv, which needs one suffix index of
all earlier text, blocks and windows are matched by hash. What is removed is the same: a word is in
a window that a smaller document holds exactly if it is in a common factor of that length.

A document is compared with what documents of smaller ids hold. Blocks are cut by content: each
window of ``WINDOW`` words has as its anchor the smallest hash of its ``GRAM``-word grams, and
neighbouring windows of one anchor make a block. A window has the same anchor in every document, so
it can only repeat within blocks of that anchor. Every block of every document is indexed as a
reference; none is sampled, capped or dropped.

1. Anchors of one document only cannot repeat and are done with.
2. Blocks are indexed by (anchor, hash of the block) with the smallest document that holds them. A
   block that a smaller document holds as well repeats as a whole.
3. Where a smaller document holds the anchor but not the whole block, a repeat begins or ends
   inside the block. There the windows are checked one by one against the windows of all other
   blocks of the anchor, indexed with the smallest document that holds each.

Words covered by a repeat are removed, the others are joined by one space. Each step is an
aggregation to a minimum and a join unique on one side: no step pairs documents, so a passage that
a third of all documents share costs each of them one row per block. Keys have 128 bits: the
anchor and the hash of block or window.

Null texts have no words. A null id counts as larger than any id and is never a reference.
Repeated rows of one id are no reference for each other. Further columns are not read; very long
texts are worked on whole, alone in their slice. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm import words
from voxloom.llm.components import written
from voxloom.session import ship_package

WINDOW = 50
GRAM = 8
NO_ID = (1 << 63) - 1

_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
_SLICE = 1 << 20


class Ranges:
    """Hashes of any run of words of a slice, from prefix sums modulo 2^64."""

    def __init__(self, h: np.ndarray, base: int):
        power = words.powers(_U(base), len(h) + 1)
        self.inverse = words.powers(_U(pow(base, -1, 1 << 64)), len(h) + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * power[:-1], dtype=np.uint64)))

    def of(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return words.mix((self.sums[end] - self.sums[first]) * self.inverse[first] + (end - first).astype(np.uint64))


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    length = 1
    while length < n:
        step = min(length, n - length)
        x = np.minimum(x[: len(x) - step], x[step:])
        length += step
    return x


def blocks_of(texts: words.Texts, window: int, gram: int):
    """(row, first word in the row, windows, anchor, hash) of each block of the slice."""
    h = texts.hashes()
    counts = np.maximum(np.diff(texts.doc_first) - window + 1, 0)
    none = np.zeros(0, np.int64)
    if not counts.any():
        return none, none, none, none, none
    row = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(len(row)) + np.repeat(texts.doc_first[:-1] - (np.cumsum(counts) - counts), counts)
    at = np.arange(len(h) - gram + 1)
    anchors = _sliding_min(Ranges(h, _BASES[0]).of(at, at + gram), window - gram + 1)[start]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(start)))
    whole = Ranges(h, _BASES[1]).of(start[first], start[first] + size + window - 1)
    return (row[first], start[first] - texts.doc_first[row[first]], size,
            anchors[first].view(np.int64), whole.view(np.int64))


def _take(column: pa.Array, rows: np.ndarray) -> pa.Array:
    return column.take(pa.array(rows))


def _blocks(docs: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for texts in words.slices(words.plain_column(batch, "text"), _SLICE):
                row, first, size, anchor, whole = blocks_of(texts, window, gram)
                at = row + texts.rows.start
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor), pa.array(whole), _take(words.plain_column(batch, "id"), at),
                     _take(words.plain_column(batch, "row"), at), pa.array(first.astype(np.int32)),
                     pa.array(size.astype(np.int32))], ["anchor", "block", "id", "row", "first", "size"])

    return docs.mapInArrow(run, "anchor long, block long, id long, row long, first int, size int")


def _numbers(lists: pa.Array, field: str) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of a field of a column of lists of structs."""
    lists = lists.fill_null(pa.scalar([], lists.type)) if lists.null_count else lists
    at = np.asarray(lists.offsets)
    values = lists.values.field(field).to_numpy(zero_copy_only=False)[at[0]: at[-1]]
    return np.repeat(np.arange(len(lists)), np.diff(at)), values


def _removed(batch: pa.RecordBatch, texts: words.Texts, name: str) -> np.ndarray:
    """Which words of the slice lie in the word ranges [first, end) of their row."""
    lists = words.plain_column(batch, name).slice(texts.rows.start, texts.rows.stop - texts.rows.start)
    row, first = _numbers(lists, "first")
    _, end = _numbers(lists, "end")
    depth = np.zeros(int(texts.doc_first[-1]) + 1, dtype=np.int64)
    np.add.at(depth, texts.doc_first[row] + first, 1)
    np.add.at(depth, texts.doc_first[row] + end, -1)
    return np.cumsum(depth)[:-1] > 0


def _results(texts: words.Texts, removed: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """n_words, n_removed, kept_sha256 of each row."""
    sums = np.concatenate(([0], np.cumsum(removed)))
    gone = sums[texts.doc_first]
    joined, begin = texts.joined(~removed)
    kept = begin[texts.doc_first - gone]
    raw = memoryview(joined.tobytes())
    digests = [hashlib.sha256(raw[a: max(a, b - 1)]).hexdigest() for a, b in zip(kept[:-1].tolist(), kept[1:].tolist(), strict=True)]
    return np.diff(texts.doc_first), np.diff(gone), digests


def _judged(docs: DataFrame, ranges: str, carry: list[str]) -> DataFrame:
    """n_words, n_removed, kept_sha256 after removing the word ranges; ``carry`` goes along."""
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name in carry),
                        "n_words long, n_removed long, kept_sha256 string"])
    order = [f.name for f in docs.schema if f.name in carry]

    def run(batches):
        for batch in batches:
            for texts in words.slices(words.plain_column(batch, "text"), _SLICE):
                total, gone, digests = _results(texts, _removed(batch, texts, ranges))
                rows = texts.rows.stop - texts.rows.start
                yield pa.RecordBatch.from_arrays(
                    [*(words.plain_column(batch, c).slice(texts.rows.start, rows) for c in order),
                     pa.array(total), pa.array(gone), pa.array(digests, pa.string())],
                    [*order, "n_words", "n_removed", "kept_sha256"])

    return docs.mapInArrow(run, schema)


def _windows(docs: DataFrame, window: int) -> DataFrame:
    """anchor, hash, id, row, first of each window of the pending blocks."""

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for texts in words.slices(words.plain_column(batch, "text"), _SLICE):
            lists = words.plain_column(batch, "pending").slice(texts.rows.start, texts.rows.stop - texts.rows.start)
            row, first = _numbers(lists, "first")
            _, size = _numbers(lists, "size")
            _, anchor = _numbers(lists, "anchor")
            within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            row, first, anchor = np.repeat(row, size), np.repeat(first, size) + within, np.repeat(anchor, size)
            start = texts.doc_first[row] + first
            hashed = Ranges(texts.hashes(), _BASES[1]).of(start, start + window).view(np.int64)
            at = row + texts.rows.start
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.astype(np.int64)), pa.array(hashed), _take(words.plain_column(batch, "id"), at),
                 _take(words.plain_column(batch, "row"), at), pa.array(first.astype(np.int32))],
                ["anchor", "hash", "id", "row", "first"])

    def run(batches):
        for batch in batches:
            yield from rows(batch)

    return docs.mapInArrow(run, "anchor long, hash long, id long, row long, first int")


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row of ``docs`` (doc_id, text)."""
    ship_package(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
                        F.coalesce("text", F.lit("")).alias("text")).withColumn("row", F.xxhash64("text"))
    blocks = written(_blocks(texts, window, gram), "blocks")
    # The sides that joins are unique on are written, so that a crowded key of the other side, dealt
    # out for the join alone, can be split at run time.
    shared = written(blocks.groupBy("anchor").agg(F.min("id").alias("low"), F.max("id").alias("high"))
                     .filter("low < high").select("anchor"), "shared-anchors")
    blocks = written(blocks.join(shared, "anchor", "left_semi"), "shared-blocks")
    # The greedy step: whole blocks held by a smaller document.
    index = written(blocks.groupBy("anchor", "block").agg(F.min("id").alias("least")), "block-index")
    split = written(index.groupBy("anchor").agg(F.min("least").alias("low"), F.max("least").alias("high"))
                    .filter("low < high").select("anchor", F.lit(True).alias("split")), "split-anchors")
    known = (blocks.join(index, ["anchor", "block"])
             .withColumn("whole", F.col("least") < F.col("id")))
    known = known.join(split, "anchor", "left").filter("whole or split")
    span = F.struct("first", (F.col("first") + F.col("size") + window - 1).alias("end"))
    # Sets: a row that is repeated adds nothing.
    found = known.groupBy("id", "row").agg(
        F.collect_set(F.when(F.col("whole"), span)).alias("factors"),
        F.collect_set(F.when(~F.col("whole"), F.struct("anchor", "first", "size"))).alias("pending"))
    # Without pending blocks a document is done; the others go on with their text.
    joined = texts.join(found, ["id", "row"], "left")
    waiting = F.coalesce(F.size("pending") > 0, F.lit(False))
    first_pass = _judged(joined.withColumn("rest", F.when(waiting, F.col("text"))), "factors",
                         ["id", "row", "factors", "pending", "rest"])
    first_pass = written(first_pass, "first-pass")
    open_docs = first_pass.filter("rest is not null").select("id", "row", F.col("rest").alias("text"), "factors", "pending")
    # Factor boundaries: windows of pending blocks held by a smaller document.
    checked = written(_windows(open_docs, window), "windows")
    reference = written(checked.groupBy("anchor", "hash").agg(F.min("id").alias("low"), F.max("id").alias("high"))
                        .filter("low < high").select("anchor", "hash", "low"), "window-index")
    matched = checked.join(reference, ["anchor", "hash"]).filter("low < id")
    more = matched.groupBy("id", "row").agg(F.collect_set(
        F.struct("first", (F.col("first") + window).alias("end"))).alias("found"))
    second = (open_docs.join(more, ["id", "row"], "left")
              .withColumn("all", F.concat("factors", F.coalesce("found", F.array().cast("array<struct<first:int,end:int>>")))))
    done = first_pass.filter("rest is null").select("id", "n_words", "n_removed", "kept_sha256")
    result = done.unionByName(_judged(second.select("id", "text", "all"), "all", ["id"]))
    return result.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_words", "n_removed", "kept_sha256")


SQL = f"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + {WINDOW - 1}], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {WINDOW - 2})) AS i FROM w)),
firsts AS (SELECT k, min(doc_id) AS low FROM windows GROUP BY k),
gone AS (SELECT doc_id, i FROM windows JOIN firsts USING (k) WHERE low < doc_id),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
marked AS (
  SELECT words.doc_id, word, p, coalesce(max(i) OVER (PARTITION BY words.doc_id ORDER BY p), 0) > p - {WINDOW} AND
    max(i) OVER (PARTITION BY words.doc_id ORDER BY p) IS NOT NULL AS removed
  FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.i = words.p),
kept AS (
  SELECT doc_id, count(*) FILTER (WHERE removed) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT removed) AS left_over
  FROM marked GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(left_over, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
