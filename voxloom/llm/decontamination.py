"""Benchmark decontamination by latent semantic retrieval.

Texts are terms (runs of ASCII letters, digits and non-ASCII characters, lower-cased). Documents and
benchmark items are cut into passages of ``PASSAGE`` terms, half overlapping.

1. One pass over all documents counts in how many half passages each benchmark term stands: the
   inverse document frequencies. Terms in ``COMMON`` or more of them have no weight, but the rarer
   half of each benchmark passage always has: an item that leaked into a third of all documents
   makes its own terms common and is found all the same.
2. A distributed randomised SVD of the TF-IDF matrix of ``RANK`` benchmark passages each: tasks multiply
   their rows with a random matrix, the basis comes from the sum of the Gram matrices, the terms'
   latent vectors from sums per term. Only matrices of ``RANK + OVERSAMPLE`` columns and the term
   vectors meet on the driver.
3. A second pass projects every passage of every document (sums of its terms' vectors) and takes as
   candidates the benchmark passages with a cosine of ``COSINE`` or more and ``MASS`` of the weight.
4. Each candidate is verified on the text around the passage, by the longest common subsequence of
   terms with the whole item and with its passage, of which the larger share counts: ``SHARE`` or
   more is a leak. With the item's answer (its last ``ANSWER`` terms) standing there word for word,
   ``SHARE_WITH_ANSWER`` is enough: a paraphrase.

Scale: two passes, nothing of a document is shuffled, the results are the leaks alone. What is
broadcast is bounded: items are taken in blocks of at most ``BLOCK_TERMS`` terms, larger benchmarks
take more blocks. The passages of a block go to indexes of at most ``RANK`` passages, each with its
own SVD, which loses nothing to it; the indexes of a block share its passes over the documents.

Null texts are empty; items without terms leak nowhere. Repeated rows are judged alike, of repeated
items each counts; null ids are carried along; ties keep the smaller position. Very long texts are read
whole; ``find`` reads no further columns, ``keep_clean`` keeps them under any name. Empty tables give
no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm import words
from voxloom.llm.pii import TERM_BYTES
from voxloom.session import ship_package

PASSAGE = 64
RANK, OVERSAMPLE = 256, 16
COMMON = 0.05
#: Least cosine of a candidate, and least share of the item's weight that it must hold.
COSINE, MASS = 0.5, 0.3
SHARE, SHARE_WITH_ANSWER = 0.6, 0.45
ANSWER = 8
BLOCK_TERMS = 40_000

_HALF = PASSAGE // 2
_SLOTS = 1 << 20
_SLICE = 1 << 18
RESULT = "doc_id long, item_id long, share double, answer boolean, at long"


class Vocabulary:
    """Terms of a block of items, found in texts through a table of slots."""

    def __init__(self, hashes: np.ndarray):
        self.terms = np.unique(hashes)
        self.slots = np.zeros(_SLOTS, dtype=bool)
        self.slots[self._slot(self.terms)] = True

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h & np.uint64(_SLOTS - 1)).astype(np.int64)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions of known terms, their numbers)."""
        at = np.flatnonzero(self.slots[self._slot(h)])
        number = np.minimum(np.searchsorted(self.terms, h[at]), len(self.terms) - 1)
        known = self.terms[number] == h[at]
        return at[known], number[known]


def _halves(texts: words.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(half passage of each word, first half passage of each row and their number)."""
    counts = np.diff(texts.doc_first)
    first = np.concatenate(([0], np.cumsum(-(-counts // _HALF))))
    row = np.repeat(np.arange(len(counts)), counts)
    return first[row] + (np.arange(len(row)) - texts.doc_first[row]) // _HALF, first


def item_terms(benchmark: DataFrame) -> list[tuple[int, np.ndarray]]:
    """(item_id, term hashes) of each item, in a fixed order."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).orderBy(
        "item_id", "text").toLocalIterator()
    out = []
    for r in rows:
        [texts] = words.slices(pa.array([r["text"]]), 1 << 40, TERM_BYTES)
        if len(texts.starts):
            out.append((r["item_id"], texts.hashes()))
    return out


def item_blocks(items: list[tuple[int, np.ndarray]], most: int = BLOCK_TERMS) -> list[list[tuple[int, np.ndarray]]]:
    """Consecutive items of at most ``most`` terms together (a longer item stands alone)."""
    blocks, size = [], most + 1
    for item in items:
        if size + len(item[1]) > most:
            blocks, size = [*blocks, []], 0
        blocks[-1].append(item)
        size += len(item[1])
    return blocks


def _document_frequencies(docs: DataFrame, vocabulary: Vocabulary) -> tuple[np.ndarray, int]:
    """(half passages that hold each term, number of half passages), over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = shared.value
        counts, total = np.zeros(len(known.terms), np.int64), 0
        for batch in batches:
            for texts in words.slices(words.plain_column(batch, "text"), table=TERM_BYTES):
                half, first = _halves(texts)
                at, number = known.find(texts.hashes())
                seen = np.unique(half[at] * len(known.terms) + number)
                counts += np.bincount(seen % len(known.terms), minlength=len(counts))
                total += int(first[-1])
        term = np.append(np.flatnonzero(counts), -1)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(np.append(counts[term[:-1]], total))], ["term", "n"])

    out, total = np.ones(len(vocabulary.terms), np.int64), 1
    for r in docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        if r["term"] < 0:
            total = r["n"]
        else:
            out[r["term"]] = max(r["n"], 1)
    return out, max(total, 1)


def _summed(df: DataFrame, key: str, value: str, width: int) -> DataFrame:
    """Sum of the vectors of each key."""
    def run(table: pa.Table) -> pa.Table:
        keys, at = np.unique(table.column(key).to_numpy(), return_inverse=True)
        rows = table.column(value).combine_chunks().flatten().to_numpy().reshape(-1, width)
        sums = np.zeros((len(keys), width))
        np.add.at(sums, at, rows)
        return pa.table({key: keys, value: _vectors(sums)})

    return df.groupBy((F.col(key) % 64).alias("bucket")).applyInArrow(run, f"{key} long, {value} array<double>")


def _vectors(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1]
    return pa.ListArray.from_arrays(np.arange(0, (len(rows) + 1) * width, width, dtype=np.int32)[: len(rows) + 1],
                                    pa.array(np.ascontiguousarray(rows, dtype=np.float64).ravel()))


def term_vectors(spark: SparkSession, passages: list[tuple[np.ndarray, np.ndarray]], terms: int, rank: int = RANK,
                 oversample: int = OVERSAMPLE, seed: int = 0) -> np.ndarray:
    """Latent vectors of the terms: right singular vectors of the sparse rows (numbers, weights)."""
    width = min(rank + oversample, len(passages))
    rows = spark.createDataFrame([(i, [int(x) for x in n], [float(x) for x in w]) for i, (n, w) in enumerate(passages)],
                                 "passage long, terms array<int>, weights array<double>")
    rows = rows.repartition(max(1, min(len(passages) // 500, 64)), "passage")

    def read(batch):
        for terms_, weights in zip(batch.column(1), batch.column(2), strict=True):
            yield np.array(terms_.as_py(), np.int64), np.array(weights.as_py())

    def sketch(batch, random):
        return np.array([w @ random[t] for t, w in read(batch)]).reshape(-1, random.shape[1])

    def gaussian():
        return np.random.default_rng(seed).normal(size=(terms, width))

    def gram(batches):
        random, total = gaussian(), np.zeros((width, width))
        for batch in batches:
            y = sketch(batch, random)
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), _vectors(total)], ["term", "vector"])

    def matrix(df: DataFrame) -> np.ndarray:
        out = np.zeros((width, width))
        for r in df.collect():
            out[r["term"]] = r["vector"]
        return out

    schema = "term long, vector array<double>"
    values, vectors = np.linalg.eigh(matrix(_summed(rows.mapInArrow(gram, schema), "term", "vector", width)))
    # Q = Y basis has orthonormal columns; directions without weight are dropped.
    basis = np.where(values > values[-1] * 1e-10, vectors / np.sqrt(np.maximum(values, 1e-300)), 0.0)

    def projected(batches):
        random, sums = gaussian(), {}
        for batch in batches:
            for q, (t, w) in zip(sketch(batch, random) @ basis, read(batch), strict=True):
                for term, weight in zip(t.tolist(), w.tolist(), strict=True):
                    sums[term] = sums.get(term, 0) + weight * q
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), _vectors(np.array(list(sums.values())).reshape(-1, width))],
                                         ["term", "vector"])

    small = np.zeros((terms, width))  # B transposed, a row per term of the block
    for r in _summed(rows.mapInArrow(projected, schema), "term", "vector", width).toLocalIterator():
        small[r["term"]] = r["vector"]
    values, vectors = np.linalg.eigh(small.T @ small)
    keep = np.flatnonzero(values > values[-1] * 1e-10)[-rank:]
    return (small @ vectors[:, keep] / np.sqrt(values[keep])).astype(np.float32)


def _weighted(frequency: np.ndarray, total: int, passages: list[np.ndarray]) -> np.ndarray:
    """Which terms have a weight: those that are not common, and the rarer half of every passage."""
    out = frequency < COMMON * total
    for number in passages:
        least = -(-len(number) // 2)
        if out[number].sum() < least:
            out[number[np.argsort(frequency[number], kind="stable")[:least]]] = True
    return out


class Latent:
    """Latent index of at most ``RANK`` passages (term numbers, weights), the first of them number ``first``."""

    def __init__(self, spark: SparkSession, passages: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray, mass: np.ndarray, first: int):
        self.first, self.mass = first, mass
        self.terms = np.unique(np.concatenate([n for n, _ in passages]))
        own = [(np.searchsorted(self.terms, n), w) for n, w in passages]
        latent = term_vectors(spark, own, len(self.terms))
        rows = np.array([w @ latent[n] for n, w in own], dtype=np.float32)
        self.index = rows / np.maximum(np.sqrt((rows * rows).sum(1, keepdims=True)), 1e-12)
        self.latent = latent * idf[self.terms, None].astype(np.float32)

    def near(self, held: np.ndarray, number: np.ndarray, row_of):
        """(row, half passage, passage) of each document passage near one of these; ``held`` are the half
        passages, ascending, that hold the terms ``number``."""
        place = np.minimum(np.searchsorted(self.terms, number), len(self.terms) - 1)
        known = self.terms[place] == number
        held, place = held[known], place[known]
        if not len(held):
            return
        new = np.flatnonzero(np.diff(held, prepend=-1))
        sums = np.add.reduceat(self.latent[place], new, axis=0)
        own = held[new]
        row = row_of(own)
        # A passage is a half with the next one of its row, if that holds anything.
        after = np.zeros(len(own), dtype=bool)
        after[:-1] = (own[1:] == own[:-1] + 1) & (row[1:] == row[:-1])
        joined = sums.copy()
        joined[after] += sums[1:][after[:-1]]
        for vectors in (joined, sums):
            norm = np.sqrt((vectors * vectors).sum(1, keepdims=True))
            near = vectors @ self.index.T >= np.maximum(COSINE * norm, self.mass)
            for p, i in zip(*np.nonzero(near), strict=True):
                yield int(row[p]), int(own[p]), self.first + int(i)


class Retriever:
    """Latent indexes and verification of a block of items; the only thing sent to the tasks."""

    def __init__(self, docs: DataFrame, items: list[tuple[int, np.ndarray]]):
        self.items = items
        self.vocabulary = Vocabulary(np.concatenate([h for _, h in items]))
        frequency, total = _document_frequencies(docs, self.vocabulary)
        terms = [(i, a, np.unique(self.vocabulary.find(h[a: a + PASSAGE])[1]))
                 for i, (_, h) in enumerate(items) for a in range(0, max(len(h) - _HALF, 1), _HALF)]
        idf = np.where(_weighted(frequency, total, [number for _, _, number in terms]), np.log(1 + total / frequency), 0.0)
        self.owner, passages, norms = [], [], []
        for i, a, number in terms:
            weight = idf[number]
            norm = np.sqrt((weight * weight).sum())
            passages.append((number, weight / norm))
            self.owner.append((i, a))
            norms.append(norm)
        self.weighted = idf > 0
        mass = MASS * np.array(norms, dtype=np.float32)
        # As many directions as passages: an index of more of them than RANK would lose leaks.
        self.indexes = [Latent(docs.sparkSession, passages[a: a + RANK], idf, mass[a: a + RANK], a)
                        for a in range(0, len(passages), RANK)]
        self.masks = [_masks(h) for _, h in items]

    def candidates(self, texts: words.Texts, h: np.ndarray):
        """(row, first word in the row, item, first term of its passage) of each passage near an item's."""
        half, first = _halves(texts)
        at, number = self.vocabulary.find(h)
        heavy = self.weighted[number]
        at, number = at[heavy], number[heavy]
        if not len(at):
            return
        # A term counts once per half passage, or a word repeated all over would drown an item.
        keys = np.unique(half[at] * len(self.weighted) + number)
        held, number = keys // len(self.weighted), keys % len(self.weighted)
        for index in self.indexes:
            for row, own, passage in index.near(held, number, lambda x: np.searchsorted(first, x, side="right") - 1):
                yield row, int((own - first[row]) * _HALF), *self.owner[passage]

    def leaks(self, texts: words.Texts):
        """{(row, item): (share, answer, position)} of the slice."""
        h = texts.hashes()
        found: dict[tuple[int, int], tuple[float, bool, int]] = {}
        tried = set()

        def compare(row: int, first: int, masks: dict[int, int], terms: np.ndarray) -> tuple[float, bool, int]:
            """Share of the terms that the text around the passage holds, whether their end stands there, -position."""
            n = len(terms)
            a = int(texts.doc_first[row]) + max(first - n, 0)
            b = min(int(texts.doc_first[row]) + first + PASSAGE + n, int(texts.doc_first[row + 1]))
            common, answer = _compare(masks, h[a:b].tolist(), terms)
            return common / n, answer, -(a - int(texts.doc_first[row]))

        whole: dict[tuple[int, int, int], tuple[float, bool, int]] = {}
        for row, first, item, begin in self.candidates(texts, h):
            if (row, first, item, begin) in tried:
                continue
            tried.add((row, first, item, begin))
            terms = self.items[item][1]
            if (row, first, item) not in whole:
                whole[row, first, item] = compare(row, first, self.masks[item], terms)
            results = [whole[row, first, item]]
            if len(terms) > PASSAGE:
                part = terms[begin: begin + PASSAGE]
                share, _, at = compare(row, first, _masks(part), part)
                results.append((share, results[0][1], at))
            best = max(results)
            if best[0] >= SHARE or best[1] and best[0] >= SHARE_WITH_ANSWER:
                found[row, item] = max(found.get((row, item), best), best)
        return {k: (s, answer, -at) for k, (s, answer, at) in found.items()}


def _masks(terms: np.ndarray) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, t in enumerate(terms.tolist()):
        masks[t] = masks.get(t, 0) | 1 << i
    return masks


def _compare(masks: dict[int, int], text: list[int], terms: np.ndarray) -> tuple[int, bool]:
    """(length of the longest common subsequence, whether the answer stands in ``text``)."""
    n = len(terms)
    every = (1 << n) - 1
    state = every  # a zero bit for each step of the subsequence (bit-parallel)
    for t in text:
        hit = state & masks.get(t, 0)
        state = (state + hit | state - hit) & every
    answer = terms[-ANSWER:].tolist()
    first = [i for i, t in enumerate(text) if t == answer[0]]
    return n - state.bit_count(), any(text[i: i + len(answer)] == answer for i in first)


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, share, answer, at (first term looked at) of every leak, from whole texts."""
    spark = docs.sparkSession
    ship_package(spark)
    found = spark.createDataFrame([], RESULT)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for block in item_blocks(item_terms(benchmark)):
        found = found.union(rows.mapInArrow(_finder(spark, Retriever(rows, block)), RESULT))
    return found


def _finder(spark: SparkSession, retriever: Retriever):
    shared = spark.sparkContext.broadcast(retriever)

    def run(batches):
        for batch in batches:
            ids = words.plain_column(batch, "doc_id")
            for texts in words.slices(words.plain_column(batch, "text"), _SLICE, TERM_BYTES):
                leaks = shared.value.leaks(texts)
                rows = pa.array([texts.rows.start + row for row, _ in leaks], pa.int64())
                items = pa.array([shared.value.items[item][0] for _, item in leaks], pa.int64())
                values = list(zip(*leaks.values(), strict=True)) or [[], [], []]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(rows), items, pa.array(values[0], pa.float64()), pa.array(values[1], pa.bool_()),
                     pa.array(values[2], pa.int64())], ["doc_id", "item_id", "share", "answer", "at"])

    return run


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no leak; no shuffle."""
    spark = docs.sparkSession
    ship_package(spark)
    kept = docs
    for block in item_blocks(item_terms(benchmark)):
        # Fitted on all documents: a block does not depend on what the blocks before it took out.
        shared = spark.sparkContext.broadcast(Retriever(docs, block))

        def run(batches, shared=shared):
            for batch in batches:
                clean = np.ones(len(batch), dtype=bool)
                for texts in words.slices(words.plain_column(batch, "text"), _SLICE, TERM_BYTES):
                    clean[[texts.rows.start + row for row, _ in shared.value.leaks(texts)]] = False
                yield batch.filter(pa.array(clean))

        kept = kept.mapInArrow(run, docs.schema)
    return kept
