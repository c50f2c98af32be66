"""Exact top-k by inner product over a pivot-distance index.

Inner products become distances: with M the largest norm, x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0)
have |q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so the highest scores are the nearest points. Every vector
is keyed by its nearest pivot and its distance from it; the distances of a pivot are cut into
``ANNULI`` annuli of about equal counts. By the triangle inequality a vector of an annulus [lo, hi]
is no nearer to q' than max(d - hi, lo - d), with d the distance of q' from the pivot. A query visits
annuli in the order of that bound, ``ROUNDS`` at a time, and stops when the bound of the next one
exceeds the distance of its k-th best score so far. Stopping is exact: what is not visited cannot
reach that score.

Pivots are fitted on at most ``SAMPLE`` vectors; all vectors are indexed, and the cells cover them
all. Queries meet annuli in blocks: an annulus is split into groups of about ``BLOCK`` vectors, its
visitors into groups of about ``VISITORS`` queries, and a task multiplies two such groups, so a
crowded annulus (equal vectors, for instance) is spread. Broadcast are only the pivots and one row
per annulus.

Components become floor(scale * x); scores are integers. Vectors that are null or hold null, NaN or
infinite components, and rows without id, take no part. Vectors so long that the product of two
norms reaches 2^63 are an error, since a score would not fit a long. Shorter vectors count as
padded with zeros. Of rows with the same id the smallest vector counts. Ties go to the smaller id;
fewer candidates than k give fewer rows; further columns of any name are not read; an empty table
gives none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm import words
from voxloom.llm.components import written
from voxloom.session import ship_package

PIVOTS = 32
ANNULI = 8
SAMPLE = 8192
BLOCK = 4096
VISITORS = 1024
#: Annuli visited by a query up to the end of each round; a last round visits all that its bound leaves.
ROUNDS = (4, 24)
#: Scores must be below this; floating-point norms that are checked against it may be off a little.
LARGEST = 2.0**63 * (1 - 1e-9)


def vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, vec (array of long) of every row that takes part, one per id."""
    x = F.col("embedding")
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    return (rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter("vec_id is not null").filter(whole)
            .select("vec_id", F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("vec"))
            .groupBy("vec_id").agg(F.min("vec").alias("vec")))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = np.asarray(column.offsets)
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0]: offsets[-1]]
    sizes = np.diff(offsets)
    out = np.zeros((len(column), dim), dtype=np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(values)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = values
    return out


def _pivots(sample: np.ndarray, count: int, seed: int = 0) -> np.ndarray:
    """Centres of a few k-means steps from spread-out vectors of the sample."""
    random = np.random.default_rng(seed)
    chosen = [sample[random.integers(len(sample))]]
    near = ((sample - chosen[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(sample)):
        total = near.sum()
        if total == 0:
            break
        chosen.append(sample[random.choice(len(sample), p=near / total)])
        near = np.minimum(near, ((sample - chosen[-1]) ** 2).sum(1))
    centres = np.array(chosen)
    for _ in range(5):
        own = _distances(sample, centres).argmin(1)
        for p in range(len(centres)):
            if (own == p).any():
                centres[p] = sample[own == p].mean(0)
    return centres


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (centres * centres).sum(1) - 2 * x @ centres.T, 0))


def _lifted(x: np.ndarray, most: float) -> np.ndarray:
    x = x.astype(np.float64)
    return np.hstack([x, np.sqrt(np.maximum(most - (x * x).sum(1), 0))[:, None]])


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; by floating point where they are below 2^53."""
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if largest < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _best(scores: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k highest scores of each row, ties to the left; ``own`` is left out."""
    scores = np.where(own, np.iinfo(np.int64).min, scores)
    keep = min(k, scores.shape[1])
    floor = np.partition(scores, scores.shape[1] - keep, axis=1)[:, scores.shape[1] - keep]
    row, column = np.nonzero((scores >= floor[:, None]) & ~own)
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    first = np.searchsorted(row, row)
    chosen = np.arange(len(row)) - first < k
    return row[chosen], column[chosen]


def _squared_norm():
    return F.aggregate("vec", F.lit(0.0).cast("double"), lambda a, v: a + v.cast("double") * v)


def _check_scores(a: float, b: float) -> None:
    """Squared norms whose product bounds the square of every score."""
    if a * b >= LARGEST * LARGEST:
        raise ValueError(f"vectors too long: a score may reach {(a * b) ** 0.5:.3g}, beyond 64-bit integers")


class Index:
    """The cells of all vectors of ``data`` (vec_id, vec)."""

    def __init__(self, data: DataFrame, pivots: int = PIVOTS, annuli: int = ANNULI, block: int = BLOCK):
        ship_package(data.sparkSession)
        stats = data.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dim"), F.max(_squared_norm()).alias("most")).first()
        self.size, self.dim, self.most = stats["n"], stats["dim"] or 0, stats["most"] or 0.0
        _check_scores(self.most, self.most)
        if not self.size:
            return
        sample = [r["vec"] for r in data.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()]
        self.centres = _pivots(_lifted(_matrix(pa.array(sample, pa.list_(pa.int64())), self.dim), self.most), pivots)
        keyed = written(self._keyed(data), "keyed")
        cuts = keyed.groupBy("pivot").agg(F.percentile_approx(
            "distance", [i / annuli for i in range(1, annuli)], 1000).alias("cuts")).collect()
        edges = F.create_map(*[F.lit(x) for r in cuts for x in (r["pivot"], F.array(*map(F.lit, r["cuts"])))])[F.col("pivot")]
        ring = F.size(F.filter(edges, lambda e: e < F.col("distance")))
        celled = keyed.withColumn("cell", F.col("pivot") * annuli + ring)
        stats = celled.groupBy("cell").agg(F.min("distance").alias("lo"), F.max("distance").alias("hi"),
                                           F.count("*").alias("n")).orderBy("cell").collect()
        self.cells = np.array([r["cell"] for r in stats])
        self.pivot = self.cells // annuli
        self.lo, self.hi = np.array([r["lo"] for r in stats]), np.array([r["hi"] for r in stats])
        self.parts = {r["cell"]: -(-r["n"] // block) for r in stats}
        self.data = celled.select("cell", F.pmod(F.xxhash64("vec_id"), self._lookup(self.parts)).cast("int").alias("part"),
                                  "vec_id", "vec")

    @staticmethod
    def _lookup(values: dict[int, int]):
        return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("cell")]

    def _keyed(self, data: DataFrame) -> DataFrame:
        centres, most, dim = self.centres, self.most, self.dim

        def run(batches):
            for batch in batches:
                far = _distances(_lifted(_matrix(words.plain_column(batch, "vec"), dim), most), centres)
                own = far.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.astype(np.int32)), pa.array(far[np.arange(len(own)), own]), *batch.columns],
                    ["pivot", "distance", "vec_id", "vec"])

        return data.mapInArrow(run, "pivot int, distance double, vec_id long, vec array<long>")

    def _visits(self, queries: DataFrame, first: int, last: int) -> DataFrame:
        """cell, query_id, vec: the annuli from rank ``first`` to ``last`` that can hold a result."""
        centres, most, dim, cells, pivot, lo, hi = (
            self.centres, self.most, self.dim, self.cells, self.pivot, self.lo, self.hi)

        def run(batches):
            for batch in batches:
                vec = words.plain_column(batch, "vec")
                x = _matrix(vec, dim).astype(np.float64)
                norm = (x * x).sum(1)
                d = _distances(np.hstack([x, np.zeros((len(x), 1))]), centres)[:, pivot]
                bound = np.maximum(np.maximum(d - hi, lo - d), 0)
                order = np.argsort(bound, axis=1, kind="stable")[:, first:last]
                worst = words.plain_column(batch, "worst").fill_null(-(1 << 62)).to_numpy().astype(np.float64)
                reach = np.sqrt(np.maximum(norm + most - 2 * worst, 0))
                slack = 1e-6 * (1 + np.sqrt(norm + most))  # rounding never prunes
                row, rank = np.nonzero(np.take_along_axis(bound, order, 1) <= (reach + slack)[:, None])
                for at in range(0, len(row), 8192):
                    some = row[at: at + 8192]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cells[order[some, rank[at: at + 8192]]].astype(np.int32)),
                         words.plain_column(batch, "query_id").take(pa.array(some)), vec.take(pa.array(some))],
                        ["cell", "query_id", "vec"])

        return queries.select("query_id", "vec", "worst").mapInArrow(run, "cell int, query_id long, vec array<long>")

    def _matches(self, visits: DataFrame, k: int) -> DataFrame:
        """query_id, vec_id, score: the k best of each group of an annulus for each visitor."""
        dim = self.dim
        visits = written(visits, "visits")
        counts = {r["cell"]: -(-r["n"] // VISITORS) for r in visits.groupBy("cell").agg(F.count("*").alias("n")).collect()}
        if not counts:
            return visits.select("query_id", F.lit(0).cast("long").alias("vec_id"), F.lit(0).cast("long").alias("score"))
        split = self._lookup(counts)
        left = visits.select("cell", F.explode(F.sequence(F.lit(0), self._lookup(self.parts).cast("int") - 1)).alias("part"),
                             F.pmod(F.xxhash64("query_id"), split).cast("int").alias("visit"), F.lit(True).alias("asks"),
                             F.col("query_id").alias("id"), "vec")
        right = (self.data.filter(split.isNotNull())
                 .select("cell", "part", F.explode(F.sequence(F.lit(0), split.cast("int") - 1)).alias("visit"),
                         F.lit(False).alias("asks"), F.col("vec_id").alias("id"), "vec"))

        def run(table: pa.Table) -> pa.Table:
            asks = table.column("asks").to_numpy(zero_copy_only=False).astype(bool)
            ids = table.column("id").to_numpy()
            x = _matrix(table.column("vec"), dim)
            order = np.argsort(ids[~asks], kind="stable")
            data_ids, data = ids[~asks][order], x[~asks][order]
            if not len(data) or not asks.any():
                row = column = np.zeros(0, np.int64)
                scores = np.zeros((0, 0), np.int64)
            else:
                scores = _products(x[asks], data)
                row, column = _best(scores, ids[asks][:, None] == data_ids, k)
            return pa.table({"query_id": ids[asks][row], "vec_id": data_ids[column], "score": scores[row, column]})

        return left.union(right).groupBy("cell", "part", "visit").applyInArrow(
            run, "query_id long, vec_id long, score long")

    def search(self, queries: DataFrame, k: int = 5, rounds: tuple[int, ...] = ROUNDS) -> DataFrame:
        """query_id, rank, vec_id, score for ``queries`` (query_id, vec); never a query's own id."""
        none = "query_id long, rank int, vec_id long, score long"
        if not self.size:
            return queries.sparkSession.createDataFrame([], none)
        _check_scores(self.most, queries.agg(F.max(_squared_norm())).first()[0] or 0.0)
        best, first = None, 0
        ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        for last in [*(r for r in rounds if r < len(self.cells)), len(self.cells)]:
            state = queries.withColumn("worst", F.lit(None).cast("long"))
            if best is not None:
                full = best.filter(F.col("rank") == k).select("query_id", F.col("score").alias("worst"))
                state = queries.join(full, "query_id", "left")
            found = self._matches(self._visits(state, first, last), k)
            if best is not None:
                found = found.union(best.select("query_id", "vec_id", "score"))
            best = written(found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k), "best")
            first = last
        return best.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def search_every(rows: DataFrame, step: int, k: int = 5) -> DataFrame:
    """The k best of every row whose id is divisible by ``step``, against all rows."""
    data = written(vectors(rows), "vectors")
    queries = data.filter(F.col("vec_id") % step == 0).select(F.col("vec_id").alias("query_id"), "vec")
    return Index(data).search(queries, k)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, d.vec_id,
    CAST(list_sum(list_transform(list_zip(q.vec, d.vec), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM pairs QUALIFY rank <= 5
"""
