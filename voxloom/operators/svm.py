"""Linear support vector machine with squared hinge loss, one class against the rest.

Spark ML's own linear SVM has the plain hinge; here the loss of a row is the square of what its
margin lacks, and the intercept is penalised like any weight:

    |w|^2 / 2 + C * sum over rows of max(0, 1 - y (w . x))^2,   x with a constant 1 at its end.

All classes are solved together by Newton steps; each step solves its linear system by conjugate
gradients. Losses, gradients and products with the Hessian are sums over rows: a task adds up its
rows in numpy, and the sums of tasks are added up as a tree, so the driver sees a few vectors of
classes x features per pass. Rows are packed once into blocks that fit a processor's cache and stay
on the executors, dealt to as many tasks as their entries are worth: a fit takes hundreds of passes,
and a task has a cost of its own in each. For the same reason blocks are kept as the bytes that the workers
read, not as columns that each pass would turn into Arrow batches. Only rows with a loss are in the Hessian of a class, so a step
keeps those rows apart and its products read them alone, for the classes that are still open.
"""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.session import ship_package

TOLERANCE = 1e-5    # size of the gradient, relative to the first one, that ends a fit
MAX_STEPS = 100
MAX_PRODUCTS = 60    # Hessian products of one step
FORCING = 0.1    # share of the gradient that a step may leave over
BLOCK_ENTRIES = 1 << 16    # entries of a block, unless a single row has more
TASK_ENTRIES = 1 << 23    # entries of a task in a pass, unless its blocks fell unevenly
LEAST_ENTRIES = 1 << 18    # entries that are worth a task of their own, where cores are free
TREE = 32    # sums of up to so many tasks go to the driver directly
BLOCK_SCHEMA = "sizes binary, indices binary, weights binary, labels binary"
KINDS = (np.int32, np.int32, np.float64, np.int32, np.bool_)


@dataclass
class Block:
    """Some rows: number of entries of each, then entries and labels row by row. No row is empty.

    ``active`` tells, row by row, in which of some classes a row has a loss.
    """

    sizes: np.ndarray
    indices: np.ndarray
    weights: np.ndarray
    labels: np.ndarray
    active: np.ndarray | None = None

    def times(self, w: np.ndarray) -> np.ndarray:
        """Rows x classes of products with ``w`` (features x classes)."""
        first = np.cumsum(self.sizes) - self.sizes
        return np.stack([np.add.reduceat(self.weights * x[self.indices], first) for x in np.ascontiguousarray(w.T)], axis=1)

    def transposed(self, c: np.ndarray, features: int) -> np.ndarray:
        """Features x classes: the rows, weighted by ``c`` (rows x classes), added up."""
        return np.stack([np.bincount(self.indices, self.weights * np.repeat(x, self.sizes), features) for x in np.ascontiguousarray(c.T)], axis=1)

    def signs(self, classes: np.ndarray) -> np.ndarray:
        return np.where(self.labels[:, None] == classes, 1.0, -1.0)

    def lacking(self, w: np.ndarray, classes: np.ndarray) -> Block:
        """The rows with a loss under ``w`` (features x classes) in any of ``classes``."""
        active = self.signs(classes) * self.times(w) < 1
        some = active.any(1)
        entries = np.repeat(some, self.sizes)
        return Block(self.sizes[some], self.indices[entries], self.weights[entries], self.labels[some], active[some])


def blocks(featured: DataFrame, features: str = "features", label: str = "label_id") -> DataFrame:
    """Rows of ML vectors packed into blocks, each with a constant feature at its end."""
    def run(batches):
        for batch in batches:
            vectors, labels = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False).astype(np.int32)
            if not len(labels):
                continue
            values = vectors.field("values")
            width = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(width)
            row = np.repeat(np.arange(len(width)), width)
            # A dense vector has an entry for each feature, a sparse one tells which.
            place = np.arange(len(row))
            index = place - (ends - width)[row]
            sparse = np.asarray(vectors.field("type")) == 0
            index[sparse[row]] = vectors.field("indices").flatten().to_numpy(zero_copy_only=False)
            size = np.where(sparse, vectors.field("size").fill_null(0).to_numpy(zero_copy_only=False), width)
            # Each row with its constant behind.
            sizes, last = (width + 1).astype(np.int32), ends + np.arange(len(width))
            indices, weights = np.empty(len(row) + len(width), np.int32), np.ones(len(row) + len(width))
            indices[place + row], indices[last] = index, size
            weights[place + row] = values.flatten().to_numpy(zero_copy_only=False)
            at, ends = 0, last + 1
            while at < len(sizes):
                begin = int(ends[at - 1]) if at else 0
                after = max(int(np.searchsorted(ends, begin + BLOCK_ENTRIES, "right")), at + 1)
                columns = [sizes[at:after], indices[begin: ends[after - 1]], weights[begin: ends[after - 1]], labels[at:after]]
                yield pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in columns],
                                                 [f.split()[0] for f in BLOCK_SCHEMA.split(", ")])
                at = after

    return featured.select(features, F.col(label).cast("int")).mapInArrow(run, BLOCK_SCHEMA)


def _block(row) -> Block:
    columns = [np.frombuffer(x, kind) for x, kind in zip(row, KINDS, strict=False)]
    columns[1] = columns[1].astype(np.intp)   # once, not in every product
    if len(columns) > 4:
        columns[4] = columns[4].reshape(len(columns[0]), -1)
    return Block(*columns)


def stored(rows: DataFrame) -> RDD:
    """The blocks as tuples of bytes, which a pass hands to its workers as they are."""
    return rows.rdd.mapPartitions(lambda part: (tuple(bytes(x) for x in row) for row in part))


def dealt(rows: DataFrame, entries: int) -> DataFrame:
    """The blocks in as many partitions as ``entries`` are worth a task each, never in more than before.

    Beyond the number of cores they are whole rounds of tasks. Workers read one block at a time, so a
    task's entries bound its time, not its memory; few tasks are summed without a shuffle in each pass.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-entries // TASK_ENTRIES), min(cores, -(-entries // LEAST_ENTRIES)), 1)
    tasks = -(-tasks // cores) * cores if tasks > cores else tasks
    return rows.repartition(tasks) if tasks < rows.rdd.getNumPartitions() else rows


def _extent(rows: DataFrame) -> tuple[int, int]:
    """Number of entries of all blocks and their highest label."""
    def run(batches):
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                block = _block(row)
                yield pa.RecordBatch.from_arrays([pa.array([len(block.indices)], pa.int64()), pa.array([block.labels.max()], pa.int32())],
                                                 ["entries", "label"])

    return tuple(rows.mapInArrow(run, "entries long, label int").agg(F.sum("entries"), F.max("label")).first())


def summed(rows: DataFrame | RDD, part, tree: int = TREE) -> np.ndarray:
    """The sum of ``part`` (block -> array of one shape) over all blocks; tasks are added up as a tree.

    Without any block the sum is the number 0.
    """
    def run(stored_rows):
        total = None
        for row in stored_rows:
            own = part(_block(row))
            total = own if total is None else total + own
        if total is not None:
            yield total.tobytes()

    def add(totals):
        arrays = [np.frombuffer(x) for x in totals]
        if arrays:
            yield np.sum(arrays, axis=0).tobytes()

    rows = stored(rows) if isinstance(rows, DataFrame) else rows
    totals, width = rows.mapPartitions(run), rows.getNumPartitions()
    while width > tree:
        width = -(-width // tree)
        keyed = totals.mapPartitionsWithIndex(lambda i, part, n=width: ((i % n, x) for x in part))
        totals = keyed.partitionBy(width, int).values().mapPartitions(add)
    return np.sum([np.frombuffer(x) for x in totals.collect()], axis=0)


def solve(rows: DataFrame | RDD, features: int, classes: int, c: float = 1.0, tolerance: float = TOLERANCE,
          max_steps: int = MAX_STEPS) -> np.ndarray:
    """Weights (features + 1) x classes that minimise the penalised squared hinge of ``rows`` (blocks, best kept as ``stored``)."""
    rows, width = stored(rows) if isinstance(rows, DataFrame) else rows, features + 1
    context = rows.context

    def value_and_slope(w: np.ndarray, these: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shared = context.broadcast((w, these))

        def part(block: Block) -> np.ndarray:
            at, own = shared.value
            sign = block.signs(own)
            lack = np.maximum(0, 1 - sign * block.times(at))
            return np.concatenate([(lack * lack).sum(0), block.transposed(sign * lack, width).ravel()])

        total = summed(rows, part)
        shared.destroy()
        n = len(these)
        return (w * w).sum(0) / 2 + c * total[:n], w - 2 * c * total[n:].reshape(width, n)

    def product(lacking: RDD, d: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The Hessian of the classes ``at`` (places in ``active``) times ``d``, from the rows with a loss."""
        shared = context.broadcast((d, at))

        def part(block: Block) -> np.ndarray:
            along, columns = shared.value
            return block.transposed(block.active[:, columns] * block.times(along), width).ravel()

        total = summed(lacking, part)
        shared.destroy()
        return d + 2 * c * (total.reshape(width, -1) if total.ndim else 0)

    def newton_step(w: np.ndarray, slope: np.ndarray, these: np.ndarray, enough: np.ndarray) -> np.ndarray:
        """Conjugate gradients over the rows that have a loss, until what is left is ``enough``."""
        shared = context.broadcast((w, these))

        def some(part):
            at, own = shared.value
            for row in part:
                left = _block(row).lacking(at, own)
                if len(left.sizes):
                    columns = left.sizes, left.indices, left.weights, left.labels, left.active
                    yield tuple(x.astype(kind).tobytes() for x, kind in zip(columns, KINDS, strict=True))

        lacking = rows.mapPartitions(some).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            step, rest = np.zeros_like(w), -slope
            along, squared = rest.copy(), (rest * rest).sum(0)
            for _ in range(MAX_PRODUCTS):
                at = np.flatnonzero(np.sqrt(squared) > enough)
                if not len(at):
                    break
                d, before = along[:, at], squared[at]
                image = product(lacking, d, at)
                rate = before / np.maximum((d * image).sum(0), 1e-300)
                step[:, at] += rate * d
                rest[:, at] -= rate * image
                squared[at] = (rest[:, at] ** 2).sum(0)
                along[:, at] = rest[:, at] + squared[at] / np.maximum(before, 1e-300) * d
        finally:
            lacking.unpersist()
            shared.destroy()
        return step

    w = np.zeros((width, classes))
    value, slope = value_and_slope(w, np.arange(classes))
    goal = tolerance * np.sqrt((slope * slope).sum(0))
    for _ in range(max_steps):
        size = np.sqrt((slope * slope).sum(0))
        these = np.flatnonzero(size > goal)
        if not len(these):
            break
        at, down, start = w[:, these], slope[:, these], value[these]
        step = newton_step(at, down, these, np.maximum(FORCING * size, goal / 2)[these])
        # A step that does not lower the loss enough is halved, each class by itself.
        descent, reach = (down * step).sum(0), np.ones(len(these))
        for _ in range(30):
            new_value, new_slope = value_and_slope(at + reach * step, these)
            worse = new_value > start + 1e-4 * reach * descent + 1e-12 * np.abs(start)
            if not worse.any():
                break
            reach = np.where(worse, reach / 2, reach)
        w[:, these], value[these], slope[:, these] = at + reach * step, new_value, new_slope
    return w


def fit(featured: DataFrame, features: str = "features", label: str = "label_id", c: float = 1.0) -> LogisticRegressionModel:
    """A savable linear model over ML vectors whose highest margin is the prediction.

    Spark has no model class for squared hinge; the multinomial linear one holds the same numbers and
    predicts the same class. Its ``probability`` is a softmax of margins, not a calibrated share.
    """
    ship_package(featured.sparkSession)
    packed = blocks(featured, features, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        size = featured.select(features).first()[0].size
        entries, top = _extent(packed)
        classes = max(top + 1, 2)
        rows = stored(dealt(packed, entries)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows.count()   # from here on only the stored blocks are read
            packed.unpersist()
            w = solve(rows, size, classes, c)
        finally:
            rows.unpersist()
    finally:
        packed.unpersist()
    model = LogisticRegressionModel._create_from_java_class(
        "org.apache.spark.ml.classification.LogisticRegressionModel", f"squared_hinge_{uuid4().hex[:12]}",
        DenseMatrix(classes, size, w[:-1].ravel().tolist()), Vectors.dense(w[-1]), classes, True)
    return model.setFeaturesCol(features).setPredictionCol("prediction")
