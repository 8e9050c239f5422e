"""Points within a radius of balls, by pivots, in any number of coordinates.

Points lie in the cell of their nearest pivot. By the triangle inequality, a
ball can only reach a cell if the distance of its centre to the pivot is at
most the cell's radius plus the reach; copies of the ball go to those cells
alone. A cell with many owners is cut into tasks by hash, small cells share a
task, and every task holds its owners while the balls stream past in slices, so
memory depends on neither. Where balls reach most cells anyway, tasks hold more
owners, as each task costs a copy of nearly every ball.

Distances of whole blocks are matrix products. Their rounding error is bounded,
so each comes as an interval, and only what the interval decides is taken for
decided.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ospara.functions.vectors import batch_matrix

MAX_PIVOTS = 2048
OWNERS, SLICE = 1024, 2048
#: Owners of one task where the cells exclude little.
MANY_OWNERS = 16 * OWNERS
#: Margin for distances that are computed one by one.
MARGIN = 1e-9


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two arrays of doubles, summed in their order."""
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))


def intervals(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the distances between rows of ``x`` and ``y``."""
    middle = y[0]
    x, y = x - middle, y - middle
    size = np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", y, y)[None, :]
    square = size - 2 * (x @ y.T)
    error = size * (4 * (x.shape[1] + 8) * np.finfo(float).eps)
    return np.sqrt(np.maximum(square - error, 0)), np.sqrt(np.maximum(square + error, 0))


def to_point(x: np.ndarray, point: np.ndarray) -> np.ndarray:
    gap = x - point
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


class Pivots:
    """Fixed points, at least ``apart`` from each other."""

    def __init__(self, sample: np.ndarray, apart: float):
        chosen: list[np.ndarray] = []
        for point in sample:
            if not chosen or to_point(np.array(chosen), point).min() >= apart:
                chosen.append(point)
        self.points = np.array(chosen)

    @classmethod
    def sampled(cls, points: DataFrame, total: int, apart: float) -> Pivots:
        """Pivots from the points of the smallest hashes, so denser places get more of them."""
        n = min(MAX_PIVOTS, max(1, math.isqrt(total)))
        rows = points.select("v", F.xxhash64("v").alias("h")).orderBy("h", "v").limit(n).collect()
        return cls(np.array([r["v"] for r in rows], dtype=float), apart)

    def place(self, points: DataFrame) -> DataFrame:
        """The points (id, v, w) with ``cell`` and ``gap``, the distance to its pivot."""
        pivots = self.points

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, OWNERS):
                    part = batch.slice(start, OWNERS)
                    x = batch_matrix(part.column("v"), pivots.shape[1])
                    cell = intervals(x, pivots)[1].argmin(axis=1)
                    gap = x - pivots[cell]
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(cell, pa.int32()), pa.array(np.sqrt(np.einsum("ij,ij->i", gap, gap)))],
                        names=["id", "v", "w", "cell", "gap"])

        return points.mapInArrow(assign, "id long, v array<double>, w long, cell int, gap double")


def tasks_of(rows: DataFrame, size: int, shared: bool = False) -> tuple[dict[int, tuple[int, int]], DataFrame]:
    """First task and number of tasks of each cell, and the rows with their ``task``; the pivots bound the cells.

    Tasks have about ``size`` rows; cells that fit share one if ``shared``.
    """
    counts = rows.groupBy("cell").count().collect()
    found, n, free = {}, 0, 0
    for cell, count in sorted((r["cell"], r["count"]) for r in counts):
        if shared and count <= free:
            found[cell], free = (n - 1, 1), free - count
            continue
        found[cell] = (n, -(-count // size))
        n += found[cell][1]
        free = size - count
    first = np.zeros(max(found, default=0) + 1, np.int64)
    many = np.ones(len(first), np.int64)
    for cell, (at, times) in found.items():
        first[cell], many[cell] = at, times

    @F.arrow_udf("int")
    def task(cell: pa.Array, code: pa.Array) -> pa.Array:
        c = np.asarray(cell)
        return pa.array(first[c] + np.asarray(code) % many[c], pa.int32())

    return found, rows.withColumn("task", task("cell", F.pmod(F.xxhash64("id"), F.lit(1 << 40))))


def streamed(rows: DataFrame, start: Callable[[pa.Table], object], schema: str) -> DataFrame:
    """Run one consumer per task over rows with (task, ball, id, ...), owners (ball 0) before balls (ball 1).

    ``start`` takes the owners of a task and returns an object with
    ``meet(batch)`` for a slice of balls and ``rows()`` for the named columns of
    the result. Tasks without owners give nothing.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, consumer, owners = None, None, []

        def result() -> pa.RecordBatch:
            found = consumer or start(pa.Table.from_batches(owners))
            return pa.RecordBatch.from_pydict(found.rows())

        for batch in batches:
            numbers = np.asarray(batch.column("task")).astype(np.int64) * 2 + np.asarray(batch.column("ball"))
            edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1), len(numbers)]
            for a, b in zip(edges[:-1], edges[1:]):
                if a == b:
                    continue
                number, ball = divmod(int(numbers[a]), 2)
                if number != task:
                    if owners:
                        yield result()
                    task, consumer, owners = number, None, []
                for at in range(a, b, SLICE):
                    part = batch.slice(at, min(SLICE, b - at))
                    if not ball:
                        owners.append(part)
                    elif owners:
                        consumer = consumer or start(pa.Table.from_batches(owners))
                        consumer.meet(part)
        if owners:
            yield result()

    return rows.repartition("task").sortWithinPartitions("task", "ball", "id").mapInArrow(run, schema)


def meetings(owners: DataFrame, balls: DataFrame, pivots: Pivots, eps: float) -> DataFrame:
    """Rows (task, ball, id, v, rho, weight) for ``streamed``: each owner (id, v, rho, weight, cell, gap) once, each ball in every task whose owners it may reach.

    A ball reaches an owner if their centres are at most ``eps`` and both radii apart.
    """
    reach = owners.groupBy("cell").agg(F.max("gap").alias("far"), F.max("rho").alias("rho"), F.count(F.lit(1)).alias("n")).orderBy("cell").collect()
    points = pivots.points
    cells = np.array([r["cell"] for r in reach], np.int64)
    far, radius = (np.array([r[c] for r in reach], float) for c in ("far", "rho"))

    def reached(x: np.ndarray, r: np.ndarray) -> np.ndarray:
        low, high = intervals(x, points)
        limit = (eps + radius[None, :] + r[:, None]) * (1 + MARGIN)
        near = low[:, cells] <= (far[None, :] + limit) * (1 + MARGIN)
        # An owner is no nearer to another pivot than to its own: half the difference bounds its distance.
        return near & (low[:, cells] * (1 - 1e-6) - high.min(axis=1)[:, None] * (1 + 1e-6) <= 2 * limit)

    size = OWNERS
    if reached(points, np.zeros(len(points))).mean() > 0.5:
        cores = owners.sparkSession.sparkContext.defaultParallelism
        size = min(MANY_OWNERS, max(OWNERS, sum(r["n"] for r in reach) // (2 * cores)))
    found, placed = tasks_of(owners, size, shared=True)
    tasks = [np.arange(found[c][0], found[c][0] + found[c][1], dtype=np.int32) for c in cells]

    @F.arrow_udf("array<int>")
    def visited(v: pa.Array, rho: pa.Array) -> pa.Array:
        out: list[np.ndarray] = []
        x, r = batch_matrix(v, points.shape[1]), np.asarray(rho)
        for start in range(0, len(x), OWNERS):
            near = reached(x[start : start + OWNERS], r[start : start + OWNERS])
            out += [np.unique(np.concatenate([tasks[c] for c in np.flatnonzero(row)])) if row.any() else np.empty(0, np.int32) for row in near]
        return pa.array(out, pa.list_(pa.int32()))

    copies = balls.select(F.explode(visited("v", "rho")).alias("task"), F.lit(1).alias("ball"), "id", "v", "rho", "weight")
    return placed.select("task", F.lit(0).alias("ball"), "id", "v", "rho", "weight").unionByName(copies)
