"""Nearest rows of rows with gaps, by blocks with bounds.

Distinct rows are placed at their nearest pivot, apart by the common patterns
of gaps, and cut into blocks. A block keeps the range of each column and how
many rows have it; from these follows a lower bound of the distance from any
row to any member, over whichever columns they may share. A row with gaps first
meets the blocks of the least bounds that hold ``k`` rows for each of its gaps;
their ``k``-th distances then decide which other blocks it has to meet. All
others cannot hold a nearer row.

The driver holds the pivots and the directory of blocks, one row for
``per_block`` rows of the table. Rows with gaps stream past a block, so a block
that many of them need is no larger than another.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ospara.functions.vectors import batch_matrix
from ospara.operators import nearby
from ospara.session import discard, written

MAX_PIVOTS, PATTERNS = 2048, 16
#: Rows with gaps that one task compares with one block.
VISITS_PER_TASK = 1 << 15
#: Cells of a matrix that is held at a time.
CELLS = 1 << 21
DIGITS = 9


class Directory:
    """Ranges and counts of the blocks, and the bounds that follow from them."""

    def __init__(self, low: np.ndarray, high: np.ndarray, known: np.ndarray, rows: np.ndarray):
        self.low, self.high, self.known = low, high, known
        self.always = known >= rows[:, None]

    def bounds(self, x: np.ndarray) -> np.ndarray:
        """Lower bounds of the distances from rows to members of each block; infinite if they share no column."""
        n, d = x.shape
        with np.errstate(invalid="ignore"):
            gap = np.maximum(np.maximum(self.low[None] - x[:, None], x[:, None] - self.high[None]), 0)
        gap *= gap
        there = ~np.isnan(x)[:, None] & (self.known > 0)[None]
        always = there & self.always[None]
        total, shared = np.where(always, gap, 0).sum(axis=2), always.sum(axis=2)
        # Columns that only some members have may be shared or not: the smallest gaps lower the mean most.
        maybe = np.sort(np.where(there & ~always, gap, np.inf), axis=2)
        least = np.full(total.shape, np.inf)
        np.divide(total, shared, out=least, where=shared > 0)
        for j in range(d):
            more = maybe[:, :, j]
            if not np.isfinite(more).any():
                break
            total, shared = total + more, shared + 1
            least = np.minimum(least, total / shared)
        return np.sqrt(least * d) * (1 - nearby.MARGIN)

    def first(self, x: np.ndarray, k: int) -> list[np.ndarray]:
        """Per row, the nearest blocks that together hold ``k`` rows for each of its gaps."""
        bound = self.bounds(x)
        order = np.argsort(bound, axis=1, kind="stable")
        out = []
        for row, by, b in zip(x, order, bound):
            gaps = np.flatnonzero(np.isnan(row))
            by = by[np.isfinite(b[by])]
            have = np.cumsum(self.known[by][:, gaps], axis=0) >= k
            enough = np.where(have.any(axis=0), have.argmax(axis=0), len(by)) if len(by) else np.zeros(len(gaps), int)
            chosen = by[: int(enough.max(initial=0)) + 1]
            out.append(chosen[(self.known[chosen][:, gaps] > 0).any(axis=1)].astype(np.int32))
        return out

    def others(self, x: np.ndarray, limits: np.ndarray, met: list[list[int]]) -> list[np.ndarray]:
        """Per row, the blocks not met yet that may hold a row nearer than the limit of a gap."""
        bound = self.bounds(x)
        out = []
        for row, b, limit, before in zip(x, bound, limits, met):
            gaps = np.flatnonzero(np.isnan(row))
            needed = (np.isfinite(b)[:, None] & (b[:, None] <= limit[gaps][None] + 10.0**-DIGITS) & (self.known[:, gaps] > 0)).any(axis=1)
            needed[before or []] = False
            out.append(np.flatnonzero(needed).astype(np.int32))
        return out


class _Block:
    """A block's donors; rows with gaps that meet it keep their ``k`` nearest for each gap."""

    def __init__(self, donors: pa.Table, k: int, width: int):
        self.y, self.times, self.k = batch_matrix(donors.column("v"), width), np.asarray(donors.column("n")), k
        self.found: list[tuple[np.ndarray, ...]] = []

    def meet(self, asked: pa.RecordBatch) -> None:
        ids, x = np.asarray(asked.column("id")), batch_matrix(asked.column("v"), self.y.shape[1])
        step = max(1, CELLS // len(self.y))
        for at in range(0, len(x), step):
            self._nearest(ids[at : at + step], x[at : at + step])

    def _nearest(self, ids: np.ndarray, x: np.ndarray) -> None:
        y, k, d = self.y, self.k, self.y.shape[1]
        total, shared = np.zeros((len(x), len(y))), np.zeros((len(x), len(y)))
        for j in range(d):
            gap = x[:, j, None] - y[None, :, j]
            both = ~np.isnan(gap)
            total += np.where(both, gap * gap, 0)
            shared += both
        with np.errstate(divide="ignore", invalid="ignore"):
            distance = np.where(shared > 0, np.round(np.sqrt(total * d / shared), DIGITS), np.inf)
        for c in range(d):
            asking, having = np.flatnonzero(np.isnan(x[:, c])), np.flatnonzero(~np.isnan(y[:, c]))
            if not len(asking) or not len(having):
                continue
            near = distance[np.ix_(asking, having)]
            bound = np.partition(near, k - 1, axis=1)[:, k - 1] if len(having) > k else np.full(len(asking), np.inf)
            i, j = np.nonzero((near <= bound[:, None]) & np.isfinite(near))
            gap, value = near[i, j], y[having[j], c]
            order = np.lexsort((value, gap, i))
            i, j, gap, value = i[order], j[order], gap[order], value[order]
            rank = np.arange(len(i)) - np.searchsorted(i, i)
            few = rank < k
            self.found.append((ids[asking[i[few]]], np.full(few.sum(), c), gap[few], value[few], self.times[having[j[few]]]))

    def rows(self) -> dict[str, pa.Array]:
        kinds = (np.int64, np.int32, float, float, np.int64)
        columns = [np.concatenate(c) for c in zip(*self.found)] if self.found else [np.empty(0)] * 5
        return {n: pa.array(c.astype(t)) for n, c, t in zip(("id", "column", "distance", "value", "n"), columns, kinds)}


class NearestRows:
    """One search; ``met`` and ``possible`` count the meetings of rows with blocks, after ``answers``."""

    def __init__(self, distinct: DataFrame, columns: Sequence[str], k: int, per_block: int):
        """``distinct`` has the columns as doubles and their number of rows in ``_n``."""
        self.spark, self.columns, self.k, self.paths = distinct.sparkSession, list(columns), k, []
        vector = F.array(*[F.col(c) for c in columns])
        pattern = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])
        self.rows = self._keep(distinct.select(
            F.monotonically_increasing_id().alias("id"), vector.alias("v"), F.col("_n").alias("n"), pattern.alias("pattern")), "rows")
        total = self.rows.count()
        self.per_block = min(per_block, max(8, math.isqrt(total)))
        common = self.rows.groupBy("pattern").count().orderBy(F.desc("count"), "pattern").limit(PATTERNS).collect()
        self.patterns = {r["pattern"]: i for i, r in enumerate(common)}
        placed = self._placed(total)
        self.directory, self.donors = self._blocks(placed)

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        found, path = written(df, f"nearest-{name}")
        self.paths.append(path)
        return found

    def discard(self) -> None:
        for path in self.paths:
            discard(self.spark, path)

    def _placed(self, total: int) -> DataFrame:
        """Rows with ``cell``: pattern and nearest pivot over the columns that a row has."""
        n = min(MAX_PIVOTS, max(1, total // self.per_block))
        sample = self.rows.select("v", F.xxhash64("v").alias("h")).orderBy("h").limit(n).collect()
        width, patterns = len(self.columns), self.patterns
        pivots = np.array([r["v"] for r in sample], dtype=float).reshape(-1, width)

        @F.arrow_udf("int")
        def cell(v: pa.Array, pattern: pa.Array) -> pa.Array:
            x, out = batch_matrix(v, width), []
            for at in range(0, len(x), 512):
                gap = x[at : at + 512, None] - pivots[None]
                shared = (~np.isnan(gap)).sum(axis=2)
                near = np.where(shared > 0, np.nansum(gap * gap, axis=2) / np.maximum(shared, 1), np.inf)
                out.append(near.argmin(axis=1))
            kind = np.array([patterns.get(p, len(patterns)) for p in pattern.to_pylist()], np.int64)
            return pa.array((np.concatenate(out) * (len(patterns) + 1) + kind).astype(np.int32))

        return self._keep(self.rows.withColumn("cell", cell("v", "pattern")), "placed")

    def _blocks(self, placed: DataFrame) -> tuple[Directory, DataFrame]:
        """The directory, and donors (task, id, v, n)."""
        _, donors = nearby.tasks_of(placed, self.per_block)
        width = range(len(self.columns))
        value = [F.col("v")[j] for j in width]
        stats = donors.groupBy("task").agg(
            F.sum("n").alias("rows"), F.array(*[F.min(v) for v in value]).alias("low"), F.array(*[F.max(v) for v in value]).alias("high"),
            F.array(*[F.sum(F.when(v.isNotNull(), F.col("n")).otherwise(0)) for v in value]).alias("known"))
        rows = {r["task"]: r for r in stats.collect()}
        n = max(rows, default=-1) + 1

        def table(name: str, empty: float) -> np.ndarray:
            out = np.full((n, len(self.columns)), empty)
            for i, r in rows.items():
                out[i] = [empty if x is None else x for x in r[name]]
            return out

        counts = np.array([rows[i]["rows"] if i in rows else 1 for i in range(n)])
        return Directory(table("low", np.nan), table("high", np.nan), table("known", 0.0), counts), donors.select("task", "id", "v", "n")

    def _met(self, asked: DataFrame) -> DataFrame:
        """(id, column, distance, value, n) after the rows (id, v, blocks) met their blocks."""
        visits = asked.select("id", "v", F.explode("blocks").alias("block"))
        counts = {r["block"]: r["count"] for r in visits.groupBy("block").count().collect()}
        self.met += sum(counts.values())
        parts = np.ones(len(self.directory.low) or 1, np.int64)
        for block, count in counts.items():
            parts[block] = -(-count // VISITS_PER_TASK)
        first = np.cumsum(parts) - parts
        used = np.zeros(len(parts), bool)
        used[list(counts)] = True

        @F.arrow_udf("int")
        def one(block: pa.Array, code: pa.Array) -> pa.Array:
            b = np.asarray(block)
            return pa.array((first[b] + np.asarray(code) % parts[b]).astype(np.int32))

        @F.arrow_udf("array<int>")
        def every(block: pa.Array) -> pa.Array:
            return pa.array([np.arange(first[b], first[b] + parts[b]) if used[b] else [] for b in np.asarray(block)], pa.list_(pa.int32()))

        donors = self.donors.select(F.explode(every("task")).alias("task"), F.lit(0).alias("ball"), "id", "v", "n")
        asking = visits.select(one("block", F.pmod(F.xxhash64("id"), F.lit(1 << 40))).alias("task"), F.lit(1).alias("ball"), "id", "v",
                               F.lit(0).cast("long").alias("n"))
        k, width = self.k, len(self.columns)
        return nearby.streamed(donors.unionByName(asking), lambda rows: _Block(rows, k, width),
                               "id long, column int, distance double, value double, n long")

    def answers(self) -> DataFrame:
        """(id, column, answer): the mean of the ``k`` nearest values of each gap."""
        self.met = 0
        k, directory, width = self.k, self.directory, len(self.columns)
        step = max(1, CELLS // max(1, directory.low.size))
        gaps = self.rows.filter(F.col("pattern").contains("0")).select("id", "v")

        @F.arrow_udf("array<int>")
        def nearest(v: pa.Array) -> pa.Array:
            x = batch_matrix(v, width)
            return pa.array([b for at in range(0, len(x), step) for b in directory.first(x[at : at + step], k)], pa.list_(pa.int32()))

        @F.arrow_udf("array<int>")
        def remaining(v: pa.Array, limits: pa.Array, met: pa.Array) -> pa.Array:
            x, most, before = batch_matrix(v, width), batch_matrix(limits, width), met.to_pylist()
            return pa.array([b for at in range(0, len(x), step) for b in directory.others(
                x[at : at + step], most[at : at + step], before[at : at + step])], pa.list_(pa.int32()))

        asked = self._keep(gaps.withColumn("blocks", nearest("v")), "asked")
        self.possible = asked.count() * len(directory.low)
        close = self._keep(self._met(asked), "close")
        inside = Window.partitionBy("id", "column").orderBy("distance", "value")
        limit = close.withColumn("have", F.sum("n").over(inside)).filter(F.col("have") >= k).groupBy("id", "column").agg(F.min("distance").alias("d"))
        limits = limit.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("column", "d"))).alias("limits"))
        each = F.array(*[F.coalesce(F.try_element_at("limits", F.lit(j)), F.lit(float("inf"))) for j in range(width)])
        rest = asked.join(limits, "id", "left").select("id", "v", remaining("v", each, "blocks").alias("blocks"))
        near = close.unionByName(self._met(self._keep(rest, "rest")))
        before = inside.rowsBetween(Window.unboundedPreceding, -1)
        weight = F.least("n", F.lit(k) - F.coalesce(F.sum("n").over(before), F.lit(0)))
        return near.withColumn("weight", weight).filter("weight > 0").groupBy("id", "column").agg(
            (F.sum(F.col("value") * F.col("weight")) / F.sum("weight")).alias("answer"))
