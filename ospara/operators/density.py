"""Density clusters in any number of coordinates.

Copies of a point are folded into one weighted point. Points are then folded
into groups: a leader with points within half of ``eps``, so that all members
of a group are neighbours. A group of ``min_samples`` rows holds core points
only, and no pair inside a group is ever formed. Members of lighter groups first count
the points of their own block; who finds enough there is core. The others meet
the groups in their reach (``nearby``): a group that is wholly within ``eps``
counts with its weight, and only groups that may be partly within it are
looked into, for points whose count is still open.

Groups of core points are linked by their leaders where these are within
``eps``, first inside a block and with some points that all blocks meet. Only
groups outside the largest component of that meet all others, as two groups of
one component need no link. Groups that are near but not linked so compare members only if they
are still in different components after that, and only members that pass the
triangle inequality against both leaders.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ospara.functions.vectors import batch_matrix
from ospara.operators import nearby
from ospara.operators.nearby import MARGIN, Pivots, distance, intervals
from ospara.scale import positions
from ospara.session import discard, written

FOLDED = "id long, v array<double>, w long, cell int, gap double, leader long, away double, rho double, weight long"
#: Points of one folding task.
FOLD_ROWS = 4096
#: Points of one block, and points that all blocks meet.
BLOCK_ROWS, HUBS = 8192, 2048


def _vector(coords: str | Sequence[str]):
    """The point of a row, null where a coordinate is missing or not finite."""
    v = F.col(coords).cast("array<double>") if isinstance(coords, str) else F.array(*[F.col(c).cast("double") for c in coords])
    return F.when(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), v)


def folded(points: DataFrame, eps: float) -> DataFrame:
    """Placed points with the leader of their group, its radius and weight."""
    _, placed = nearby.tasks_of(points, FOLD_ROWS)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        current = None

        def groups() -> pa.RecordBatch:
            rows = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            x = batch_matrix(rows.column("v"), len(rows.column("v")[0]))
            ids, times = np.asarray(rows.column("id")), np.asarray(rows.column("w"))
            own, away = np.full(len(x), -1), np.zeros(len(x))
            free = np.arange(len(x))
            while len(free):
                gap = nearby.to_point(x[free], x[free[0]])
                inside = gap <= eps / 2 * (1 - MARGIN)
                inside[0] = True
                own[free[inside]], away[free[inside]] = free[0], gap[inside]
                free = free[~inside]
            rho, weight = np.zeros(len(x)), np.zeros(len(x), np.int64)
            np.maximum.at(rho, own, away * (1 + MARGIN))
            np.add.at(weight, own, times)
            return pa.RecordBatch.from_arrays(
                [*[rows.column(c) for c in ("id", "v", "w", "cell", "gap")], pa.array(ids[own]), pa.array(away),
                 pa.array(rho[own]), pa.array(weight[own])], names=[c.split()[0] for c in FOLDED.split(", ")])

        for batch in batches:
            numbers = np.asarray(batch.column("task"))
            edges = [0, *(np.flatnonzero(np.diff(numbers)) + 1), len(numbers)]
            for a, b in zip(edges[:-1], edges[1:]):
                if a < b:
                    if numbers[a] != current and waiting:
                        yield groups()
                        waiting = []
                    current = numbers[a]
                    waiting.append(batch.slice(a, b - a))
        if waiting:
            yield groups()

    return placed.repartition("task").sortWithinPartitions("task", "id").mapInArrow(fold, FOLDED)


def _balls(rows: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, centres and radii."""
    v = rows.column("v")
    dims = len(v[0])
    return np.asarray(rows.column("id")), batch_matrix(v, dims), np.asarray(rows.column("rho"))


class _Open:
    """Light points of a block that do not surely find ``least`` rows within ``eps`` in it."""

    def __init__(self, members: pa.Table, eps: float, least: int):
        x, weights = batch_matrix(members.column("v"), len(members.column("v")[0])), np.asarray(members.column("w"))
        asked = np.flatnonzero(np.asarray(members.column("weight")) < least)
        sure = np.zeros(len(x), np.int64)
        for at in range(0, len(x), nearby.SLICE):
            left = asked[sure[asked] < least]
            for start in range(0, len(left), nearby.OWNERS):
                rows = left[start : start + nearby.OWNERS]
                high = intervals(x[rows], x[at : at + nearby.SLICE])[1]
                sure[rows] += (high <= eps * (1 - MARGIN)) @ weights[at : at + nearby.SLICE]
        self.ids = np.asarray(members.column("id"))[asked[sure[asked] < least]]

    def rows(self) -> dict[str, pa.Array]:
        return {"id": pa.array(self.ids)}


class _Counts:
    """Weight surely within ``eps`` of each owner, and the groups to look into while that is below ``least``."""

    def __init__(self, owners: pa.Table, eps: float, least: int):
        ids, self.points, _ = _balls(owners)
        self.ids, self.eps, self.least = ids, eps, least
        self.sure = np.zeros(len(ids), np.int64)
        self.near: list[list[tuple]] = [[] for _ in ids]

    def meet(self, balls: pa.RecordBatch) -> None:
        ids, points, radii = _balls(balls)
        weights = np.asarray(balls.column("weight"))
        left = np.flatnonzero(self.sure < self.least)
        for at in range(0, len(left), nearby.OWNERS):
            rows = left[at : at + nearby.OWNERS]
            low, high = intervals(self.points[rows], points)
            inside = high + radii[None, :] <= self.eps * (1 - MARGIN)
            self.sure[rows] += inside @ weights
            for i, j in zip(*np.nonzero(low <= (self.eps + radii[None, :]) * (1 + MARGIN))):
                self.near[rows[i]].append((int(ids[j]), float(low[i, j]), float(high[i, j]), bool(inside[i, j])))
            for i in rows[self.sure[rows] >= self.least]:
                self.near[i] = []

    def rows(self) -> dict[str, pa.Array]:
        kind = pa.list_(pa.struct([("leader", pa.int64()), ("low", pa.float64()), ("high", pa.float64()), ("sure", pa.bool_())]))
        near = [[dict(zip(("leader", "low", "high", "sure"), n)) for n in own] for own in self.near]
        return {"id": pa.array(self.ids), "sure": pa.array(self.sure), "near": pa.array(near, kind)}


class _Links:
    """Spanning edges between owners and balls whose centres are within ``eps``; pairs that only their members can link."""

    def __init__(self, owners: pa.Table, eps: float):
        self.ids, self.points, self.radii = _balls(owners)
        self.eps = eps
        self.slots = {int(i): n for n, i in enumerate(self.ids)}
        self.parent, self.size = np.arange(len(self.ids)), np.ones(len(self.ids), np.int64)
        self.edges: list[tuple[int, int, bool]] = []
        self.open: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def _roots(self, slots: np.ndarray) -> np.ndarray:
        found = self.parent[slots]
        while (self.parent[found] != found).any():
            found = self.parent[found]
        self.parent[slots] = found
        return found

    def meet(self, balls: pa.RecordBatch) -> None:
        ids, points, radii = _balls(balls)
        slots = np.array([self.slots.setdefault(int(i), len(self.slots)) for i in ids])
        self.parent = np.append(self.parent, np.arange(len(self.parent), len(self.slots)))
        self.size = np.append(self.size, np.ones(len(self.slots) - len(self.size), np.int64))
        for at in range(0, len(self.ids), nearby.OWNERS):
            # Rows and balls of one component need no comparison; mostly it is the largest one's.
            rows, there = np.arange(at, min(at + nearby.OWNERS, len(self.ids))), self._roots(slots)
            names, many = np.unique(there, return_counts=True)
            within = self._roots(rows) == names[many.argmax()]
            others = np.flatnonzero(there != names[many.argmax()])
            self._link(rows[~within], ids, points, radii, slots)
            self._link(rows[within], ids[others], points[others], radii[others], slots[others])

    def _link(self, rows: np.ndarray, ids: np.ndarray, points: np.ndarray, radii: np.ndarray, slots: np.ndarray) -> None:
        if not len(rows) or not len(ids):
            return
        low, high = intervals(self.points[rows], points)
        linked = high <= self.eps
        new = linked & (self._roots(rows)[:, None] != self._roots(slots)[None, :])
        for i in np.flatnonzero(new.any(axis=1)):
            there = np.flatnonzero(new[i])
            roots, first = np.unique(self._roots(slots[there]), return_index=True)
            own = self._roots(rows[i : i + 1])[0]
            self.edges += [(int(self.ids[rows[i]]), int(ids[n]), True) for root, n in zip(roots, there[first]) if root != own]
            # The largest root stays, so that paths stay short.
            merged = np.union1d(roots, own)
            top = merged[self.size[merged].argmax()]
            self.size[top] = self.size[merged].sum()
            self.parent[merged] = top
        self._undecided(rows, ids, slots, ~linked & (low <= (self.eps + self.radii[rows, None] + radii[None, :]) * (1 + MARGIN)))

    def _undecided(self, rows: np.ndarray, ids: np.ndarray, slots: np.ndarray, near: np.ndarray) -> None:
        i, j = np.nonzero(near)
        apart = self._roots(rows[i]) != self._roots(slots[j]) if len(i) else np.empty(0, bool)
        if apart.any():
            self.open.append((self.ids[rows[i[apart]]], ids[j[apart]], rows[i[apart]], slots[j[apart]]))

    def rows(self) -> dict[str, pa.Array]:
        for u, v, i, j in self.open:
            for n in np.flatnonzero(self._roots(i) != self._roots(j)):
                self.edges.append((int(u[n]), int(v[n]), False))
        u, v, sure = zip(*self.edges) if self.edges else ((), (), ())
        return {"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()), "sure": pa.array(sure, pa.bool_())}


class _Local(_Links):
    """Spanning edges inside a block and to the balls that all blocks meet; what is not linked so is left to ``_Links``."""

    def __init__(self, owners: pa.Table, eps: float):
        super().__init__(owners, eps)
        for batch in owners.to_batches(max_chunksize=nearby.SLICE):
            self.meet(batch)

    def _undecided(self, *_) -> None:
        pass


class _Clusters:
    """The written steps of one run."""

    def __init__(self, df: DataFrame, coords: str | Sequence[str], eps: float, least: int):
        self.spark, self.eps, self.least, self.paths = df.sparkSession, eps, least, []
        rows = df.select(_vector(coords).alias("v")).filter("v IS NOT NULL")
        distinct = rows.groupBy("v").agg(F.count(F.lit(1)).alias("w")).select(F.monotonically_increasing_id().alias("id"), "v", "w")
        points = self._keep(distinct, "points")
        total, least_dims, most_dims = points.agg(F.count(F.lit(1)), F.min(F.size("v")), F.max(F.size("v"))).first()
        self.empty = not total
        if self.empty:
            return
        if least_dims != most_dims:
            raise ValueError("points have different numbers of coordinates")
        self.pivots = Pivots.sampled(points, total, eps / 2)
        self.members = self._keep(folded(self._keep(self.pivots.place(points), "placed"), eps), "members")
        self.counted = self._keep(self._counts(), "counts")
        self.points = self._keep(self._core(), "core")

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        found, path = written(df, f"dbscan-{name}")
        self.paths.append(path)
        return found

    def discard(self) -> None:
        for path in self.paths:
            discard(self.spark, path)

    def _counts(self) -> DataFrame:
        """State of the light members that their block leaves open."""
        eps, least = self.eps, self.least
        schema = "id long, sure long, near array<struct<leader long, low double, high double, sure boolean>>"
        blocks = nearby.tasks_of(self.members, BLOCK_ROWS, shared=True)[1].select("task", F.lit(0).alias("ball"), "id", "v", "w", "weight")
        open_ = self._keep(nearby.streamed(blocks, lambda members: _Open(members, eps, least), "id long"), "open")
        if open_.isEmpty():
            return self.spark.createDataFrame([], schema)
        light = self.members.join(open_, "id", "left_semi").withColumn("rho", F.lit(0.0))
        balls = self.members.filter("id = leader")
        return nearby.streamed(nearby.meetings(light, balls, self.pivots, eps), lambda owners: _Counts(owners, eps, least), schema)

    def _near_links(self, nodes: DataFrame) -> DataFrame:
        """Sure edges inside blocks of nodes and to nodes that all blocks meet."""
        eps = self.eps
        found, placed = nearby.tasks_of(nodes, BLOCK_ROWS, shared=True)
        tasks = F.sequence(F.lit(0), F.lit(max((n + many - 1 for n, many in found.values()), default=0)))
        hubs = nodes.orderBy(F.xxhash64("id"), "id").limit(HUBS)
        rows = placed.select("task", F.lit(0).alias("ball"), "id", "v", "rho").unionByName(
            hubs.select(F.explode(tasks).alias("task"), F.lit(1).alias("ball"), "id", "v", "rho"))
        return nearby.streamed(rows, lambda owners: _Local(owners, eps), "u long, v long, sure boolean")

    def _into(self, asked: DataFrame, members: DataFrame) -> DataFrame:
        """Pairs of asked points (id, v, near) and members within ``eps``, by the leaders in reach."""
        each = asked.select(F.col("id").alias("p"), F.col("v").alias("pv"), F.inline("near"))
        slack = F.lit(self.eps * (1 + MARGIN))
        pairs = each.withColumnRenamed("sure", "whole").join(members, "leader")
        pairs = pairs.filter((F.col("away") <= F.col("high") + slack) & (F.col("away") >= F.col("low") - slack))
        return pairs.filter(distance(F.col("pv"), F.col("v")) <= self.eps)

    def _core(self) -> DataFrame:
        """Members with ``core`` and, where that was open, their near groups."""
        open_ = self.counted.filter(F.col("sure") < self.least).join(self.members.select("id", "v"), "id")
        partial = open_.withColumn("near", F.filter("near", lambda n: ~n["sure"]))
        more = self._into(partial, self.members).groupBy("p").agg(F.sum("w").alias("more"))
        state = self.counted.join(more, F.col("id") == F.col("p"), "left").select(
            "id", (F.col("sure") + F.coalesce("more", F.lit(0)) >= self.least).alias("reached"), "near")
        return self.members.join(state, "id", "left").withColumn("core", F.coalesce("reached", F.lit(True))).drop("reached")

    def labels(self) -> DataFrame:
        """(v, core, cluster) of all points that are core or within ``eps`` of a core point."""
        eps = self.eps
        heavy = F.col("weight") >= self.least
        core = self.points.filter("core").withColumn("node", F.when(heavy, F.col("leader")).otherwise(F.col("id")))
        core = core.withColumns({"rho": F.when(heavy, F.col("rho")).otherwise(0.0), "to_node": F.when(heavy, F.col("away")).otherwise(0.0)})
        nodes = core.filter("id = node").select("id", "v", "rho", "weight", "cell", "gap")
        names = nodes.select(F.col("id").alias("node"))
        links = self._keep(self._near_links(nodes), "near-links")
        found = self._keep(connected_components(names, links.select("u", "v")), "near-components")
        largest = found.groupBy("component").count().orderBy(F.desc("count"), "component").first()
        outside = found.filter(F.col("component") != (largest["component"] if largest else -1)).select(F.col("node").alias("id"))
        if outside.isEmpty():
            links = links.filter("NOT sure")
        else:
            owners = nodes.join(outside, "id", "left_semi")
            more = self._keep(nearby.streamed(
                nearby.meetings(owners, nodes, self.pivots, eps), lambda owners: _Links(owners, eps),
                "u long, v long, sure boolean"), "links")
            links = links.unionByName(more)
            found = self._keep(connected_components(names, links.filter("sure").select("u", "v")), "components")
        found = self._joined(found, links, core, nodes)
        named = core.join(found, "node")
        first = named.groupBy("component").agg(F.min("v").alias("_p")).select(F.lit(0).alias("_all"), "component", "_p")
        numbers = positions(first, ["_all"], ["_p"]).select("component", (F.col("pos") - 1).alias("cluster"))
        labelled = self._keep(named.join(numbers, "component").select("id", "v", "leader", "away", "w", "cluster"), "labels")
        edge = self._into(self.points.filter("NOT core"), labelled).groupBy("pv").agg(F.min("cluster").alias("cluster"))
        return labelled.select("v", F.lit(True).alias("core"), "cluster").unionByName(
            edge.select(F.col("pv").alias("v"), F.lit(False).alias("core"), "cluster"))

    def _joined(self, found: DataFrame, links: DataFrame, core: DataFrame, nodes: DataFrame) -> DataFrame:
        """Components after pairs of near groups that are still apart have compared their members."""
        a, b = (found.select(F.col("node").alias(n), F.col("component").alias(f"c{n}")) for n in ("u", "v"))
        ball = nodes.select("id", F.col("v").alias("x"), "rho")
        apart = links.filter("NOT sure").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        apart = self._keep(
            apart.join(a, "u").join(b, "v").filter("cu <> cv")
            .join(ball.select(F.col("id").alias("u"), F.col("x").alias("xu"), F.col("rho").alias("ru")), "u")
            .join(ball.select(F.col("id").alias("v"), F.col("x").alias("xv"), F.col("rho").alias("rv")), "v"), "apart")
        if apart.isEmpty():
            return found
        eps = self.eps
        member = core.select("node", F.col("v").alias("m"), "to_node")
        ahead, behind = distance(F.col("m"), F.col("xv")), distance(F.col("m"), F.col("xu"))
        left = apart.join(member, F.col("u") == F.col("node")).select(
            "u", "v", "cu", "cv", "rv", F.col("m").alias("mu"), F.col("to_node").alias("au"), ahead.alias("bu")
        ).filter(F.col("bu") <= (eps + F.col("rv")) * (1 + MARGIN))
        right = apart.join(member, F.col("v") == F.col("node")).select(
            "u", "v", "ru", F.col("m").alias("mv"), F.col("to_node").alias("bv"), behind.alias("av")
        ).filter(F.col("av") <= (eps + F.col("ru")) * (1 + MARGIN))
        slack = eps * (1 + MARGIN)
        met = left.join(right, ["u", "v"]).filter(
            (F.abs(F.col("au") - F.col("av")) <= slack) & (F.abs(F.col("bu") - F.col("bv")) <= slack)
        ).filter(distance(F.col("mu"), F.col("mv")) <= eps)
        edges = met.select(F.col("cu").alias("u"), F.col("cv").alias("v")).distinct()
        roots = found.select(F.col("component").alias("node")).distinct()
        merged = connected_components(roots, edges).select(F.col("node").alias("component"), F.col("component").alias("_c"))
        return self._keep(found.join(merged, "component").select("node", F.col("_c").alias("component")), "merged")


def core_points(df: DataFrame, coords: str | Sequence[str], eps: float, min_samples: int) -> DataFrame:
    """The distinct points ``v`` with their weight ``w`` and the ``core`` flag; a point counts itself.

    ``coords`` names the columns of the coordinates, or one column of arrays.
    """
    run = _Clusters(df, coords, eps, min_samples)
    if run.empty:
        return df.sparkSession.createDataFrame([], "v array<double>, w long, core boolean")
    return run.points.select("v", "w", "core")


def dbscan(df: DataFrame, coords: str | Sequence[str], eps: float = 0.5, min_samples: int = 5) -> DataFrame:
    """The table with ``core`` and ``cluster``; noise is -1.

    Clusters are numbered from 0 along their smallest core point; a border
    point joins the lowest-numbered cluster in reach. Rows with a missing or
    infinite coordinate are noise and count for nobody.
    """
    run = _Clusters(df, coords, eps, min_samples)
    if run.empty:
        return df.withColumns({"core": F.lit(False), "cluster": F.lit(-1).cast("long")})
    labels, _ = written(run.labels(), "dbscan")
    run.discard()
    keyed = df.withColumn("_v", _vector(coords))
    found = keyed.join(labels.withColumnRenamed("v", "_v"), "_v", "left").drop("_v")
    return found.withColumns({"core": F.coalesce("core", F.lit(False)), "cluster": F.coalesce("cluster", F.lit(-1).cast("long"))})


def connected_components(nodes: DataFrame, edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component): the smallest node name in reach.

    Alternating star contractions; each round is written to the shared folder
    and replaces the one before, so a lost executor costs a round at most.
    Partial minima precede every shuffle, and a node with many neighbours is
    spread by the skew split.
    """
    spark = nodes.sparkSession
    current, path = written(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.*").filter("u <> v").distinct()
        following, next_path = written(small, "edges")
        discard(spark, path)
        current, path = following, next_path
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    roots = current.groupBy("u").agg(F.min("v").alias("component"))
    return nodes.join(roots, nodes["node"] == roots["u"], "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )
