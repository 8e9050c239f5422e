"""Search over text and vectors, and its quality."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ospara.functions import vectors
from ospara.functions.text import fixed_text
from ospara.operators import clustering
from ospara.operators.access import visible_rows
from ospara.operators.filters import metadata_filter
from ospara.scale import top_k
from ospara.session import materialize


def recall_at_k(found: DataFrame, truth: DataFrame, id_col: str, k: int) -> DataFrame:
    """Mean over queries of the share of true neighbours that were found."""
    hits = truth.select("query_id", id_col).join(
        found.select("query_id", id_col, F.lit(1).alias("_hit")), ["query_id", id_col], "left"
    )
    per_query = hits.groupBy("query_id").agg((F.count("_hit") / F.lit(k)).alias("_share"))
    return per_query.agg(F.avg("_share").alias("recall"))


def filtered_nearest(
    df: DataFrame, where: Mapping[str, object], contains: tuple[str, str] | None,
    id_col: str, vector: str, query_ids, queries: np.ndarray, k: int,
) -> DataFrame:
    """Exact search among the rows that pass the metadata and text filters."""
    kept = metadata_filter(df, where)
    if contains:
        kept = kept.filter(F.col(contains[0]).contains(contains[1]))
    return vectors.nearest(kept, id_col, vector, query_ids, queries, k)


def secure_nearest(
    requirements: DataFrame, df: DataFrame, attributes: Mapping[str, list] | None,
    id_col: str, vector: str, query_ids, queries: np.ndarray, k: int,
) -> DataFrame:
    """Search for a caller whose read access was decided before.

    ``attributes`` is None for a caller without access, who gets no rows; rows
    whose required attributes the caller lacks are left out of the search, so
    that the caller's ``k`` best are found.
    """
    if attributes is None:
        return vectors.nearest(df.limit(0), id_col, vector, query_ids, queries, k)
    owned = F.from_json(F.lit(json.dumps(dict(attributes))), "map<string,array<string>>")
    seen = visible_rows(requirements, "required_attributes", owned).select(id_col)
    return vectors.nearest(df.join(seen, id_col, "left_semi"), id_col, vector, query_ids, queries, k)


#: Rows that the centres are fitted on, per cell, and rows of one file.
SAMPLE_PER_CELL, ROWS_PER_FILE, MAX_CELLS = 256, 1_000_000, 4096
#: Scores of a code step: residuals are kept as whole numbers up to this.
LEVELS = 127


class CellIndex:
    """Vectors by cell, with one byte a component for the first ranking.

    A vector is coded in its ``copies`` nearest cells: the difference to the
    cell's centre, divided by its largest component, in whole steps. Its full
    form is stored once, in its nearest cell. A search reads the codes of the
    cells that its queries need, and a row meets only the queries that need
    its cell, once each. Rounding bounds every score from both sides, so the
    rows that may be among the best ``k`` of the cells read are known; only
    these are scored exactly. What is found is exact for the cells read; how
    many neighbours lie in these is the index's recall.

    Centres are fitted on a sample of ``SAMPLE_PER_CELL`` rows a cell; every
    row with a finite vector of the most common length is in the index.
    """

    def __init__(self, spark: SparkSession, path: str, centers: np.ndarray, id_col: str, vector: str):
        self.spark, self.path, self.centers = spark, path, centers
        self.id_col, self.vector = id_col, vector

    @classmethod
    def build(
        cls, df: DataFrame, id_col: str, vector: str, path: str, cells: int | None = None, copies: int = 1
    ) -> CellIndex:
        whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        rows = df.filter(F.col(vector).isNotNull() & whole)
        size = rows.groupBy(F.size(vector).alias("dims")).count().orderBy(F.desc("count"), "dims").first()
        if not size:
            raise ValueError("an index needs vectors")
        rows = rows.filter(F.size(vector) == size["dims"])
        total = size["count"]
        cells = cells or min(MAX_CELLS, max(1, math.isqrt(total)))
        share = min(1.0, SAMPLE_PER_CELL * cells / max(1, total))
        sample = rows.filter(F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) < int(share * (1 << 30)))
        model, _ = clustering.kmeans(sample.select(vectors.normalized(vector).alias("_unit")), "_unit", cells)
        centers = np.array(model.clusterCenters())
        sizes = np.array(model.summary.clusterSizes, dtype=float)
        salts = np.maximum(1, np.ceil(sizes / sizes.sum() * total / ROWS_PER_FILE)).astype(int).tolist()
        index = cls(df.sparkSession, path, centers, id_col, vector)
        index._write(rows, min(copies, len(centers)), salts)
        return index

    def _write(self, df: DataFrame, copies: int, salts: list[int]) -> None:
        centers, dims = self.centers, self.centers.shape[1]
        squares = (centers * centers).sum(axis=1)

        def files(rows: DataFrame, cell: str, name: str) -> None:
            many = F.element_at(F.array(*[F.lit(n) for n in salts]), F.col(cell) + 1)
            rows.repartition(cell, F.pmod(F.xxhash64("id"), many)).write.partitionBy(cell).parquet(f"{self.path}/{name}")

        @F.arrow_udf("array<int>")
        def cells_of(v: pa.Array) -> pa.Array:
            x = vectors.unit_rows(vectors.batch_matrix(v, dims))
            near = np.argsort(squares - 2 * x @ centers.T, axis=1, kind="stable")[:, :copies]
            return pa.array(list(near.astype(np.int32)), pa.list_(pa.int32()))

        def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = vectors.unit_rows(vectors.batch_matrix(batch.column("v"), dims))
                cells = np.array(batch.column("cells").to_pylist())
                for j in range(cells.shape[1]):
                    gap = x - centers[cells[:, j]]
                    step = np.abs(gap).max(axis=1) / LEVELS
                    whole = np.rint(gap / np.where(step > 0, step, 1)[:, None]).astype(np.int8)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id"), pa.array(cells[:, j], pa.int32()), batch.column("cells"),
                         pa.array([row.tobytes() for row in whole], pa.binary()), pa.array(step)],
                        names=["id", "cell", "cells", "code", "step"])

        rows = df.select(F.col(self.id_col).cast("long").alias("id"), F.col(self.vector).cast("array<double>").alias("v"))
        placed = rows.withColumn("cells", cells_of("v")).withColumn("home", F.col("cells")[0])
        files(placed, "home", "vectors")
        stored = self.spark.read.parquet(f"{self.path}/vectors")
        files(stored.mapInArrow(code, "id long, cell int, cells array<int>, code binary, step double"), "cell", "codes")

    def search(self, query_ids: Sequence, queries: np.ndarray, k: int, probes: int = 8) -> DataFrame:
        """(query_id, <id>, score, rank) of the best ``k`` rows by cosine in each query's ``probes`` nearest cells."""
        centers, dims = self.centers, self.centers.shape[1]
        unit = vectors.unit_rows(np.asarray(queries, dtype=float))
        gaps = (centers * centers).sum(axis=1) - 2 * unit @ centers.T
        order = np.argsort(gaps, axis=1, kind="stable")[:, :probes]
        place = np.full(gaps.shape, len(centers), np.int32)
        np.put_along_axis(place, order, np.arange(order.shape[1], dtype=np.int32)[None], axis=1)
        weight = np.abs(unit).sum(axis=1) / 2 * (1 + 1e-6)
        names = np.array(query_ids, np.int64)

        def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # least: a score that k rows of the cells read surely reach, by query.
            least = np.full(len(names), -np.inf)
            kept = [np.empty(0, t) for t in (np.int32, np.int64, np.int32, float, float)]
            for batch in batches:
                if not batch.num_rows:
                    continue
                every = np.asarray(batch.column("cell"))
                for cell in np.unique(every):
                    part = batch.filter(pa.array(every == cell))
                    asking = np.flatnonzero(place[:, cell] < len(centers))
                    whole = np.frombuffer(b"".join(part.column("code").to_pylist()), np.int8).reshape(-1, dims)
                    step, own = np.asarray(part.column("step")), np.asarray(part.column("id"))
                    cells = np.asarray(part.column("cells").flatten()).reshape(len(own), -1)
                    base, size = unit[asking] @ centers[cell], max(k, vectors.BLOCK_PAIRS // max(1, len(asking)))
                    for at in range(0, len(own), size):
                        rows = slice(at, at + size)
                        score = base[:, None] + unit[asking] @ whole[rows].astype(float).T * step[rows]
                        error = weight[asking][:, None] * step[rows] + 1e-9
                        if score.shape[1] >= k:
                            low = np.partition(score - error, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
                            least[asking] = np.maximum(least[asking], low)
                        n, r = np.nonzero(score + error >= least[asking][:, None])
                        q, there = asking[n], cells[rows][r]
                        once = place[q[:, None], there].min(axis=1) == place[q, cell]
                        n, r, q = n[once], r[once], q[once]
                        found = (q.astype(np.int32), own[rows][r], there[once, 0].astype(np.int32),
                                 (score - error)[n, r], (score + error)[n, r])
                        kept = [np.concatenate(both) for both in zip(kept, found)]
                if len(kept[0]) >= k:
                    order = np.lexsort((-kept[3], kept[0]))
                    asked, first = np.unique(kept[0][order], return_index=True)
                    full = np.diff(np.append(first, len(order))) >= k
                    asked, first = asked[full], first[full]
                    least[asked] = np.maximum(least[asked], kept[3][order[first + k - 1]])
                left = kept[4] >= least[kept[0]]
                kept = [column[left] for column in kept]
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in kept], names=["q", "id", "home", "low", "high"])

        codes = self.spark.read.parquet(f"{self.path}/codes").filter(F.col("cell").isin(np.unique(order).tolist()))
        near = materialize(codes.mapInArrow(rank, "q int, id long, home int, low double, high double"), "near")
        least = top_k(near.select("q", "id", "low"), ["q"], [F.desc("low")], k).filter(F.col("rank") == k).select("q", F.col("low").alias("least"))
        few = near.join(least, "q", "left").filter("least IS NULL OR high >= least").select("q", "id", "home")

        @F.arrow_udf("double")
        def exact(q: pa.Array, v: pa.Array) -> pa.Array:
            rows = vectors.unit_rows(vectors.batch_matrix(v, dims))
            return pa.array((rows * unit[np.asarray(q)]).sum(axis=1))

        @F.arrow_udf("long")
        def name(q: pa.Array) -> pa.Array:
            return pa.array(names[np.asarray(q)])

        stored = self.spark.read.parquet(f"{self.path}/vectors").select("home", "id", "v")
        scored = few.join(stored, ["home", "id"]).select(
            name("q").alias("query_id"), F.col("id").alias(self.id_col), exact("q", "v").alias("score"))
        return top_k(scored, ["query_id"], [F.desc("score"), F.asc(self.id_col)], k)


def recall_of(index: CellIndex, df: DataFrame, query_ids: Sequence, queries: np.ndarray, k: int, probes: int) -> DataFrame:
    """(recall): the share of the exact ``k`` nearest rows that the index finds."""
    truth = vectors.nearest(df, index.id_col, index.vector, query_ids, queries, k)
    return recall_at_k(index.search(query_ids, queries, k, probes), truth, index.id_col, k)


def keyword_score(text: Column, query: str) -> Column:
    """Occurrences of the query plus one when it occurs, case-insensitive."""
    low, q = F.lower(text), query.lower()
    times = (F.length(low) - F.length(F.replace(low, F.lit(q)))) / len(q)
    return times.cast("int") + F.when(low.contains(q), 1).otherwise(0)


def keyword_search(df: DataFrame, id_col: str, text: str, query: str, k: int) -> DataFrame:
    scored = df.select(id_col, keyword_score(F.col(text), query).alias("score")).filter("score > 0")
    return scored.orderBy(F.desc("score"), id_col).limit(k)


def substring_search(df: DataFrame, text: str, query: str) -> DataFrame:
    return df.filter(F.lower(text).contains(query.lower()))


def main_drivers(loadings: DataFrame, limit: float = 0.3) -> DataFrame:
    """Loadings above the limit, strongest first in each component."""
    strong = loadings.filter(F.abs("loading") > limit)
    size = F.struct((-F.abs("loading")).alias("a"), F.col("feature").alias("f"), F.col("loading").alias("l"))
    return strong.groupBy("component").agg(
        F.transform(
            F.sort_array(F.collect_list(size)),
            lambda s: F.concat(s["f"], F.lit(" ("), fixed_text(s["l"], 3), F.lit(")")),
        ).alias("drivers")
    )
