"""Centroid clustering of integer vectors with a table of pivot distances.

The distances from every vector to a few fixed pivots are computed once and
stored beside the vector. In each round a centroid's own pivot distances are
known to the driver, and by the triangle inequality the difference of two
distances to one pivot bounds the distance of vector and centroid from below.
A vector first meets the centroid of the least bound; only centroids whose
bound stays below the best distance so far get an exact integer distance.

Stored distances are whole square roots, so a bound is the difference less
one: exact distances are always above it, and results equal a full comparison.

A round reads the stored table and hands on one sum per task, centroid and
component; vectors are never shuffled, grouped or collected. The driver holds
the centroids and pivots, ``k`` times the number of components.

Defined results: vectors that are null, hold null or non-finite components or
have another number of components take no part; repeated rows count each; a
vector without an id is clustered, but starts a cluster only if there are fewer
ids than clusters; of rows with one id the smaller vector starts first; with
fewer vectors than clusters each starts one; no vectors give no rows; other
columns are ignored. A scaled component so large that a squared distance could
leave a long (2**27 with 64 components) raises an error.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ospara.llm.graph import discard, written

PIVOTS = 16


def quantised(vectors: DataFrame, vector: str, key: str, components: int, scale: int) -> DataFrame:
    """(id, v) with integer components, for the vectors that take part."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    largest = math.isqrt((2**63 - 1) // components) // 2
    named = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))

    def whole(x: F.Column) -> F.Column:
        scaled = x * F.lit(float(scale))
        return F.when(F.abs(scaled) <= largest, F.floor(scaled)).otherwise(
            F.raise_error(F.lit(f"a scaled component is beyond {largest}")).cast("long"))

    return named.filter(F.col("v").isNotNull() & (F.size("v") == components) & finite).select(
        "id", F.transform("v", whole).alias("v"))


def starts(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The vectors of the ``k`` smallest hashes of salt and id, in that order."""
    code = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    rows = vectors.select("v", code.alias("code")).orderBy(F.asc_nulls_last("code"), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], np.int64)


def far_apart(points: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` of the points, each the farthest from those before it."""
    chosen = [0]
    nearest = squares(points, points[0])
    while len(chosen) < n and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, squares(points, points[chosen[-1]]))
    return points[chosen]


def squares(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to a point, or to a row each."""
    gap = rows - point
    return np.einsum("ij,ij->i", gap, gap)


def whole_roots(values: np.ndarray) -> np.ndarray:
    """The largest integers whose squares do not exceed the values."""
    root = np.sqrt(values.astype(np.float64)).astype(np.int64)
    root -= root * root > values
    root += (root + 1) * (root + 1) <= values
    return root


def pivot_distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.column_stack([whole_roots(squares(rows, p)) for p in pivots])


def nearest(rows: np.ndarray, stored: np.ndarray, centres: np.ndarray, known: np.ndarray):
    """(cluster, squared distance, exact distances computed); ties go to the smaller number.

    ``stored`` and ``known`` are the pivot distances of rows and centres.
    """
    bound = np.zeros((len(rows), len(centres)), np.int64)
    for j in range(stored.shape[1]):
        np.maximum(bound, np.abs(stored[:, j, None] - known[None, :, j]) - 1, out=bound)
    first = bound.argmin(axis=1)
    best = squares(rows, centres[first])
    cluster = first.copy()
    bound *= bound
    computed = len(rows)
    for c, centre in enumerate(centres):
        left = np.flatnonzero((bound[:, c] < best) & (first != c))
        if len(left):
            found = squares(rows[left], centre)
            closer = (found < best[left]) | ((found == best[left]) & (c < cluster[left]))
            best[left[closer]] = found[closer]
            cluster[left[closer]] = c
            computed += len(left)
    return cluster, best, computed


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.int64).reshape(len(column), -1)


def _lists(rows: np.ndarray) -> pa.Array:
    offsets = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel(), pa.int64()))


def with_pivots(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(id, v, p): each vector with its pivot distances."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column("v"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), _lists(rows), _lists(pivot_distances(rows, pivots))], names=["id", "v", "p"])

    return vectors.mapInArrow(measure, "id long, v array<long>, p array<long>")


def moved(table: DataFrame, centres: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centres after one round: floors of the means; a centre without vectors stays."""
    known = pivot_distances(centres, pivots)
    k, d = centres.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, d + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                rows = _matrix(batch.column("v"))
                cluster, _, _ = nearest(rows, _matrix(batch.column("p")), centres, known)
                for c in np.unique(cluster):
                    own = rows[cluster == c]
                    sums[c, :d] += own.sum(axis=0)
                    sums[c, d] += len(own)
        used = np.flatnonzero(sums[:, d])
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), _lists(sums[used])], names=["c", "sums"])

    parts = table.mapInArrow(add, "c int, sums array<long>").select("c", F.posexplode("sums").alias("j", "s"))
    totals = np.zeros((k, d + 1), dtype=object)
    for row in parts.groupBy("c", "j").agg(F.sum("s").alias("s")).collect():
        totals[row["c"], row["j"]] = row["s"]
    out = centres.copy()
    for c in np.flatnonzero(totals[:, d]):
        out[c] = [int(s) // int(totals[c, d]) for s in totals[c, :d]]
    return out


def assigned(table: DataFrame, centres: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """(id, cluster, distance, computed); ``computed`` is the share of exact distances that its batch needed."""
    known = pivot_distances(centres, pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cluster, distance, computed = nearest(_matrix(batch.column("v")), _matrix(batch.column("p")), centres, known)
                share = np.full(batch.num_rows, computed / (batch.num_rows * len(centres)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64()), pa.array(share)],
                    names=["id", "cluster", "distance", "computed"])

    return table.mapInArrow(assign, "id long, cluster int, distance long, computed double")


def clustered(
    vectors: DataFrame,
    k: int = 40,
    rounds: int = 5,
    pivots: int = PIVOTS,
    vector: str = "embedding",
    key: str = "vec_id",
    components: int = 64,
    scale: int = 256,
    salt: str = "2:",
) -> DataFrame:
    """(id, cluster, distance, computed, cluster_inertia, inertia, centroid_sha256, centroid) of every vector that takes part."""
    spark = vectors.sparkSession
    whole = quantised(vectors, vector, key, components, scale)
    columns = ("id long, cluster int, distance long, computed double, cluster_inertia long, inertia long, "
               "centroid_sha256 string, centroid array<long>")
    centres = starts(whole, k, salt)
    if not len(centres):
        return spark.createDataFrame([], columns)
    fixed = far_apart(centres, pivots)
    table, path = written(with_pivots(whole, fixed), "pivot-table")
    for _ in range(rounds):
        centres = moved(table, centres, fixed)
    final, _ = written(assigned(table, centres, fixed), "clustered")
    discard(spark, path)
    inertia = {r["cluster"]: r["s"] for r in final.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    rows = [
        (c, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centres[c].tolist())).encode()).hexdigest(),
         centres[c].tolist())
        for c in sorted(inertia)
    ]
    figures = spark.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<long>")
    return final.join(F.broadcast(figures), "cluster").select(*[c.split()[0] for c in columns.split(", ")])
