"""Exact top-k by inner product with the no-random-access algorithm.

Every dimension of a block of vectors is a list sorted by value; a query reads
it from the top where its own component is positive and from the bottom where
it is negative. All lists are read to the same depth. Components seen so far,
and the last value read of each list, bound every score from below and above.
Depth grows by a half at a time; vectors whose upper bound misses the k-th
lower bound of every query that still reads are dropped. A query stops when the
vectors that can qualify for it are few; only these get their final score.
Bounds are doubles; where integers are too large for them, bounds are widened
by the rounding error, so that the method and the scores stay exact.

Queries and vectors meet in blocks of bounded size: a block of queries with a
block of vectors is one task's work and hands on ``k`` rows per query.

Defined results: vectors that are null or hold null or non-finite components
take no part, nor do those with a null id; a shorter vector counts as padded
with zeros; a query never meets rows of its own id; ties go to the smaller id;
fewer than ``k`` others give all; without queries there are no rows. A component
or a score of the result beyond a long raises an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ospara.scale import top_k

ROWS_PER_BLOCK = 8192
QUERIES_PER_BLOCK = 512
#: Candidates that are resolved, in multiples of k.
RESOLVED = 8
#: Integers below this are exact in double precision.
EXACT = float(2**53)
#: Share of the lists that is read first, and growth of that share.
FIRST_DEPTH, GROWTH = 1 / 64, 1.5


def quantised(vectors: DataFrame, vector: str = "embedding", key: str = "vec_id", scale: int = 1024) -> DataFrame:
    """(id, v) with integer components, for the vectors that take part."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    named = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))

    def whole(x: F.Column) -> F.Column:
        fits = F.abs(x * F.lit(scale)) < F.lit(float(2**63))
        return F.when(fits, F.floor(x * F.lit(scale))).otherwise(F.raise_error(F.lit("a component exceeds a long")).cast("long"))

    return named.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & finite).select(
        "id", F.transform("v", whole).alias("v"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of integers, padded with zeros."""
    column = column.combine_chunks()
    sizes = np.asarray(column.value_lengths()).astype(np.int64)
    out = np.zeros((len(column), width), np.int64)
    flat = np.asarray(column.flatten())
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def best(ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """Yield (query id, ids, scores, share of the lists read) of the ``k`` best rows of a block for each query."""
    n, d = rows.shape
    largest = float(np.abs(rows.astype(np.float64)).max(initial=0)) * float(np.abs(queries.astype(np.float64)).max(initial=0)) * max(d, 1)
    slack = 0.0 if largest < EXACT else largest * (d + 4) / EXACT
    ascending = np.sort(rows, axis=0).astype(np.float64)
    place = np.empty((n, d), np.int64)
    np.put_along_axis(place, np.argsort(rows, axis=0, kind="stable"), np.arange(n)[:, None], axis=0)
    values = rows.astype(np.float64)
    doubles = queries.astype(np.float64).T
    up, down = np.maximum(doubles, 0), np.minimum(doubles, 0)
    left, waiting = np.arange(n), np.arange(len(query_ids))
    depth = max(1, int(n * FIRST_DEPTH))
    while len(waiting):
        depth = min(depth, n)
        from_top, from_bottom = place >= n - depth, place < depth
        p, m = up[:, waiting], down[:, waiting]
        lower = np.where(from_top, values, ascending[0]) @ p + np.where(from_bottom, values, ascending[-1]) @ m - slack
        upper = np.where(from_top, values, ascending[n - depth]) @ p + np.where(from_bottom, values, ascending[depth - 1]) @ m + slack
        own = ids[left][:, None] == query_ids[waiting][None, :]
        lower[own] = -np.inf
        at = max(0, len(left) - k)
        bar = np.partition(lower, at, axis=0)[at]
        alive = (upper >= bar) & ~own
        done = (alive.sum(axis=0) <= RESOLVED * k) | (depth == n)
        for i in np.flatnonzero(done):
            few = left[alive[:, i]]
            yield query_ids[waiting[i]], *_first(ids[few], _scores(rows[few], queries[waiting[i]], slack > 0), k), depth / n
        waiting = waiting[~done]
        able = alive[:, ~done].any(axis=1)
        left, values, place = left[able], values[able], place[able]
        depth = max(depth + 1, int(depth * GROWTH))


def _scores(rows: np.ndarray, query: np.ndarray, large: bool) -> np.ndarray:
    return rows.astype(object) @ query.astype(object) if large and len(rows) else rows @ query


def _first(ids: np.ndarray, scores: np.ndarray, k: int):
    order = np.lexsort((ids, -scores))[:k]
    if any(abs(int(s)) >= 2**63 for s in scores[order]):
        raise OverflowError("a score exceeds a long")
    return ids[order], scores[order].astype(np.int64)


def exact_top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    rows_per_block: int = ROWS_PER_BLOCK,
    queries_per_block: int = QUERIES_PER_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score, lists_read) of the ``k`` best rows of ``vectors`` (id, v) for ``queries`` (id, v).

    ``lists_read`` is the share of the row's block that was read when the query stopped there.
    """
    n_rows = max(1, -(-vectors.count() // rows_per_block))
    n_queries = max(1, -(-queries.count() // queries_per_block))

    def block(n: int, seed: int) -> F.Column:
        return F.pmod(F.xxhash64("id", "v", F.lit(seed)), F.lit(n))

    def every(n: int) -> F.Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    left = vectors.select("id", "v", block(n_rows, 1).alias("rb"), every(n_queries).alias("qb"))
    right = queries.select(
        F.col("id").alias("query_id"), F.col("v").alias("query"), block(n_queries, 2).alias("of"), every(n_rows).alias("to"))
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("lists_read", pa.float64())])

    def search(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        if not rows.num_rows or not wanted.num_rows:
            return schema.empty_table()
        width = max(pc.max(pc.list_value_length(c)).as_py() for c in (rows.column("v"), wanted.column("query")))
        found = list(best(
            np.asarray(rows.column("id")), _matrix(rows.column("v"), width),
            np.asarray(wanted.column("query_id")), _matrix(wanted.column("query"), width), k,
        ))
        return pa.Table.from_arrays([
            pa.array(np.repeat([q for q, *_ in found], [len(i) for _, i, *_ in found]), pa.int64()),
            pa.array(np.concatenate([i for _, i, *_ in found]), pa.int64()),
            pa.array(np.concatenate([s for _, _, s, _ in found]), pa.int64()),
            pa.array(np.repeat([r for *_, r in found], [len(i) for _, i, *_ in found]), pa.float64()),
        ], schema=schema)

    part = left.groupBy("rb", "qb").cogroup(right.groupBy("to", "of")).applyInArrow(
        search, "query_id long, vec_id long, score long, lists_read double")
    ranked = top_k(part, ["query_id"], [F.desc("score"), F.asc("vec_id")], k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", "lists_read")
