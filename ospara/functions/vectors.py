"""Vector arithmetic in Arrow batches against a small, size-checked matrix.

Each batch becomes one NumPy matrix, so scoring a batch is one matrix product.
The matrix side (rules, centroids, queries) is collected behind a size check.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ospara.scale import collect_small


def batch_matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column as a float64 matrix; null or odd rows become NaN."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths().fill_null(0))
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    if len(lengths) and (lengths == dims).all():
        return flat.reshape(len(lengths), dims)
    out = np.full((len(lengths), dims), np.nan)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else []
    for i, (start, length) in enumerate(zip(starts, lengths)):
        if length == dims:
            out[i] = flat[start : start + dims]
    return out


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length one; a zero row stays as it is."""
    norms = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norms > 0, norms, 1.0)


def cosine_matrix(x: np.ndarray, m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(m, axis=1)[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(norms > 0, (x @ m.T) / norms, 0.0)


def distance_matrix(x: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Euclidean distances, by differences, to keep equal points at zero."""
    out = np.empty((len(x), len(m)))
    for j in range(len(m)):
        out[:, j] = np.sqrt(((x - m[j]) ** 2).sum(axis=1))
    return out


#: Scores of one block of rows and queries.
BLOCK_PAIRS = 1 << 22
METRICS = {"cosine": cosine_matrix, "euclidean": distance_matrix}


def scores_to(matrix: np.ndarray, metric: str = "cosine"):
    """UDF: scores of a vector against each row of ``matrix``, as an array."""
    measure = METRICS[metric]
    dims = matrix.shape[1]

    @F.arrow_udf("array<double>")
    def scores(v: pa.Array) -> pa.Array:
        if len(v) == 0:
            return pa.array([], pa.list_(pa.float64()))
        return _lists(measure(batch_matrix(v, dims), matrix))

    return scores


def silhouettes(x: np.ndarray, own: np.ndarray, counts: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """Squared-Euclidean silhouettes of rows in cluster ``own``, from sums per cluster."""
    rows = np.arange(len(x))
    mean = (x * x).sum(axis=1)[:, None] + (squares / counts)[None, :] - 2 * x @ (sums / counts[:, None]).T
    size = counts[own]
    a = mean[rows, own] * size / np.maximum(size - 1, 1)
    mean[rows, own] = np.inf
    b = mean.min(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        s = np.where(size > 1, (b - a) / np.maximum(a, b), 0.0)
    return np.nan_to_num(s)


def silhouette_udf(clusters: Sequence[int], counts: np.ndarray, sums: np.ndarray, squares: np.ndarray):
    """UDF: squared-Euclidean silhouette of a row from per-cluster sums alone."""
    position = {c: i for i, c in enumerate(clusters)}
    dims = sums.shape[1]

    @F.arrow_udf("double")
    def silhouette(v: pa.Array, label: pa.Array) -> pa.Array:
        own = np.array([position[c] for c in label.to_pylist()], dtype=int)
        return pa.array(silhouettes(batch_matrix(v, dims), own, counts, sums, squares))

    return silhouette


def normalized(vector: str) -> Column:
    """Unit vector; a zero vector stays as it is."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.transform(vector, lambda x: F.when(norm > 0, x.cast("double") / norm).otherwise(x.cast("double")))


def group_means(df: DataFrame, group: str, vector: str, mask: Column | None = None) -> DataFrame:
    """Mean vector per group with partial sums before the shuffle.

    With ``mask`` only rows with a positive mask weigh in (masked pooling).
    """
    if mask is not None:
        df = df.filter(mask)
    doubles = F.transform(vector, lambda x: x.cast("double"))
    return (
        df.select(group, array_to_vector(doubles).alias("_v"))
        .groupBy(group)
        .agg(Summarizer.mean(F.col("_v")).alias("_m"), F.count(F.lit(1)).alias("size"))
        .select(group, vector_to_array("_m").alias("center"), "size")
    )


def small_matrix(df: DataFrame, key: str, vector: str, limit: int = 20_000) -> tuple[list, np.ndarray]:
    """Keys and matrix of a side that is checked to be small, ordered by key."""
    rows = sorted(collect_small(df.select(key, vector), limit, "vector side"), key=lambda r: r[0])
    return [r[0] for r in rows], np.array([r[1] for r in rows], dtype=np.float64)


def nearest(
    df: DataFrame,
    id_col: str,
    vector: str,
    query_ids: Sequence,
    queries: np.ndarray,
    k: int,
    metric: str = "cosine",
    salts: int = 32,
) -> DataFrame:
    """Exact top ``k`` rows per query: (query_id, <id>, score, rank).

    Each task keeps its own best ``k`` per query, so the shuffle carries
    tasks x queries x k rows however large the table is; ties go to the
    smaller id. A salted first ranking spreads the rows of one query.
    """
    from ospara.scale import top_k

    measure, dims, best_first = METRICS[metric], queries.shape[1], metric == "cosine"
    qids = np.array(query_ids, dtype=np.int64)

    def local_best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full(len(qids), np.inf)
        kept = [np.empty(0, t) for t in (np.int64, np.int64, float)]
        size = max(k, BLOCK_PAIRS // max(1, len(qids)))
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                rows = batch.slice(at, size)
                score = measure(batch_matrix(rows.column(1), dims), queries).T
                score = np.where(np.isnan(score), np.inf, -score if best_first else score)
                near = np.partition(score, min(k, rows.num_rows) - 1, axis=1)[:, min(k, rows.num_rows) - 1]
                limit = np.minimum(near, best) if rows.num_rows >= k else best
                q, r = np.nonzero((score <= limit[:, None]) & np.isfinite(score))
                found = (q, np.asarray(rows.column(0), dtype=np.int64)[r], score[q, r])
                kept = [np.concatenate(both) for both in zip(kept, found)]
                order = np.lexsort((kept[1], kept[2], kept[0]))
                asked, first, many = np.unique(kept[0][order], return_index=True, return_counts=True)
                place = np.arange(len(order)) - np.repeat(first, many)
                full = many >= k
                best[asked[full]] = kept[2][order[first[full] + k - 1]]
                kept = [column[order[place < k]] for column in kept]
        yield pa.RecordBatch.from_arrays(
            [pa.array(qids[kept[0]]), pa.array(kept[1]), pa.array(-kept[2] if best_first else kept[2])],
            names=["query_id", id_col, "score"],
        )

    partial = df.select(F.col(id_col).cast("long"), vector).mapInArrow(
        local_best, f"query_id long, {id_col} long, score double"
    )
    order = [F.desc("score") if best_first else F.asc("score"), F.asc(id_col)]
    return top_k(partial, ["query_id"], order, k, salts)
