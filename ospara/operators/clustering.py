"""Clusters, their quality and the choice of their number."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ospara.functions import vectors
from ospara.scale import collect_small

SEED = 42
MAX_CLUSTERS = 20_000
#: Rows that the starting centres are chosen among, rounds at most, and digits of squared distances that count.
START_ROWS, ROUNDS, DIGITS = 256, 10, 9


@dataclass(frozen=True)
class ClusterStats:
    """Per-cluster sums of a labelled table: small, whatever its row count."""

    clusters: list
    counts: np.ndarray
    sums: np.ndarray
    squares: np.ndarray

    @property
    def centers(self) -> np.ndarray:
        return self.sums / self.counts[:, None]


def cluster_stats(df: DataFrame, label: str, vector: str) -> ClusterStats:
    doubles = F.transform(vector, lambda x: x.cast("double"))
    v = F.col("_v")
    summed = (
        df.select(label, array_to_vector(doubles).alias("_v"))
        .groupBy(label)
        .agg(
            Summarizer.sum(v).alias("_s"), Summarizer.normL2(v).alias("_n"), F.count(F.lit(1)).alias("_c")
        )
        .select(label, vector_to_array("_s").alias("_s"), vector_to_array("_n").alias("_n"), "_c")
    )
    rows = sorted(collect_small(summed, MAX_CLUSTERS, "cluster list"), key=lambda r: r[0])
    return ClusterStats(
        [r[0] for r in rows],
        np.array([r["_c"] for r in rows], dtype=float),
        np.array([r["_s"] for r in rows], dtype=float),
        np.array([np.square(r["_n"]).sum() for r in rows], dtype=float),
    )


def with_silhouette(df: DataFrame, label: str, vector: str, stats: ClusterStats | None = None) -> DataFrame:
    """Squared-Euclidean silhouette per row, from sums per cluster: one scan."""
    stats = stats or cluster_stats(df, label, vector)
    udf = vectors.silhouette_udf(stats.clusters, stats.counts, stats.sums, stats.squares)
    return df.withColumn("silhouette", udf(F.col(vector), F.col(label)))


def _number(x: Column) -> Column:
    """NULL instead of NaN."""
    return F.when(~F.isnan(x), x)


def with_center_distance(df: DataFrame, vector: str, centers: np.ndarray, label: str | None = None,
                         clusters: Sequence | None = None) -> DataFrame:
    """Distance to the own centre when ``label`` is given, else to the nearest.

    A vector that is null or of another length has none.
    """
    distances = vectors.scores_to(centers, "euclidean")(F.col(vector))
    if label is None:
        return df.withColumn("distance_to_center", _number(F.array_min(distances)))
    place = F.array_position(F.array(*[F.lit(c) for c in clusters]), F.col(label)).cast("int")
    return df.withColumn("distance_to_center", _number(F.try_element_at(distances, F.nullif(place, F.lit(0)))))


def cluster_profile(df: DataFrame, label: str, vector: str) -> DataFrame:
    """Size, mean distance to the centre, mean silhouette; the best is marked."""
    stats = cluster_stats(df, label, vector)
    rows = with_silhouette(df, label, vector, stats)
    rows = with_center_distance(rows, vector, stats.centers, label, stats.clusters)
    table = rows.groupBy(label).agg(
        F.count(F.lit(1)).alias("size"), F.avg("distance_to_center").alias("avg_distance"),
        F.avg("silhouette").alias("silhouette"),
    )
    place = Window.orderBy(F.desc("silhouette"), F.desc("size"), label)
    return table.withColumn("best", F.row_number().over(place) == 1)


def quality(df: DataFrame, label: str, vector: str) -> tuple[float, float]:
    """Mean silhouette and Davies-Bouldin index: two scans, one for the sums."""
    stats = cluster_stats(df, label, vector)
    rows = with_center_distance(with_silhouette(df, label, vector, stats), vector, stats.centers, label, stats.clusters)
    figures = rows.groupBy(label).agg(F.sum("silhouette").alias("_sil"), F.avg("distance_to_center").alias("_s"))
    found = {r[0]: r for r in collect_small(figures, MAX_CLUSTERS, "cluster list")}
    silhouette = sum(r["_sil"] for r in found.values()) / stats.counts.sum()
    return float(silhouette), _worst_ratio(stats, np.array([found[c]["_s"] for c in stats.clusters]))


def _worst_ratio(stats: ClusterStats, spread: np.ndarray) -> float:
    """Mean over clusters of the worst (S_i + S_j) / M_ij."""
    gaps = vectors.distance_matrix(stats.centers, stats.centers)
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = (spread[:, None] + spread[None, :]) / gaps
    ratio[~np.isfinite(ratio)] = 0.0
    np.fill_diagonal(ratio, 0.0)
    return float(ratio.max(axis=1).mean())


def davies_bouldin(df: DataFrame, label: str, vector: str) -> float:
    return quality(df, label, vector)[1]


def kmeans(df: DataFrame, vector: str, k: int, seed: int = SEED, max_iter: int = 20):
    """Fitted model and the table with its ``cluster`` column."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    data = df.withColumn("_features", array_to_vector(doubles))
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="_features", predictionCol="cluster").fit(data)
    return model, model.transform(data).drop("_features")


def hierarchical(df: DataFrame, vector: str, k: int, seed: int = SEED) -> DataFrame:
    """Top-down splits, the hierarchical method that scales with the rows."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    data = df.withColumn("_features", array_to_vector(doubles))
    model = BisectingKMeans(k=k, seed=seed, featuresCol="_features", predictionCol="cluster").fit(data)
    return model.transform(data).drop("_features")


def assign(df: DataFrame, vector: str, names: Sequence, centers: np.ndarray) -> DataFrame:
    """Nearest of fixed centres per row; ties go to the first.

    A vector that is null or of another length gets no cluster.
    """
    distances = vectors.scores_to(centers, "euclidean")(F.col(vector))
    least = F.array_min(F.col("_d"))
    return (
        df.withColumn("_d", distances)
        .withColumn("distance_to_center", _number(least))
        .withColumn("cluster", F.when(F.col("distance_to_center").isNotNull(), F.element_at(
            F.array(*[F.lit(c) for c in names]), F.array_position("_d", least).cast("int"))))
        .select(*df.columns, "cluster", "distance_to_center")
    )


def _starts(df: DataFrame, vector: str, key: str | None, k: int) -> np.ndarray:
    """Up to ``k`` centres, each the farthest from those before it, among the rows of the smallest key hashes."""
    name = F.col(key).cast("string") if key else F.to_json(F.struct(vector))
    rows = df.select(F.sha2(name, 256).alias("h"), vector).orderBy("h", vector).limit(START_ROWS).collect()
    points = np.array([r[1] for r in rows], dtype=float)
    chosen = [0]
    near = np.round(np.square(points - points[0]).sum(axis=1), DIGITS)
    while len(chosen) < min(k, len(points)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, np.round(np.square(points - points[chosen[-1]]).sum(axis=1), DIGITS))
    return points[chosen]


def _labels(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Nearest centre of each row; ties go to the first."""
    return np.round(np.square(vectors.distance_matrix(x, centers)), DIGITS).argmin(axis=1)


def _sums(df: DataFrame, vector: str, width: int, slots: int, values: Callable[[np.ndarray], list]) -> np.ndarray:
    """Sums over all rows of the (slots, rows of figures) pairs that ``values`` gives for a batch of vectors.

    A row of a ``weighed`` table, one of distinct vectors, counts as often as its ``_n`` says. A task
    hands on one row a slot, so what is summed does not grow with the rows.
    """
    times = F.col("_n") if "_n" in df.columns else F.lit(1)

    def add(batches):
        total = None
        for batch in batches:
            x = vectors.batch_matrix(batch.column(0), width)
            whole = ~np.isnan(x).any(axis=1)
            x, n = x[whole], np.asarray(batch.column(1), dtype=float)[whole, None]
            for at, figures in values(x) if len(x) else ():
                total = np.zeros((slots, figures.shape[1])) if total is None else total
                np.add.at(total, at, figures * n)
        if total is not None:
            used = np.flatnonzero((total != 0).any(axis=1))
            offsets = np.arange(0, len(used) * total.shape[1] + 1, total.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(total[used].ravel()))], names=["slot", "s"])

    parts = df.select(vector, times.cast("long").alias("_n")).mapInArrow(add, "slot int, s array<double>").select("slot", F.posexplode("s").alias("j", "x"))
    rows = parts.groupBy("slot", "j").agg(F.sum("x").alias("x")).collect()
    out = np.zeros((slots, max((r["j"] for r in rows), default=0) + 1))
    for r in rows:
        out[r["slot"], r["j"]] = r["x"]
    return out


def fit_all(df: DataFrame, vector: str, candidates: Sequence[int], key: str | None = None, rounds: int = ROUNDS,
            weighed: DataFrame | None = None) -> dict[int, np.ndarray]:
    """Centres of k-means for every candidate k; each round is one scan for all of them together.

    With the ``weighed`` vectors of the table the rounds scan these. The starts are nested: those of k are the first k of one farthest-first
    order. A cluster without rows keeps its centre; rounds end early once no
    centre moves.
    """
    starts = _starts(df, vector, key, max(candidates))
    fitted = {k: starts[:k].copy() for k in candidates}
    first = dict(zip(candidates, np.cumsum([0, *map(len, fitted.values())])))
    slots, width = sum(map(len, fitted.values())), starts.shape[1]
    for _ in range(rounds):

        def values(x, now=dict(fitted)):
            ones = np.column_stack([x, np.ones(len(x))])
            return [(first[k] + _labels(x, c), ones) for k, c in now.items()]

        sums = _sums(df if weighed is None else weighed, vector, width, slots, values)
        moved = False
        for k, centers in fitted.items():
            own = sums[first[k] : first[k] + len(centers)]
            new = np.where(own[:, width:] > 0, own[:, :width] / np.maximum(own[:, width:], 1), centers)
            moved |= not np.allclose(new, centers, rtol=0, atol=1e-12)
            fitted[k] = new
        if not moved:
            break
    return fitted


def score_all(df: DataFrame, vector: str, fitted: dict[int, np.ndarray], weighed: DataFrame | None = None) -> dict[int, tuple[float, float]]:
    """Mean squared silhouette and Davies-Bouldin index for each k: two scans for all, of the ``weighed`` vectors if given."""
    df = df if weighed is None else weighed
    first = dict(zip(fitted, np.cumsum([0, *map(len, fitted.values())])))
    slots, width = sum(map(len, fitted.values())), next(iter(fitted.values())).shape[1]

    def members(x):
        figures = np.column_stack([x, np.square(x).sum(axis=1), np.ones(len(x))])
        return [(first[k] + _labels(x, c), figures) for k, c in fitted.items()]

    sums = _sums(df, vector, width, slots, members)
    stats = {}
    for k, c in fitted.items():
        own = sums[first[k] : first[k] + len(c)]
        used = np.flatnonzero(own[:, -1])
        stats[k] = (used, ClusterStats(used.tolist(), own[used, -1], own[used, :width], own[used, width]))

    def quality_of(x):
        out = []
        for k, c in fitted.items():
            label = _labels(x, c)
            used, st = stats[k]
            place = np.searchsorted(used, label)
            away = np.sqrt(np.square(x - st.centers[place]).sum(axis=1))
            out.append((first[k] + label, np.column_stack([vectors.silhouettes(x, place, st.counts, st.sums, st.squares), away])))
        return out

    sums = _sums(df, vector, width, slots, quality_of)
    scores = {}
    for k, c in fitted.items():
        used, st = stats[k]
        own = sums[first[k] + used]
        scores[k] = (float(own[:, 0].sum() / st.counts.sum()), _worst_ratio(st, own[:, 1] / st.counts))
    return scores


def choose_k(df: DataFrame, vector: str, candidates: Sequence[int], by: str = "combined", key: str | None = None):
    """Best k and the score table, all candidates in the same scans.

    combined = silhouette - davies_bouldin / 10; the first maximum wins.
    Candidates that leave no row to spare are not tried.
    """
    best, table, _ = fitted_choice(df, vector, candidates, by, key)
    return best, table


def fitted_choice(df: DataFrame, vector: str, candidates: Sequence[int], by: str = "combined", key: str | None = None):
    """Best k, the score table and the centres of the best."""
    data = df.select(*([key] if key else []), F.col(vector).cast("array<double>").alias(vector))
    n = data.limit(max(candidates) + 1).count()
    tried = [k for k in candidates if k <= n - 1]
    fitted = fit_all(data, vector, tried, key) if tried else {}
    rows = [(k, sil, db, sil - db / 10.0) for k, (sil, db) in (score_all(data, vector, fitted).items() if tried else ())]
    table = df.sparkSession.createDataFrame(rows, "k int, silhouette double, davies_bouldin double, combined double")
    at = {"silhouette": 1, "combined": 3}[by]
    best = max(rows, key=lambda r: (r[at], -r[0]))[0] if rows else None
    return best, table, fitted.get(best)


def run_jointly(spark: SparkSession, work: Callable, items: Sequence, parallelism: int) -> list:
    """Results of independent Spark jobs in the order of their items."""
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))
