"""Sweeps over preprocessing and cluster settings, and the feature table."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ospara.functions import vectors
from ospara.operators import clustering, features
from ospara.session import discard, materialize, written


def suggest(summary: str) -> dict:
    """Settings from a text report: k by the number of features, imputer by gaps."""
    found = re.search(r"(\d+) features", summary)
    n = int(found.group(1)) if found else 3
    gaps = "missing" in summary.lower() and re.search(r"\d+\.?\d*%", summary)
    return {"k": max(3, min(12, 2 * n)), "imputer": "knn" if gaps else "median", "scaler": "robust"}


def prepare(df: DataFrame, columns: Sequence[str], imputer: str, scaler: str) -> DataFrame:
    if imputer == "knn":
        filled = features.knn_impute(df, columns)
    elif imputer == "iterative":
        filled = features.iterative_impute(df, columns)
    else:
        filled = features.impute(df, columns, imputer)
    return features.scale(filled, columns, scaler)


def trial_centers(df: DataFrame, columns: Sequence[str], trial: Mapping, threshold: float = 0.95, key: str | None = None):
    """The table with its prepared and reduced features in ``_v``, the centres fitted on them, and the scores of one setting.

    Rows of equal features are one row with their number: few distinct readings
    shrink before the shuffle, and readings that are all different are written
    once in place of a cache.
    """
    scaled = prepare(df, columns, trial["imputer"], trial["scaler"])
    reduction = features.reduce(scaled, columns, threshold=threshold)
    names = [f"pca{j + 1}" for j in range(reduction.components)]
    reduced = lambda rows: reduction.apply(rows).withColumn("_v", F.array(*names)).drop(*names)
    distinct = scaled.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    weighed, path = written(reduced(distinct).select("_v", "_n"), "weighed")
    data = reduced(scaled)
    fitted = clustering.fit_all(data, "_v", [trial["k"]], key, weighed=weighed)
    sil, db = clustering.score_all(data, "_v", fitted, weighed=weighed)[trial["k"]]
    discard(df.sparkSession, path)
    return data, fitted[trial["k"]], {**trial, "silhouette": sil, "db": db, "combined": sil - db / 10.0}


def run_trial(df: DataFrame, columns: Sequence[str], trial: Mapping, threshold: float = 0.95, key: str | None = None):
    """One setting end to end: the labelled table and its scores."""
    data, centers, scores = trial_centers(df, columns, trial, threshold, key)
    return clustering.assign(data, "_v", list(range(len(centers))), centers).drop("_v"), scores


def sweep(df: DataFrame, columns: Sequence[str], trials: Sequence[Mapping], parallelism: int = 3, threshold: float = 0.95,
          key: str | None = None) -> DataFrame:
    """History of all trials, best first; the loop runs over settings only.

    With a ``key`` column the starts, and so the scores, follow the key alone.
    """
    runs = clustering.run_jointly(df.sparkSession, lambda t: run_trial(df, columns, t, threshold, key)[1], trials, parallelism)
    history = [{"iteration": i, **r} for i, r in enumerate(runs)]
    ddl = "iteration int, k int, imputer string, scaler string, silhouette double, db double, combined double"
    names = [p.split()[0] for p in ddl.split(", ")]
    table = df.sparkSession.createDataFrame([tuple(h[n] for n in names) for h in history], ddl)
    return table.orderBy(F.desc("combined"), "iteration")


def rerun_best(df: DataFrame, columns: Sequence[str], history: DataFrame, threshold: float = 0.95, key: str | None = None) -> DataFrame:
    """The table with the clusters of the best setting of a sweep, written once more in full."""
    best = history.orderBy(F.desc("combined"), "iteration").first()
    labelled, _ = run_trial(df, columns, {n: best[n] for n in ("k", "imputer", "scaler")}, threshold, key)
    return materialize(labelled, "best-setting")


def feature_table(df: DataFrame, columns: Sequence[str], categorical: Sequence[str], k: int) -> DataFrame:
    """Numerics, one-hot flags, cluster, distance to the centre and two components."""
    scaled = features.preprocess(df.withColumns({f"_z_{c}": F.col(c) for c in columns}), [f"_z_{c}" for c in columns])
    reduction = features.reduce(scaled, [f"_z_{c}" for c in columns], n=min(2, len(columns)))
    reduced = reduction.apply(scaled, "pca").withColumn("_v", F.array(*[f"_z_{c}" for c in columns]))
    model, labelled = clustering.kmeans(reduced, "_v", k)
    centers = vectors.np.array(model.clusterCenters())
    out = clustering.with_center_distance(labelled, "_v", centers)
    return features.one_hot(out.drop("_v", *[f"_z_{c}" for c in columns]), categorical)
