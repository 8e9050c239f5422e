"""Imputing, scaling, encoding and reducing numeric features."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA, IndexToString, StringIndexerModel, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ospara.functions import vectors
from ospara.operators import imputing, profile
from ospara.scale import collect_small
from ospara.session import materialize

MAX_CATEGORIES = 1_000


def imputing_values(df: DataFrame, columns: Sequence[str], strategy: str) -> dict[str, float]:
    """The value that replaces a gap, per column: one row of figures."""
    if strategy == "median":
        rows = profile.quantiles(df, columns, [0.5]).select("feature", F.col("quantiles")[0].alias("v"))
    elif strategy == "mean":
        rows = df.agg(*[F.avg(c).alias(c) for c in columns]).unpivot([], list(columns), "feature", "v")
    elif strategy == "most_frequent":
        rows = profile.modes(df, columns).select("feature", F.col("mode").alias("v"))
    else:
        raise ValueError(f"unknown imputer: {strategy}")
    return {r["feature"]: r["v"] for r in rows.collect() if r["v"] is not None}


def fill(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in values.items()})


def impute(df: DataFrame, columns: Sequence[str], strategy: str = "median") -> DataFrame:
    return fill(df, imputing_values(df, columns, strategy))


def scaling_values(df: DataFrame, columns: Sequence[str], method: str) -> dict[str, tuple[float, float]]:
    """Offset and divisor per column; a zero divisor becomes 1."""
    if method == "standard":
        parts = {c: (F.avg(c), F.stddev_pop(c)) for c in columns}
    elif method == "minmax":
        parts = {c: (F.min(c).cast("double"), (F.max(c) - F.min(c)).cast("double")) for c in columns}
    elif method == "robust":
        rows = profile.quantiles(df, columns, [0.25, 0.5, 0.75]).collect()
        found = {r["feature"]: (r["quantiles"][1], r["quantiles"][2] - r["quantiles"][0]) for r in rows}
        return {c: (m, s or 1.0) for c, (m, s) in found.items()}
    elif method == "none":
        return {c: (0.0, 1.0) for c in columns}
    else:
        raise ValueError(f"unknown scaler: {method}")
    row = df.agg(*[F.struct(a, b).alias(c) for c, (a, b) in parts.items()]).first()
    return {c: (row[c][0], row[c][1] or 1.0) for c in columns}


def rescale(df: DataFrame, values: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in values.items()})


def scale(df: DataFrame, columns: Sequence[str], method: str = "robust") -> DataFrame:
    return rescale(df, scaling_values(df, columns, method))


def preprocess(df: DataFrame, columns: Sequence[str], imputer: str = "median", scaler: str = "robust") -> DataFrame:
    """Gaps filled and columns scaled; medians and quartiles share their scans where a column has no gaps."""
    if (imputer, scaler) != ("median", "robust"):
        return scale(impute(df, columns, imputer), columns, scaler)
    rows = profile.quantiles(df, columns, [0.25, 0.5, 0.75]).select("feature", *[F.col("quantiles")[i].alias(f"q{i}") for i in range(3)])
    found = {r["feature"]: (r["q0"], r["q1"], r["q2"]) for r in rows.collect() if r["q1"] is not None}
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    filled = fill(df, {c: q[1] for c, q in found.items()})
    values = {c: (m, high - low or 1.0) for c, (low, m, high) in found.items() if not gaps[c]}
    left = [c for c in columns if c not in values]
    return rescale(filled, values | (scaling_values(filled, left, "robust") if left else {}))


def iterative_impute(df: DataFrame, columns: Sequence[str], rounds: int = 10, tolerance: float = 1e-3) -> DataFrame:
    """Round-robin regressions: each column from the others, until stable.

    Only the coefficients live on the driver. They are applied as expressions
    on the original table, so a round costs one fit per column with gaps.
    """
    means = imputing_values(df, columns, "mean")
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first().asDict()
    todo = sorted((c for c in columns if gaps[c]), key=lambda c: gaps[c])
    coefficients: dict[str, tuple[float, np.ndarray]] = {}
    filled = _regressed(df, columns, means, todo, [])
    for _ in range(rounds):
        change = 0.0
        history = []
        for c in todo:
            others = [o for o in columns if o != c]
            known = filled.filter(F.col(f"_raw_{c}").isNotNull())
            data = VectorAssembler(inputCols=others, outputCol="_x").transform(known)
            model = LinearRegression(featuresCol="_x", labelCol=c, solver="normal", regParam=1e-9).fit(data)
            new = (model.intercept, model.coefficients.toArray())
            old = coefficients.get(c)
            change = max(change, np.inf if old is None else float(np.abs(np.append(new[1] - old[1], 0)).max()))
            coefficients[c] = new
            history.append((c, others, *new))
            filled = _regressed(df, columns, means, todo, history)
        if change < tolerance:
            break
    return filled.drop(*[f"_raw_{c}" for c in columns])


def _regressed(df, columns, means, todo, steps) -> DataFrame:
    out = df.withColumns({f"_raw_{c}": F.col(c).cast("double") for c in columns})
    out = fill(out, {c: means[c] for c in columns})
    for c, others, intercept, weights in steps:
        value: Column = F.lit(float(intercept))
        for o, w in zip(others, weights):
            value = value + F.col(o) * F.lit(float(w))
        out = out.withColumn(c, F.coalesce(F.col(f"_raw_{c}"), value))
    return out


DONORS_PER_BLOCK = 8192


def knn_impute(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    """Mean of the ``k`` nearest rows that have the value.

    Distances are Euclidean over the columns both rows have, scaled up to all
    columns and compared to nine places; ties go to the smaller value. Rows
    with equal features are one donor with a weight, and share one answer. A
    row meets only the blocks of donors that bounds do not rule out
    (``imputing``). Without any neighbour the mean is used.
    """
    raw = [f"_k_{c}" for c in columns]
    keyed = df.withColumns({r: F.col(c).cast("double") for r, c in zip(raw, columns)})
    search = imputing.NearestRows(keyed.groupBy(*raw).agg(F.count(F.lit(1)).alias("_n")), raw, k, DONORS_PER_BLOCK)
    answers = search.answers().groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("column", "answer"))).alias("_f"))
    given = [F.col("v")[i].alias(f"_g_{c}") for i, c in enumerate(columns)]
    found = materialize(search.rows.join(answers, "id").select(*given, "_f"), "nearest")
    search.discard()
    match = F.lit(True)
    for r, c in zip(raw, columns):
        match = match & F.col(r).eqNullSafe(F.col(f"_g_{c}"))
    means = imputing_values(df, columns, "mean")
    joined = keyed.join(found, match, "left")
    return joined.withColumns({
        c: F.coalesce(r, F.try_element_at("_f", F.lit(i)), F.lit(means.get(c))) for i, (c, r) in enumerate(zip(columns, raw))
    }).select(*df.columns)


def categories(df: DataFrame, column: str) -> list[str]:
    rows = collect_small(df.select(column).filter(F.col(column).isNotNull()).distinct(), MAX_CATEGORIES, column)
    return sorted(r[0] for r in rows)


def one_hot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Boolean column per category, named column_value."""
    flags = [
        F.coalesce(F.col(c) == F.lit(v), F.lit(False)).alias(f"{c}_{v}") for c in columns for v in categories(df, c)
    ]
    return df.select(*[c for c in df.columns if c not in columns], *flags)


def decode_labels(model: StringIndexerModel, df: DataFrame, code: str) -> DataFrame:
    back = IndexToString(inputCol=code, outputCol=f"{code}_text", labels=model.labels)
    return back.transform(model.transform(df))


def _projector(means: np.ndarray, loadings: np.ndarray):
    @F.arrow_udf("array<double>")
    def project(v: pa.Array) -> pa.Array:
        scores = (vectors.batch_matrix(v, len(means)) - means) @ loadings
        offsets = np.arange(0, scores.size + 1, loadings.shape[1], dtype=np.int32)
        return pa.ListArray.from_arrays(offsets, pa.array(scores.ravel()))

    return project


class Reduction:
    """Centred principal components with a fixed sign per component."""

    def __init__(self, columns: Sequence[str], means: np.ndarray, loadings: np.ndarray, shares: np.ndarray):
        self.columns, self.means = list(columns), means
        self.loadings, self.shares = loadings, shares

    @property
    def components(self) -> int:
        return self.loadings.shape[1]

    def apply(self, df: DataFrame, prefix: str = "pca") -> DataFrame:
        """Scores beside the columns: one matrix product per Arrow batch; keys stay in the row."""
        names = [f"{prefix}{j + 1}" for j in range(self.components)]
        inputs = F.array(*[F.col(c).cast("double") for c in self.columns])
        scored = df.withColumn("_scores", _projector(self.means, self.loadings)(inputs))
        return scored.withColumns({n: F.col("_scores")[j] for j, n in enumerate(names)}).drop("_scores")

    def check(self, df: DataFrame) -> DataFrame:
        """(component, eigenvalue, share, residual, length, overlap) over the table, in one scan.

        The covariance of the columns with a score is the covariance matrix
        times the loading; ``residual`` is how far it is from the eigenvalue
        times the loading at most, ``overlap`` the largest product with another
        loading. A task hands on one sum per column and component.
        """
        means, loadings = self.means, self.loadings

        def products(batches):
            total = np.zeros((len(means) + 2, loadings.shape[1]))
            for batch in batches:
                x = vectors.batch_matrix(batch.column(0), len(means)) - means
                scores = x @ loadings
                total += np.vstack([x.T @ scores, [np.full(len(total[0]), float((x * x).sum()))], [np.full(len(total[0]), float(len(x)))]])
            yield pa.RecordBatch.from_arrays([pa.array(total.ravel().tolist())], names=["s"])

        inputs = F.array(*[F.col(c).cast("double") for c in self.columns]).alias("v")
        parts = df.select(inputs).mapInArrow(products, "s double").select("s", F.monotonically_increasing_id().alias("i"))
        size = (len(means) + 2) * loadings.shape[1]
        place = F.pmod(F.pmod("i", F.lit(1 << 33)), F.lit(size))
        rows = parts.groupBy(place.alias("j")).agg(F.sum("s").alias("s")).collect()
        sums = np.zeros(size)
        for r in rows:
            sums[r["j"]] = r["s"]
        sums = sums.reshape(len(means) + 2, -1)
        n = sums[-1, 0]
        image, whole = sums[:-2] / (n - 1), sums[-2, 0] / (n - 1)
        values = (image * loadings).sum(axis=0)
        inner = loadings.T @ loadings
        apart = np.abs(inner - np.diag(np.diag(inner))).max(axis=1)
        worst = np.abs(image - loadings * values).max(axis=0)
        out = [(j + 1, float(values[j]), float(values[j] / whole), float(worst[j]), float(np.sqrt(inner[j, j])), float(apart[j]))
               for j in range(self.components)]
        return df.sparkSession.createDataFrame(
            out, "component int, eigenvalue double, share double, residual double, length double, overlap double")

    def loading_rows(self) -> list[tuple[int, str, float]]:
        return [
            (j + 1, c, float(self.loadings[i, j])) for j in range(self.components) for i, c in enumerate(self.columns)
        ]


def reduce(df: DataFrame, columns: Sequence[str], n: int | None = None, threshold: float = 0.95) -> Reduction:
    """Fit components: ``n`` of them, or as many as reach the variance share.

    Spark does not centre, which leaves loadings unchanged (they come from the
    covariance) and only shifts the scores; ``apply`` centres.
    """
    data = VectorAssembler(inputCols=list(columns), outputCol="_x").transform(df).select("_x", *columns)
    model = PCA(k=len(columns), inputCol="_x", outputCol="_y").fit(data)
    shares = model.explainedVariance.toArray()
    loadings = model.pc.toArray()
    if n is None:
        reached = np.flatnonzero(np.cumsum(shares) >= threshold - 1e-12)
        n = int(reached[0]) + 1 if len(reached) else len(columns)
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(loadings.shape[1])])
    loadings = loadings * np.where(signs == 0, 1, signs)
    means = df.agg(*[F.avg(c) for c in columns]).first()
    return Reduction(columns, np.array(means, dtype=float), loadings[:, :n], shares[:n])


def vector_columns(df: DataFrame, vector: str, n: int, prefix: str = "f") -> DataFrame:
    return df.select("*", *[F.col(vector)[i].cast("double").alias(f"{prefix}{i}") for i in range(n)])
