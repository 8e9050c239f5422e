"""Quality classifier: a linear model over n-gram indicators scaled by naive Bayes ratios.

Features are the byte trigrams that a text contains, hashed to ``2**BITS``
places. Each is scaled by the log ratio of its smoothed shares in the two
classes, counted over all labelled training rows; a text's vector then has
length one. A support vector machine with hinge loss is fitted by dual
coordinate descent on at most ``SAMPLE_ROWS`` training rows, those with the
smallest hash of doc_id, and a logistic curve turns its margin into a score.

Only the text is an input of a score. The model has a fixed size.

Defined results: null, empty and very short texts have no trigram and get the
score of the bias alone; a row labelled twice trains twice; labels that are
null or not 0 or 1 are ignored; with labels of one class or none every score
is the smoothed share of label 1; a null doc_id is held out never; other
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ospara.llm.graph import written
from ospara.llm.texts import raw, slices

BITS = 18
#: Bound of the rows that the machine is fitted on.
SAMPLE_ROWS = 16_000
FOLDS = 5
THRESHOLD = 0.3
COST = 1.0
EPOCHS = 12


def held_out(doc_id: Column) -> Column:
    """True for the rows whose labels are never learned."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def features(text: bytes, bits: int = BITS) -> np.ndarray:
    """Sorted distinct places of the text's trigrams."""
    b = np.frombuffer(text, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int32)
    codes = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    codes *= np.uint32(2654435761)
    return np.unique(codes >> np.uint32(32 - bits)).astype(np.int32)


@dataclass(frozen=True)
class Model:
    """``weights`` hold machine weight times ratio, ``squares`` the squared ratios."""

    weights: np.ndarray
    squares: np.ndarray
    bias: float
    slope: float
    offset: float

    def margin(self, found: np.ndarray) -> float:
        norm = float(self.squares[found].sum(dtype=np.float64)) ** 0.5
        return (float(self.weights[found].sum(dtype=np.float64)) / norm if norm else 0.0) + self.bias

    def score(self, found: np.ndarray) -> float:
        return float(1.0 / (1.0 + np.exp(np.clip(-(self.slope * self.margin(found) + self.offset), -40, 40))))


def ratios(ones: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """Log ratio of the smoothed shares of each indicator in the classes."""
    p, q = ones + 1.0, zeros + 1.0
    return np.log(p / p.sum()) - np.log(q / q.sum())


def descend(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, cost: float = COST, epochs: int = EPOCHS):
    """Weights and bias of a hinge-loss machine by dual coordinate descent.

    The rarer class has its cost raised to the weight of the other.
    """
    y = np.where(labels > 0, 1.0, -1.0)
    share = np.array([(y < 0).sum(), (y > 0).sum()])
    limit = np.where(y > 0, cost * share.max() / share[1], cost * share.max() / share[0])
    values = []
    for found in rows:
        v = ratio[found]
        norm = np.sqrt((v * v).sum())
        values.append(v / norm if norm else v)
    norms = np.array([(v * v).sum() + 1.0 for v in values])
    w, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    order = np.random.default_rng(0)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            slope = y[i] * (w[rows[i]] @ values[i] + bias) - 1.0
            new = min(max(alpha[i] - slope / norms[i], 0.0), limit[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w, bias


def logistic(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve through the margins, with smoothed targets."""
    ones, zeros = int((labels > 0).sum()), int((labels == 0).sum())
    target = np.where(labels > 0, (ones + 1.0) / (ones + 2.0), 1.0 / (zeros + 2.0))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    at = np.array([1.0, np.log((ones + 1.0) / (zeros + 1.0))])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ at, -40, 40)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (target - p))
        at = at + step
        if np.abs(step).max() < 1e-9:
            break
    return float(at[0]), float(at[1])


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, bits: int = BITS) -> Model:
    """Fit on the labelled rows that are not held out."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    marked = marked.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    share = min(1.0, sample_rows / max(1, marked.count()))
    rank = F.xxhash64("doc_id")
    drawn = F.pmod(rank, F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = texts.join(marked.hint("merge"), "doc_id").select("text", "label", rank.alias("rank"), drawn.alias("drawn"))
    schema = pa.schema([("feature", pa.int32()), ("zeros", pa.int64()), ("ones", pa.int64()),
                        ("rank", pa.int64()), ("label", pa.int32()), ("features", pa.binary())])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, 1 << bits), np.int64)
        for batch in slices(batches, "text"):
            kept: list[list] = [[], [], []]
            for text, label, rank, drawn in zip(raw(batch.column("text")), *(
                    batch.column(c).to_pylist() for c in ("label", "rank", "drawn"))):
                found = features(text, bits)
                seen[label, found] += 1
                if drawn:
                    for values, value in zip(kept, (rank, label, found.tobytes())):
                        values.append(value)
            n = len(kept[0])
            yield pa.RecordBatch.from_arrays([
                *[pa.nulls(n, t) for t in (pa.int32(), pa.int64(), pa.int64())],
                pa.array(kept[0], pa.int64()), pa.array(kept[1], pa.int32()), pa.array(kept[2], pa.binary())], schema=schema)
        at = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays([
            pa.array(at, pa.int32()), pa.array(seen[0, at]), pa.array(seen[1, at]),
            *[pa.nulls(len(at), t) for t in (pa.int64(), pa.int32(), pa.binary())]], schema=schema)

    gathered, _ = written(
        joined.mapInArrow(gather, "feature int, zeros long, ones long, rank long, label int, features binary"), "gathered")
    counts = gathered.filter("feature is not null").groupBy("feature").agg(
        F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")).withColumn("one", F.lit(1))
    sample = gathered.filter("features is not null").select("rank", "label", "features", F.lit(1).alias("one"))
    total = gathered.filter("features is not null").groupBy("label").count().collect()
    n = {r["label"]: r["count"] for r in total}
    if len(n) < 2:
        prior = (n.get(1, 0) + 1.0) / (sum(n.values()) + 2.0)
        nothing = np.zeros(1 << bits, np.float32)
        return Model(nothing, nothing, 0.0, 0.0, float(np.log(prior / (1 - prior))))

    def fit(rows: pa.Table, counted: pa.Table) -> pa.Table:
        seen = np.zeros((2, 1 << bits))
        at = np.asarray(counted.column("feature"))
        seen[0, at], seen[1, at] = np.asarray(counted.column("zeros")), np.asarray(counted.column("ones"))
        ratio = ratios(seen[1], seen[0])
        order = sorted(range(rows.num_rows), key=lambda i, r=rows.column("rank").to_pylist(): r[i])[:sample_rows]
        found = [np.frombuffer(b, np.int32) for b in rows.column("features").to_pylist()]
        marks = np.asarray(rows.column("label"))
        found, marks = [found[i] for i in order], marks[order]
        w, bias = descend(found, marks, ratio)
        model = Model((w * ratio).astype(np.float32), (ratio * ratio).astype(np.float32), float(bias), 1.0, 0.0)
        slope, offset = logistic(np.array([model.margin(f) for f in found]), marks)
        return pa.table({
            "weights": pa.array([model.weights.tobytes()], pa.binary()), "squares": pa.array([model.squares.tobytes()], pa.binary()),
            "bias": [float(bias)], "slope": [slope], "offset": [offset]})

    row = sample.groupBy("one").cogroup(counts.groupBy("one")).applyInArrow(
        fit, "weights binary, squares binary, bias double, slope double, offset double").first()
    return Model(np.frombuffer(row["weights"], np.float32), np.frombuffer(row["squares"], np.float32),
                 row["bias"], row["slope"], row["offset"])


def scored(docs: DataFrame, model: Model, bits: int = BITS, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            scores = [model.score(features(t, bits)) for t in raw(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(score, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, model: Model, bits: int = BITS, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold; all columns stay."""

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array([model.score(features(t, bits)) for t in raw(text)], pa.float64())

    return docs.filter(score(F.col("text").cast("string")) >= threshold)
