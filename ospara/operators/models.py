"""Trained models: anomaly, severity and weight learning, and their reports."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ospara.scale import fine
from ospara.session import materialize

SEED = 42
# Target score of each severity level.
LEVEL_SCORES = {"S1": 100.0, "S2": 75.0, "S3": 50.0, "S4": 25.0}
#: Rows of one task of a forest's fit, which keeps a number per tree with each.
FOREST_ROWS = 1 << 18


def anomaly_model(df: DataFrame, columns: Sequence[str], label: str, trees: int = 200, seed: int = SEED) -> PipelineModel:
    """Median imputer and random forest; transform adds ``prediction`` and ``probability``.

    Rows with gaps are kept: a gap counts as the column's median. Trees split
    on order alone, so columns are not scaled.
    """
    filled = [f"_filled_{c}" for c in columns]
    stages = [
        Imputer(inputCols=list(columns), outputCols=filled, strategy="median"),
        VectorAssembler(inputCols=filled, outputCol="features", handleInvalid="keep"),
        RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees, seed=seed),
    ]
    return Pipeline(stages=stages).fit(fine(df.select(*columns, label), FOREST_ROWS))


def class_probability(scored: DataFrame) -> DataFrame:
    return scored.withColumn("confidence", F.array_max(vector_to_array("probability")))


def vector_classifier(df: DataFrame, vector: str, label: str, trees: int = 100, seed: int = SEED) -> PipelineModel:
    """Random forest on stored vectors (column ``features``)."""
    return Pipeline(
        stages=[RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees, seed=seed)]
    ).fit(as_features(df, vector))


def as_features(df: DataFrame, vector: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.transform(vector, lambda x: x.cast("double"))))


def severity_model(df: DataFrame, columns: Sequence[str], level: str, seed: int = SEED):
    """Multinomial logistic model on an 80/20 split.

    Returns the fitted stages and the scored hold-out. The penalty equals an
    inverse strength of 1 per row, on scaled inputs. Both parts are written, as
    each stage would make its part of the split anew; the fit, which scans its
    rows up to a hundred times, takes equal rows once with their number.
    """
    train, test = (materialize(part, "split") for part in df.randomSplit([0.8, 0.2], seed))
    weighed = materialize(train.groupBy(*columns, level).agg(F.count(F.lit(1)).alias("_n")), "weighed")
    n = train.count()
    indexer = StringIndexer(inputCol=level, outputCol="label", stringOrderType="alphabetAsc").fit(weighed)
    assembler = VectorAssembler(inputCols=list(columns), outputCol="_raw")
    scaler = StandardScaler(inputCol="_raw", outputCol="features", withMean=True).fit(assembler.transform(train))
    logistic = LogisticRegression(
        family="multinomial", regParam=1.0 / max(n, 1), standardization=False, maxIter=100, weightCol="_n")
    fit = logistic.fit(PipelineModel(stages=[indexer, assembler, scaler]).transform(weighed))
    model = PipelineModel(stages=[indexer, assembler, scaler, fit])
    return model, model.transform(test)


def mean_importance(model: PipelineModel, columns: Sequence[str]) -> dict[str, float]:
    weights = abs(model.stages[-1].coefficientMatrix.toArray()).mean(axis=0)
    return dict(zip(columns, (float(w) for w in weights)))


def classification_report(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, from confusion counts."""
    cells = scored.groupBy(F.col(actual).alias("a"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    as_class = F.explode(
        F.array(
            F.struct(F.col("a").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("called")),
            F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("called")),
        )
    )
    hit = F.when(F.col("a") == F.col("p"), F.col("n")).otherwise(0)
    rows = cells.select(hit.alias("hit"), as_class.alias("c")).select("c.*", (F.col("hit") / 2).alias("hit"))
    sums = rows.groupBy("class").agg(
        F.sum("hit").alias("tp"), F.sum("support").alias("support"), F.sum("called").alias("called")
    )
    precision = F.coalesce(F.try_divide("tp", "called"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("tp", "support"), F.lit(0.0))
    return (
        sums.withColumn("precision", precision)
        .withColumn("recall", recall)
        .withColumn("f1", F.coalesce(
            F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))
        .select("class", "precision", "recall", "f1", "support")
    )


def learn_weights(df: DataFrame, columns: Sequence[str], level: str):
    """Least squares of the level's score on the features; returns the model."""
    scores = F.create_map(*[x for k, v in LEVEL_SCORES.items() for x in (F.lit(k), F.lit(v))])
    data = VectorAssembler(inputCols=list(columns), outputCol="features").transform(
        df.withColumn("_target", F.element_at(scores, F.col(level)))
    )
    return LinearRegression(featuresCol="features", labelCol="_target", solver="normal").fit(data)


def learn_one_weight(df: DataFrame, column: str, level: str) -> DataFrame:
    scores = F.create_map(*[x for k, v in LEVEL_SCORES.items() for x in (F.lit(k), F.lit(v))])
    target = F.element_at(scores, F.col(level))
    return df.agg(
        F.regr_slope(target, F.col(column)).alias("weight"), F.regr_intercept(target, F.col(column)).alias("intercept")
    )


def nearest_class(df: DataFrame, columns: Sequence[str], level: str) -> Column:
    """A classifier as an expression: the class whose mean is nearest in units of each column's deviation.

    One aggregate gives a mean per class and column, as few figures as there
    are classes; ties, to nine places, go to the smaller class.
    """
    figures = [f for c in columns for f in (F.avg(c).alias(c), F.stddev_pop(c).alias(f"_w_{c}"))]
    found = df.rollup(level).agg(*figures, F.grouping(level).alias("_all")).orderBy(level).collect()
    means = [r for r in found if not r["_all"]]
    widths = next(({c: r[f"_w_{c}"] for c in columns} for r in found if r["_all"]), {})
    cases = []
    for row in means:
        gaps = [(F.col(c) - F.lit(row[c])) / F.lit(widths[c] or 1.0) for c in columns]
        cases.append(F.struct(F.round(sum((g * g for g in gaps), F.lit(0.0)), 9).alias("d"), F.lit(row[level]).alias("level")))
    return F.array_min(F.array(*cases))["level"]


def logistic_expression(model: PipelineModel, columns: Sequence[str]) -> Column:
    """The class of a fitted ``severity_model`` as one expression: the largest linear score."""
    labels, scaler, fit = model.stages[0].labels, model.stages[2], model.stages[-1]
    weights = fit.coefficientMatrix.toArray() / np.where(scaler.std.toArray() > 0, scaler.std.toArray(), 1.0)
    offsets = fit.interceptVector.toArray() - weights @ scaler.mean.toArray()
    cases = [
        F.struct((-sum((F.col(c) * F.lit(float(w)) for c, w in zip(columns, row)), F.lit(float(b)))).alias("s"), F.lit(k).alias("k"))
        for k, (row, b) in enumerate(zip(weights, offsets))
    ]
    return F.get(F.array(*[F.lit(x) for x in labels]), F.array_min(F.array(*cases))["k"])


def tree_expression(node, value) -> Column:
    """``value`` of the leaf that a row of ``features`` falls into; an inner node becomes one CASE."""
    if node.numDescendants() == 0:
        return F.lit(float(value(node)))
    split = node.split()
    goes_left = F.get("features", F.lit(split.featureIndex())) <= F.lit(float(split.threshold()))
    return F.when(goes_left, tree_expression(node.leftChild(), value)).otherwise(tree_expression(node.rightChild(), value))


def forest_expression(model) -> Column:
    """Probability of class 1 by a fitted forest over an array column ``features``: the mean of its trees' leaf shares."""
    def share(node) -> float:
        stats = list(node.impurityStats().stats())
        return stats[1] / sum(stats)

    trees = [tree_expression(t._call_java("rootNode"), share) for t in model.trees]
    return sum(trees[1:], trees[0]) / F.lit(float(len(trees)))


def save_and_load(model: PipelineModel, path: str) -> PipelineModel:
    model.write().overwrite().save(path)
    return PipelineModel.load(path)
