"""Grouped summaries of scored, queued and monitored records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Weight of a vote by the role of the voter.
ROLE_WEIGHTS = {"technical": 1.0, "business": 1.0, "legal": 1.0, "context": 1.2, "consensus": 1.5}


def severity_summary(df: DataFrame, level: str, scores: Sequence[str], pattern: str) -> DataFrame:
    return (
        df.groupBy(level)
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.avg(s).alias(f"avg_{s}") for s in scores],
            F.count_distinct(pattern).alias("patterns"),
        )
        .orderBy(F.desc(f"avg_{scores[-1]}"))
    )


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column], group: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*group).agg(*[F.count_if(c).alias(n) for n, c in conditions.items()])


def stacked_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Value counts of several columns as (dimension, item, n), nulls left out."""
    long = df.select(*columns).unpivot([], list(columns), "dimension", "item")
    return long.filter("item is not null").groupBy("dimension", "item").agg(F.count(F.lit(1)).alias("n"))


def consensus(votes: DataFrame, key: str, position: str = "position") -> DataFrame:
    """Weighted vote per key: (domain, category, confidence).

    Equal totals (to nine places, as sums arrive in any order) go to the choice
    voted for first. A row without a category is
    a key without votes: it becomes unknown with confidence 0.
    """
    weights = F.create_map(*[F.lit(x) for kv in ROLE_WEIGHTS.items() for x in kv])
    weight = F.coalesce(F.element_at(weights, F.col("role")), F.lit(1.0)) * F.col("confidence")
    totals = votes.groupBy(key, "domain", "category").agg(
        F.sum(weight).alias("_w"), F.min(position).alias("_first")
    )
    winner = F.max_by(
        F.struct("domain", "category", "_w"),
        F.when(F.col("category").isNotNull(), F.struct(F.round("_w", 9), -F.col("_first"))),
    )
    best = totals.groupBy(key).agg(winner.alias("_best"), F.sum("_w").alias("_total"))
    return best.select(
        key,
        F.coalesce("_best.domain", F.lit("unknown")).alias("domain"),
        F.coalesce("_best.category", F.lit("unknown")).alias("category"),
        F.coalesce(F.try_divide("_best._w", "_total"), F.lit(0.0)).alias("confidence"),
    )


def best_vote(votes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Vote with the highest confidence; ties go to the earlier method."""
    best = F.max_by(F.struct(*columns), F.struct("confidence", -F.col("method_order")))
    return votes.groupBy(key).agg(best.alias("_b")).select(key, "_b.*")


def deviating_feature(df: DataFrame, cluster: str, features: Sequence[str]) -> DataFrame:
    """Per cluster the feature whose mean is farthest from the overall mean."""
    sums = df.groupBy(cluster).agg(
        *[F.sum(c).alias(f"_s_{c}") for c in features], *[F.count(c).alias(f"_n_{c}") for c in features]
    )
    whole = Window.partitionBy()
    overall = {c: F.sum(f"_s_{c}").over(whole) / F.sum(f"_n_{c}").over(whole) for c in features}
    gaps = sums.select("*", *[g.alias(f"_g_{c}") for c, g in overall.items()]).select(
        cluster,
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("feature"),
                        (F.col(f"_s_{c}") / F.col(f"_n_{c}")).alias("mean"),
                        (F.col(f"_s_{c}") / F.col(f"_n_{c}") - F.col(f"_g_{c}")).alias("gap"),
                    )
                    for c in features
                ]
            )
        ).alias("_f"),
    ).select(cluster, "_f.*")
    order = Window.partitionBy(cluster).orderBy(F.abs("gap").desc(), "feature")
    return gaps.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")
