"""Joins and row-combining operators."""

from __future__ import annotations

import functools
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ospara.functions import vectors
from ospara.scale import MAX_BLOCK_ROWS, running_sums, unfold


def not_yet_in(df: DataFrame, done: DataFrame, key: str, done_key: str) -> DataFrame:
    return df.join(done.select(F.col(done_key).alias(key)), key, "left_anti")


def rule_matches(df: DataFrame, key: str, vector: str, names: Sequence, matrix: np.ndarray, threshold: float) -> DataFrame:
    """(key, rule, similarity) for each rule at or above the threshold.

    The rules are a small matrix; a row is scored against all of them in
    place, so neither a join nor a shuffle is needed.
    """
    known = F.array(*[F.lit(n) for n in names])
    scored = df.select(key, vectors.scores_to(matrix)(F.col(vector)).alias("_s"))
    pairs = F.arrays_zip(known.alias("rule"), F.col("_s").alias("similarity"))
    kept = F.filter(pairs, lambda p: p["similarity"] >= threshold)
    return unfold(scored, kept, "_p", [key]).select(
        key, F.col("_p.rule").alias("rule"), F.col("_p.similarity").alias("similarity")
    )


def nearest_candidate(value: Column, candidates: Sequence[int]) -> Column:
    """The candidate with the smallest distance; ties go to the smaller one."""
    options = F.array(*[F.struct(F.abs(value - k).alias("gap"), F.lit(k).alias("k")) for k in candidates])
    return F.array_min(options)["k"]


def append_rows(parts: Sequence[DataFrame]) -> DataFrame:
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def totals_before(
    anchors: DataFrame, events: DataFrame, key: str, ts: str, anchor_id: str, event_id: str, value: str, seconds: int,
    max_rows: int = MAX_BLOCK_ROWS,
) -> DataFrame:
    """Number and total of the events in the ``seconds`` before each anchor.

    A range join that only feeds an aggregate needs no pairs: each anchor sets
    a mark at both ends of its range, marks and events are summed along time
    once, and the difference of two marks is the answer. Anchors without any
    event are left out; values are summed as decimals, so differences are exact.
    """
    back = F.expr(f"interval {seconds} seconds")
    none = F.lit(None).cast("decimal(28,6)")
    marks = anchors.select(
        F.col(key), F.col(anchor_id).alias("_anchor"),
        F.explode(F.array(F.struct((F.col(ts) - back).alias("at"), F.lit(-1).alias("end")),
                          F.struct(F.col(ts).alias("at"), F.lit(1).alias("end")))).alias("_m"),
    ).select(key, F.col("_m.at").alias("_at"), F.col("_m.end").alias("_end"), "_anchor", none.alias("_v"))
    rows = events.select(
        F.col(key), F.col(ts).alias("_at"), F.lit(2).alias("_end"), F.col(event_id).alias("_anchor"),
        F.col(value).cast("decimal(28,6)").alias("_v"),
    )
    summed = running_sums(
        marks.unionByName(rows), [key], ["_at", "_end", "_anchor"],
        {"_n": F.when(F.col("_end") == 2, 1).otherwise(0), "_total": F.coalesce("_v", F.lit(0).cast("decimal(28,6)"))},
        max_rows,
    )
    ends = summed.filter("_end <> 2")
    return (
        ends.groupBy(F.col("_anchor").alias(anchor_id))
        .agg(F.sum(F.col("_n") * F.col("_end")).alias("before"),
             F.sum(F.col("_total") * F.col("_end")).cast("double").alias("total"))
        .filter("before > 0")
    )
