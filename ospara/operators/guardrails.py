"""Detection of sensitive content, masking, blocking and the audit rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ospara.functions.text import DetectionRule, found, java_pattern, masker
from ospara.scale import unfold


def detections(df: DataFrame, key: str, text: str, rules: Sequence[DetectionRule]) -> DataFrame:
    """One row per document and rule with matches: their values and number."""
    results = [
        F.struct(
            F.lit(r.name).alias("rule"), F.lit(r.content_type).alias("content_type"),
            F.lit(r.action).alias("action"), F.lit(1.0).alias("confidence"), found(text, r).alias("matches"),
        )
        for r in rules
    ]
    hits = F.filter(F.array(*results), lambda r: F.size(r["matches"]) > 0)
    return unfold(df, hits, "_r", [key]).select(key, "_r.*")


def audit_rows(results: DataFrame, key: str) -> DataFrame:
    return results.select(
        key, "content_type", "action", "rule", F.size("matches").alias("num_matches"),
        F.get("matches", F.lit(0)).alias("sample_match"),
    )


def has_match(text: str, rules: Sequence[DetectionRule]) -> Column:
    hit = F.lit(False)
    for r in rules:
        hit = hit | F.col(text).rlike(java_pattern(r))
    return hit


def guard(
    df: DataFrame, text: str, rules: Sequence[DetectionRule], toxicity: Column | None = None,
    block_above: float = 0.9, mask_char: str = "*",
) -> DataFrame:
    """Add ``blocked`` and ``safe_text``: empty when blocked, else masked.

    Blocked texts are not masked.
    """
    blocked = has_match(text, [r for r in rules if r.action == "block"])
    if toxicity is not None:
        blocked = blocked | F.coalesce(toxicity > block_above, F.lit(False))
    masked = masker(rules, mask_char)(F.when(~F.col("blocked"), F.col(text)))
    return df.withColumn("blocked", blocked).withColumn(
        "safe_text", F.when(F.col("blocked"), F.lit("")).otherwise(masked)
    )


def split_blocked(guarded: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """Allowed rows with the safe text; blocked rows with the original text."""
    allowed = guarded.filter(~F.col("blocked")).withColumn(text, F.col("safe_text"))
    return allowed.drop("safe_text", "blocked"), guarded.filter("blocked").drop("safe_text", "blocked")
