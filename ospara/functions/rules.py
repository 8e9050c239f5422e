"""Rule tables compiled to column expressions: thresholds, buckets, lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the sensor rules: (column, comparison, limit, label, advice).
FAULT_RULES = (
    ("temperature", ">", 60.0, "Overheat", "Increase cooling, check fan/AC"),
    ("voltage", "<", 10.5, "Undervoltage", "Check supply line & transformer"),
    ("current", ">", 150.0, "Power Surge", "Inspect breakers & load"),
    ("current", "<", 80.0, "Low Power", "Check load distribution"),
)
NORMAL, NORMAL_ADVICE = "Normal", "No action needed"
# Device limits that mark a reading as abnormal.
MILK_LOW, MILK_HIGH, COW_TEMP_HIGH, FEED_LOW = 10.0, 32.0, 39.5, 8.0
# Allowed deviation from a baseline.
BASELINE_HIGH, BASELINE_LOW = 1.1, 0.9
# Fixed values of severity scoring.
SEVERITY_LIMITS = ((80.0, "S1"), (60.0, "S2"), (40.0, "S3"))
SEVERITY_FLOOR = "S4"
SIMILARITY_WEIGHT, RULE_WEIGHT = 0.4, 0.6
ENVIRONMENTS = {
    "prod": ("prod", 1.2), "production": ("prod", 1.2),
    "uat": ("uat", 1.0), "staging": ("uat", 1.0), "test": ("uat", 1.0),
    "dev": ("dev", 0.8), "development": ("dev", 0.8),
}
PRIORITIES = {"low": 1, "medium": 2, "high": 3}
# Categories of the two specific domains.
DOMAIN_CATEGORIES = {
    "technical": (
        "code", "architecture", "infrastructure", "data", "security", "api",
        "testing", "deployment", "documentation", "other",
    ),
    "business": (
        "sales", "marketing", "finance", "hr", "operations", "strategy",
        "product", "support", "other",
    ),
}


@dataclass(frozen=True)
class Limit:
    column: str
    comparison: str
    limit: float
    label: str
    advice: str = ""

    def condition(self) -> Column:
        c = F.col(self.column)
        return c > self.limit if self.comparison == ">" else c < self.limit


def limits(rows: Sequence[tuple]) -> list[Limit]:
    return [Limit(*row) for row in rows]


def first_match(rules: Sequence[tuple[Column, Column]], default: Column) -> Column:
    """The value of the first rule that holds, as one CASE."""
    case = F.when(*rules[0])
    for condition, value in rules[1:]:
        case = case.when(condition, value)
    return case.otherwise(default)


def fault_label(rules: Sequence[Limit]) -> Column:
    return first_match([(r.condition(), F.lit(r.label)) for r in rules], F.lit(NORMAL))


def fault_explanation(rules: Sequence[Limit]) -> dict[str, Column]:
    """Feature, value and advice behind the label of a reading."""
    hits = [(r.condition(), r) for r in rules]
    return {
        "feature": first_match([(c, F.lit(r.column)) for c, r in hits], F.lit("None")),
        "reading": first_match(
            [(c, F.col(r.column).cast("string")) for c, r in hits], F.lit("N/A")
        ),
        "advice": first_match([(c, F.lit(r.advice)) for c, r in hits], F.lit(NORMAL_ADVICE)),
    }


def deviation_flag(column: str, base: float) -> Column:
    c = F.col(column)
    off = (c > base * BASELINE_HIGH) | (c < base * BASELINE_LOW)
    return F.when(off, "Red").otherwise("Green")


def severity_bucket(score: Column) -> Column:
    return first_match(
        [(score >= limit, F.lit(level)) for limit, level in SEVERITY_LIMITS], F.lit(SEVERITY_FLOOR)
    )


def combined_score(similarity: Column, base: Column, factor: Column) -> Column:
    return similarity * 100 * SIMILARITY_WEIGHT + base * factor * RULE_WEIGHT


def learned_score(similarity: Column, adjusted: Column, factor: Column, weights: Mapping[str, float]) -> Column:
    return (
        F.lit(weights["bert_weight"]) * similarity
        + F.lit(weights["rule_weight"]) * adjusted
        + F.lit(weights["env_weight"]) * factor
        + F.lit(weights.get("intercept", 0.0))
    )


def environment_name(raw: Column) -> Column:
    low = F.lower(raw)
    return first_match(
        [(low == key, F.lit(name)) for key, (name, _) in ENVIRONMENTS.items()], F.lit("unknown")
    )


def environment_factor(raw: Column) -> Column:
    low = F.lower(raw)
    return first_match(
        [(low == key, F.lit(factor)) for key, (_, factor) in ENVIRONMENTS.items()], F.lit(1.0)
    )


def priority_of(severity: Column) -> Column:
    low = F.lower(severity)
    return first_match([(low == k, F.lit(v)) for k, v in PRIORITIES.items()], F.lit(1))


def domain_of(category: Column) -> Column:
    """Domain of a category; the technical list is looked at first."""
    low = F.lower(category)
    return first_match(
        [(low.isin(*names), F.lit(domain)) for domain, names in DOMAIN_CATEGORIES.items()],
        F.lit("general"),
    )


def toxicity_gate(score: Column, detect: float = 0.8, block: float = 0.9) -> Column:
    return F.when(score > block, "block").when(score >= detect, "log").otherwise("none")


def confidence_gate(
    domain: Column, domain_confidence: Column, category: Column, category_confidence: Column, limit: float = 0.7
) -> Column:
    sure = domain_confidence >= limit
    return F.struct(
        F.when(sure, domain).otherwise("unknown").alias("domain"),
        F.when(sure, category).otherwise("unknown").alias("category"),
        F.when(sure, F.least(domain_confidence, category_confidence))
        .otherwise(domain_confidence)
        .alias("confidence"),
    )


def reorder_quantity(current: Column, average: Column) -> dict[str, Column]:
    """Reorder below 1.2 times the mean demand; halves round to even."""
    threshold = average * 1.2
    low = current < threshold
    return {
        "threshold": threshold,
        "decision": F.when(low, "reorder").otherwise("hold"),
        "qty": F.when(low, F.greatest(F.lit(1), F.bround(threshold - current).cast("long"))).otherwise(
            F.lit(0).cast("long")
        ),
    }
