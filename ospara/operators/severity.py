"""Severity of incident records from rules, texts and vectors."""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ospara.functions import rules, vectors
from ospara.functions.text import matched_keywords
from ospara.scale import broadcast_if_small
from ospara.session import materialize

# Size of a text's word vector.
WORD_BUCKETS = 256
# Similarity from which a rule counts as matched.
SIMILARITY_THRESHOLD = 0.65
TOP_MATCHES = 3
# Scores of a record without a match.
NO_MATCH = ("S4", 0.0, 10.0, 10.0)
# Patterns and weight per tier, most severe first.
TIERS = {
    "critical": (1.0, (
        "system down", "service unavailable", "data loss", "security breach", "critical failure",
        "system crash", "complete outage", "data corruption", "ssl certificate expired",
        "authentication failure", "database corruption", "memory exhaustion", "deadlock detected",
    )),
    "high": (0.8, (
        "performance degradation", "high latency", "partial outage", "error rate increase",
        "resource exhaustion", "api failure", "database performance", "memory leak",
        "network connectivity", "threshold breach",
    )),
    "medium": (0.6, (
        "warning", "slow response", "minor disruption", "intermittent issue", "resource pressure",
        "configuration change", "service degradation",
    )),
    "low": (0.4, (
        "informational", "routine", "scheduled maintenance", "minor issue", "update completed",
        "automatic recovery",
    )),
}
# Pattern, severity level, base score, category, environment.
SEVERITY_RULES = (
    ("complete system failure", "S1", 100, "availability", "prod"),
    ("data corruption detected", "S1", 95, "data", "prod"),
    ("security breach detected", "S1", 100, "security", "prod"),
    ("production database failure", "S1", 95, "database", "prod"),
    ("ssl certificate expired", "S1", 90, "security", "prod"),
    ("memory exhaustion", "S1", 95, "resource", "prod"),
    ("authentication system down", "S1", 95, "security", "prod"),
    ("critical api gateway failure", "S1", 90, "network", "prod"),
    ("test environment down", "S1", 85, "availability", "uat"),
    ("integration test failure", "S1", 85, "testing", "uat"),
    ("uat database corruption", "S1", 85, "database", "uat"),
    ("development environment crash", "S1", 80, "availability", "dev"),
    ("source control system down", "S1", 80, "tools", "dev"),
    ("partial system outage", "S2", 75, "availability", "prod"),
    ("high latency detected", "S2", 75, "performance", "prod"),
    ("database performance degradation", "S2", 75, "database", "prod"),
    ("elevated error rate", "S2", 70, "reliability", "prod"),
    ("network connectivity issues", "S2", 70, "network", "prod"),
    ("memory leak detected", "S2", 70, "resource", "prod"),
    ("test pipeline failure", "S2", 65, "testing", "uat"),
    ("integration error", "S2", 65, "testing", "uat"),
    ("performance test failure", "S2", 65, "performance", "uat"),
    ("build pipeline failure", "S2", 60, "build", "dev"),
    ("development database issue", "S2", 60, "database", "dev"),
    ("minor service degradation", "S3", 55, "performance", "prod"),
    ("increased response time", "S3", 50, "performance", "prod"),
    ("warning threshold reached", "S3", 50, "monitoring", "prod"),
    ("resource utilization high", "S3", 50, "resource", "prod"),
    ("test warning", "S3", 45, "testing", "uat"),
    ("development warning", "S3", 40, "development", "dev"),
    ("informational alert", "S4", 20, "info", "prod"),
    ("scheduled maintenance", "S4", 15, "maintenance", "prod"),
    ("minor configuration change", "S4", 20, "config", "prod"),
    ("routine operation", "S4", 10, "operations", "prod"),
    ("test information", "S4", 10, "testing", "uat"),
    ("development notification", "S4", 10, "development", "dev"),
)


def word_slots(text: Column, buckets: int = WORD_BUCKETS) -> Column:
    """The buckets of a text's lower-case words in order, each word in the one that its MD5 names."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([a-z0-9]+)"), F.lit(1))
    return F.array_sort(F.transform(words, lambda w: F.conv(F.substring(F.md5(w), 1, 6), 16, 10).cast("int") % buckets))


def _squares(slots: Column) -> Column:
    """Sum of the squared counts of equal neighbours: a run of r adds 2r - 1 with its last member."""
    empty = F.struct(F.lit(-1).alias("last"), F.lit(0).alias("run"), F.lit(0).cast("long").alias("sum"))

    def step(a: Column, x: Column) -> Column:
        run = F.when(a["last"] == x, a["run"] + 1).otherwise(1)
        return F.struct(x.alias("last"), run.alias("run"), (a["sum"] + 2 * run - 1).cast("long").alias("sum"))

    return F.aggregate(slots, empty, step, lambda a: a["sum"])


def text_scores(patterns: Sequence[str], buckets: int = WORD_BUCKETS):
    """Function of a text column: its cosines with each pattern as hashed word vectors, to nine places."""
    counts = []
    for p in patterns:
        own = [0] * buckets
        for word in re.findall("[a-z0-9]+", p.lower()):
            own[int(hashlib.md5(word.encode()).hexdigest()[:6], 16) % buckets] += 1
        counts.append({"n": math.sqrt(sum(c * c for c in own)), "c": own})
    known = F.from_json(F.lit(json.dumps(counts)), "array<struct<n: double, c: array<int>>>")

    def cosines(slots: Column) -> Column:
        norm = F.sqrt(_squares(slots))
        dot = lambda p: F.aggregate(slots, F.lit(0), lambda s, x: s + F.get(p["c"], x))
        return F.transform(known, lambda p: F.round(F.coalesce(F.try_divide(dot(p), norm * p["n"]), F.lit(0.0)), 9))

    # A one-element array binds the words, so that they are made once and not for every pattern.
    return lambda text: F.get(F.transform(F.array(word_slots(text, buckets)), cosines), F.lit(0))


def with_matches(
    df: DataFrame, vector: str | None, names: Sequence, matrix: np.ndarray | None, threshold: float = SIMILARITY_THRESHOLD,
    scores: Column | None = None,
) -> DataFrame:
    """Add ``matches``: rules at or above the threshold, best first.

    Similarities are cosines of ``vector`` with ``matrix``, or given as
    ``scores``. Equal similarities put the smaller rule name first.
    """
    known = F.array(*[F.lit(n) for n in names])
    pairs = F.arrays_zip(known.alias("rule"), F.col("_scores").alias("similarity"))
    kept = F.filter(pairs, lambda p: p["similarity"] >= threshold)
    by_score = F.array_sort(
        kept,
        lambda a, b: F.when(a["similarity"] > b["similarity"], -1)
        .when(a["similarity"] < b["similarity"], 1)
        .when(a["rule"] < b["rule"], -1)
        .otherwise(1),
    )
    found = scores if scores is not None else vectors.scores_to(matrix)(F.col(vector))
    return df.withColumn("_scores", found).withColumn("matches", by_score).drop("_scores")


def with_text_matches(df: DataFrame, text: str, names: Sequence[str], threshold: float = SIMILARITY_THRESHOLD) -> DataFrame:
    """Add ``matches`` of a text column with the patterns; each distinct text is scored once."""
    return once_per_text(df, text, lambda d: with_matches(d, None, names, None, threshold, text_scores(names)(F.col("_text"))))


def once_per_text(df: DataFrame, text: str, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The table with the columns that ``work`` adds to a column ``_text`` of its distinct texts; a NULL text is empty.

    The distinct texts are written, and few of them are broadcast: a text that
    many rows share would else send these to one task.
    """
    named = df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    distinct = materialize(work(named.select("_text").distinct()), "texts")
    return named.join(broadcast_if_small(distinct), "_text").drop("_text")


def score(
    matched: DataFrame, base_scores: Mapping, factor: Column, weights: Mapping[str, float] | None = None,
    level: Column | None = None,
) -> DataFrame:
    """Scores and level from the best match; rule mode or learned mode.

    In learned mode the level comes from the model's class when one is given.
    """
    bases = F.create_map(*[x for k, v in base_scores.items() for x in (F.lit(k), F.lit(float(v)))])
    best = F.get("matches", F.lit(0))
    similarity = best["similarity"]
    base = F.element_at(bases, best["rule"])
    adjusted = base * factor
    if weights is None:
        combined = rules.combined_score(similarity, base, factor)
    else:
        combined = rules.learned_score(similarity, adjusted, factor, weights)
    hit = F.size("matches") > 0
    with_score = matched.withColumn("_hit", hit).withColumns(
        {
            "bert_score": F.when(hit, similarity).otherwise(NO_MATCH[1]),
            "rule_score": F.when(hit, adjusted).otherwise(NO_MATCH[2]),
            "combined_score": F.when(hit, combined).otherwise(NO_MATCH[3]),
            "matched_pattern": best["rule"],
            "top_matches": F.slice("matches", 1, TOP_MATCHES),
        }
    )
    decided = level if level is not None else rules.severity_bucket(F.col("combined_score"))
    return with_score.withColumn(
        "severity_level", F.when(F.col("_hit"), decided).otherwise(NO_MATCH[0])
    ).drop("_hit", "matches")


def score_new(
    records: DataFrame, mappings: DataFrame, key: str, text: str, environment: str,
    known: Sequence[tuple] = SEVERITY_RULES, threshold: float = SIMILARITY_THRESHOLD,
    weights: Mapping[str, float] | None = None, level: Column | None = None,
) -> DataFrame:
    """The mappings after the records without ``processed_at`` are scored and stored by key.

    ``text`` and ``environment`` name the analysis text and the raw environment.
    With ``weights`` the score is the learned one, and ``level``, an expression
    over similarity, adjusted and factor, decides the severity of a match.
    Other records, and mappings of theirs, stay as they are.
    """
    base = {r[0]: float(r[2]) for r in known}
    new = records.filter("processed_at IS NULL")
    matched = with_text_matches(new, text, list(base), threshold)
    factor = rules.environment_factor(F.col(environment))
    bases = F.create_map(*[x for k, v in base.items() for x in (F.lit(k), F.lit(v))])
    best = F.get("matches", F.lit(0))
    with_features = matched.withColumns({
        "similarity": best["similarity"], "adjusted": F.element_at(bases, best["rule"]) * factor, "factor": factor})
    scored = score(with_features, base, F.col("factor"), weights, level)
    words = F.when(F.col("matched_pattern").isNotNull(), matched_keywords(text, list(base))).otherwise(F.array().cast("array<string>"))
    rows = scored.select(
        key, F.col("severity_level").alias("severity_id"), "bert_score", "rule_score", "combined_score", "matched_pattern",
        words.alias("matched_keywords"), rules.environment_name(F.col(environment)).alias("environment"))
    # Keys come from the records: scored rows would be made a second time for them.
    return mappings.join(new.select(key), key, "left_anti").unionByName(rows, allowMissingColumns=True)


def match_features(
    records: DataFrame, text: str, environment: str, known: Sequence[tuple] = SEVERITY_RULES, threshold: float = SIMILARITY_THRESHOLD,
) -> DataFrame:
    """(similarity, adjusted, factor, level) of the records that match a rule; the level is that of the rule mode."""
    base = {r[0]: float(r[2]) for r in known}
    factor = rules.environment_factor(F.col(environment))
    matched = with_text_matches(records, text, list(base), threshold).filter(F.size("matches") > 0)
    scored = score(matched, base, factor)
    return scored.select(F.col("bert_score").alias("similarity"), F.col("rule_score").alias("adjusted"), factor.alias("factor"),
                         F.col("severity_level").alias("level"))


def exact_tier(text: str, tiers: Mapping[str, tuple[float, Sequence[str]]] = TIERS) -> Column:
    """First tier and pattern found literally in the text, NULL without one."""
    low = F.lower(text)
    case = None
    for tier, (_, patterns) in tiers.items():
        for p in patterns:
            hit = F.struct(F.lit(tier).alias("severity"), F.lit(1.0).alias("confidence"), F.lit(p).alias("rule_match"))
            case = F.when(low.contains(p), hit) if case is None else case.when(low.contains(p), hit)
    return case


def tiered(
    df: DataFrame, text: str, vector: str | None = None, patterns: Sequence[tuple[str, str]] = (),
    matrix: np.ndarray | None = None, tiers: Mapping[str, tuple[float, Sequence[str]]] = TIERS,
    scores: Column | None = None,
) -> DataFrame:
    """Tier by literal pattern, else by the best weighted similarity.

    ``patterns`` names (tier, pattern) for each row of ``matrix``, or each of
    the given ``scores``, in tier order; without either a text without a literal hit is low with 0.
    """
    exact = exact_tier(text, tiers)
    if vector is None and scores is None:
        soft = F.struct(F.lit("low").alias("severity"), F.lit(0.0).alias("confidence"), F.lit(None).cast("string").alias("rule_match"))
        return df.withColumn("_m", F.coalesce(exact, soft)).select(*df.columns, "_m.*")
    weights = F.array(*[F.lit(float(tiers[t][0])) for t, _ in patterns])
    names = F.array(*[F.struct(F.lit(t).alias("severity"), F.lit(p).alias("rule_match")) for t, p in patterns])
    weighted = F.zip_with("_scores", weights, lambda s, w: s * w)
    best = F.array_max("_weighted")
    named = F.get(names, (F.array_position("_weighted", best) - 1).cast("int"))
    soft = F.struct(
        F.when(best > 0, named["severity"]).otherwise("low").alias("severity"),
        F.greatest(best, F.lit(0.0)).alias("confidence"),
        F.when(best > 0, named["rule_match"]).alias("rule_match"),
    )
    found = scores if scores is not None else vectors.scores_to(matrix)(F.col(vector))
    scored = df.withColumn("_scores", found).withColumn("_weighted", weighted)
    return scored.withColumn("_m", F.coalesce(exact, soft)).select(*df.columns, "_m.*")
