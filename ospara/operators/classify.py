"""Rule, model and vote based classification of texts."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import HashingTF, IDF, IndexToString, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ospara.functions import rules as rule_functions


@dataclass(frozen=True)
class ClassRule:
    pattern: str
    domain: str
    category: str
    subcategories: tuple[str, ...] = ()
    tags: tuple[str, ...] = ()
    is_regex: bool = True
    priority: int = 1


def _rule(pattern, domain, category, subcategories, tags, priority) -> ClassRule:
    return ClassRule(pattern, domain, category, tuple(subcategories), tuple(tags), True, priority)


# The classification rules.
CLASS_RULES = [
    _rule(r"\b(api|rest|graphql|endpoint|swagger|openapi)\b", "technical", "api",
          ["web_api", "api_design"], ["api", "integration", "backend"], 3),
    _rule(r"\b(security|auth[en].*|oauth|jwt|encryption|ssl|tls)\b", "technical", "security",
          ["authentication", "encryption"], ["security", "auth", "protection"], 3),
    _rule(r"\b(docker|kubernetes|k8s|container|pod|deployment|helm)\b", "technical", "infrastructure",
          ["containerization", "orchestration"], ["devops", "containers", "cloud"], 2),
    _rule(r"\b(sales|revenue|customer|pipeline|lead|conversion)\b", "business", "sales",
          ["revenue", "customer_acquisition"], ["sales", "revenue", "customers"], 2),
    _rule(r"\b(marketing|campaign|seo|advertising|brand|social\s*media)\b", "business", "marketing",
          ["digital_marketing", "branding"], ["marketing", "advertising", "promotion"], 2),
    _rule(r"\b(gdpr|compliance|legal|privacy|terms\s*of\s*service|policy)\b", "legal", "compliance",
          ["privacy", "data_protection"], ["legal", "compliance", "privacy"], 3),
    _rule(r"\b(machine\s*learning|ml|ai|neural|model|training|inference)\b", "technical", "data",
          ["machine_learning", "ai"], ["ml", "ai", "data_science"], 2),
    _rule(r"\b(database|sql|nosql|mongodb|postgresql|redis|cache)\b", "technical", "data",
          ["databases", "data_storage"], ["database", "storage", "data"], 2),
    _rule(r"\b(test|unit\s*test|integration\s*test|qa|quality)\b", "technical", "testing",
          ["unit_testing", "qa"], ["testing", "quality", "qa"], 1),
    _rule(r"\b(hr|hiring|recruitment|employee|talent|onboarding)\b", "business", "hr",
          ["recruitment", "employee_management"], ["hr", "hiring", "personnel"], 2),
    _rule(r"\b(finance|budget|cost|expense|investment|roi)\b", "business", "finance",
          ["budgeting", "financial_planning"], ["finance", "budget", "costs"], 2),
    _rule(r"\b(strategy|roadmap|vision|mission|goal|objective)\b", "business", "strategy",
          ["planning", "objectives"], ["strategy", "planning", "goals"], 1),
]


def load_rules(text: str) -> list[ClassRule]:
    """Rules of a JSON document {"rules": [..]}."""
    rows = json.loads(text)["rules"]
    return [
        ClassRule(
            r["pattern"], r["domain"], r["category"], tuple(r.get("subcategories", ())), tuple(r.get("tags", ())),
            r.get("is_regex", True), r.get("priority", 1),
        )
        for r in rows
    ]


def by_priority(rules: Sequence[ClassRule]) -> list[ClassRule]:
    """Highest priority first; equal ones keep their order."""
    return sorted(rules, key=lambda r: -r.priority)


def rule_hit(text: str, rule: ClassRule) -> Column:
    if rule.is_regex:
        return F.col(text).rlike("(?iU)" + rule.pattern)
    return F.lower(text).contains(rule.pattern.lower())


#: Alternatives between word boundaries, without groups of their own.
WORDS = re.compile(r"\\b\(((?:[^()\\]|\\[sSdDwWbB])*)\)\\b")


def any_hit(text: str, rules: Sequence[ClassRule]) -> Column:
    """Whether any rule matches; lists of words are one pattern, which tests a word boundary once."""
    lists = [m[1] for r in rules if r.is_regex and (m := WORDS.fullmatch(r.pattern))]
    hits = [rule_hit(text, r) for r in rules if not (r.is_regex and WORDS.fullmatch(r.pattern))]
    if lists:
        hits.append(F.col(text).rlike(r"(?iU)\b(" + "|".join(lists) + r")\b"))
    return reduce(or_, hits)


def rule_classification(text: str, rules: Sequence[ClassRule] = tuple(CLASS_RULES)) -> Column:
    """Struct of the first matching rule in priority order, NULL without one.

    A single CASE: later patterns are not tried once one matched, and none is
    where all of them together find nothing.
    """
    case = None
    for r in by_priority(rules):
        result = F.struct(
            F.lit(r.domain).alias("domain"), F.lit(r.category).alias("category"), F.lit(1.0).alias("confidence"),
            F.array(*[F.lit(s) for s in r.subcategories]).cast("array<string>").alias("subcategories"),
            F.array(*[F.lit(s) for s in r.tags]).cast("array<string>").alias("tags"),
        )
        case = F.when(rule_hit(text, r), result) if case is None else case.when(rule_hit(text, r), result)
    return case if case is None else F.when(any_hit(text, rules), case)


def text_features(text: str = "text", features: int = 4096) -> list:
    return [
        RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=r"\W+", gaps=True),
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="features"),
    ]


def train_text_classifier(df: DataFrame, text: str, label: str, classifier: Estimator | None = None,
                          features: int = 1024, trees: int = 100, seed: int = 42):
    """Pipeline text -> tf-idf -> classifier; any estimator may be passed in."""
    model = classifier or RandomForestClassifier(
        featuresCol="features", labelCol="_label", numTrees=trees, seed=seed
    )
    indexer = StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc").fit(df)
    back = IndexToString(inputCol="prediction", outputCol="predicted", labels=indexer.labels)
    return Pipeline(stages=[indexer, *text_features(text, features), model, back]).fit(df)


def model_classification(scored: DataFrame, threshold: float = 0.6) -> DataFrame:
    """Accept a prediction whose probability reaches the threshold."""
    confidence = F.array_max(vector_to_array("probability"))
    sure = confidence >= threshold
    result = F.struct(
        rule_functions.domain_of(F.col("predicted")).alias("domain"), F.col("predicted").alias("category"),
        confidence.alias("confidence"), F.lit(None).cast("array<string>").alias("subcategories"),
        F.lit(None).cast("array<string>").alias("tags"),
    )
    return scored.withColumn("ml_result", F.when(sure, result))


def cascade(df: DataFrame, methods: Sequence[tuple[str, str]]) -> DataFrame:
    """Pick the most confident of several classification columns.

    ``methods`` lists (name, column), earlier first on ties; all results stay
    in ``previous``; no result gives unknown with confidence 0.
    """
    tried = F.filter(
        F.array(
            *[
                F.when(
                    F.col(c).isNotNull(),
                    F.struct(
                        F.col(f"{c}.confidence").alias("confidence"), F.lit(-i).alias("place"),
                        F.lit(name).alias("method"), F.col(f"{c}.domain").alias("domain"),
                        F.col(f"{c}.category").alias("category"),
                    ),
                )
                for i, (name, c) in enumerate(methods)
            ]
        ),
        lambda r: r.isNotNull(),
    )
    best = F.array_max("previous")
    return df.withColumn("previous", tried).select(
        *df.columns, "previous",
        F.coalesce(best["domain"], F.lit("unknown")).alias("domain"),
        F.coalesce(best["category"], F.lit("unknown")).alias("category"),
        F.coalesce(best["confidence"], F.lit(0.0)).alias("confidence"),
        F.coalesce(best["method"], F.lit("fallback")).alias("method"),
    )
