"""Projections, filters and predicates over tables with declared columns."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

# Names that mark a column as time-like or as an identifier.
TIME_WORDS = ("time", "date")
ID_WORDS = ("id", "name", "station", "substation", "plant")
# Words that make a text call for an investigation.
TRIGGER_WORDS = ("mastitis", "urgent", "immediate", "stop delivery", "hold milk")


def select_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    return df.select(*columns)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def usable_features(df: DataFrame) -> list[str]:
    """Numeric columns that look neither like times nor like identifiers.

    The test is on substrings, so "id" also drops "humidity".
    """
    words = TIME_WORDS + ID_WORDS
    return [c for c in numeric_columns(df) if not any(w in c.lower() for w in words)]


def enrich(df: DataFrame, provider: Callable[[DataFrame], DataFrame] | str) -> DataFrame:
    """Apply a provider, a callable or a dotted path "module:name"."""
    if isinstance(provider, str):
        module, _, name = provider.replace(":", ".").rpartition(".")
        provider = getattr(importlib.import_module(module), name)
        if isinstance(provider, type):
            provider = provider()
    if not callable(provider):
        provider = provider.provide
    return df.transform(provider)


def metadata_filter(df: DataFrame, wanted: Mapping[str, object]) -> DataFrame:
    conditions = [F.col(k) == F.lit(v) for k, v in wanted.items()]
    return df.filter(functools.reduce(lambda a, b: a & b, conditions, F.lit(True)))


def time_range(df: DataFrame, ts: str, asof: Column, days: float) -> DataFrame:
    return df.filter(F.col(ts) >= asof - F.expr(f"interval {int(days * 86400)} seconds"))


def audit_query(
    df: DataFrame,
    types: Sequence[str] | None = None,
    severities: Sequence[str] | None = None,
    users: Sequence | None = None,
    start: datetime | str | None = None,
    end: datetime | str | None = None,
    search: str | None = None,
) -> DataFrame:
    """Audit events that meet every given condition; metadata is a map column."""
    if types:
        df = df.filter(F.col("event_type").isin(*types))
    if severities:
        df = df.filter(F.col("severity").isin(*severities))
    if users:
        df = df.filter(F.col("user_id").isin(*users))
    if start is not None:
        df = df.filter(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.filter(F.col("ts") <= F.lit(end).cast("timestamp_ntz"))
    if search:
        needle = search.lower()

        def has(c: Column) -> Column:
            return F.lower(c.cast("string")).contains(needle)

        df = df.filter(
            has(F.col("description"))
            | has(F.col("event_type"))
            | has(F.col("user_id"))
            | F.exists(F.map_values("metadata"), has)
        )
    return df


def missing_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its null count and percentage, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return counts.unpivot("_n", list(columns), "feature", "missing").select(
        "feature", "missing", (F.col("missing") * 100.0 / F.col("_n")).alias("percent")
    )


def split_json(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows with valid JSON, and the quarantined rest (NULL counts as bad)."""
    valid = F.expr(f"coalesce(try_parse_json({column}) is not null, false)")
    return df.filter(valid), df.filter(~valid)


def route(event_type: Column, routes: Mapping[str, Sequence[str]], default: str) -> Column:
    case = None
    for target, types in routes.items():
        hit = event_type.isin(*types)
        case = F.when(hit, target) if case is None else case.when(hit, target)
    return case.otherwise(default) if case is not None else F.lit(default)


def trigger_actions(
    df: DataFrame, text: str, entity: str, words: Sequence[str] = TRIGGER_WORDS, width: int = 300
) -> DataFrame:
    low = F.lower(text)
    hit = functools.reduce(lambda a, b: a | b, [low.contains(w) for w in words])
    return df.filter(hit & F.col(entity).isNotNull()).select(
        entity, F.lit("investigate").alias("decision"), F.substring(text, 1, width).alias("reason")
    )


def prompt_context(df: DataFrame, key: str, exclude: Sequence[str]) -> DataFrame:
    """Rows as "name: value" lines, without the excluded columns."""
    kept = [c for c in df.columns if c not in exclude]
    lines = [F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit("None"))) for c in kept]
    return df.select(key, F.concat_ws("\n", *lines).alias("context"))
