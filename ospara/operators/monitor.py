"""Metric, audit and task records of running jobs."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ospara.functions import rules


def task_records(df: DataFrame, action: str, agent: str = "triage", keep: Sequence[str] = ()) -> DataFrame:
    """Queue entries for incidents (incident_id, vector_id, severity), beside the columns to ``keep``."""
    task = F.struct(F.lit(action).alias("action"), "incident_id", "vector_id")
    return df.select(
        "incident_id", *keep, F.to_json(task).alias("task_json"), F.lit("pending").alias("status"),
        F.lit(agent).alias("agent"), rules.priority_of(F.col("severity")).alias("priority"),
    )


def metric_rows(df: DataFrame, metric: Column, ts: str, value: Column, attributes: Mapping[str, str] | None = None) -> DataFrame:
    """Long metric table: metric, ts, value, attrs."""
    attrs = F.create_map(*[x for k, c in (attributes or {}).items() for x in (F.lit(k), F.col(c).cast("string"))])
    return df.select(
        metric.alias("metric"), F.col(ts).alias("ts"), value.cast("double").alias("value"),
        attrs.cast("map<string,string>").alias("attrs"),
    )


def audit_events(df: DataFrame, severities: Mapping[str, str], default: str = "LOW") -> DataFrame:
    """Typed audit rows with a severity per event type."""
    kinds = F.col("event_type")
    case = functools.reduce(lambda c, kv: c.when(kinds == kv[0], kv[1]), severities.items(), F.when(F.lit(False), ""))
    return df.select(
        F.col("event_id"), F.col("ts"), kinds, F.col("user_id"), case.otherwise(default).alias("severity"),
        F.concat(kinds, F.lit(" by "), F.col("user_id").cast("string")).alias("description"),
        F.create_map(F.lit("value"), F.col("value").cast("string")).alias("metadata"),
    )


def tagged_union(parts: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Several tables stacked with a tag column."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def older_than(df: DataFrame, ts: str, asof: Column, days: int) -> DataFrame:
    return df.filter(F.col(ts) < asof - F.expr(f"interval {days} days"))


def keep_recent(df: DataFrame, ts: str, asof: Column, days: int) -> DataFrame:
    return df.filter(F.col(ts) >= asof - F.expr(f"interval {days} days"))


def search_page(hits: DataFrame, documents: DataFrame, columns: Sequence[str], width: int = 200) -> DataFrame:
    """Hits with the head of their document's text."""
    return hits.join(documents.select(*columns, F.substring("text", 1, width).alias("snippet")), "doc_id", "left")
