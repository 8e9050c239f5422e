"""Writers, keyed upserts, marks, retention and table rewrites.

Parquet tables are never overwritten in place: a change is written as a new
version of the table next to the old one.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def write_csv(df: DataFrame, path: str, **options) -> None:
    df.write.options(header=True, escape='"', **options).mode("errorifexists").csv(path)


def write_json(df: DataFrame, path: str, generated_at: str, version: str = "1.0") -> None:
    """Rows as JSON lines, and a one-row manifest beside them."""
    df.write.json(f"{path}/data")
    manifest = df.sparkSession.read.schema(df.schema).json(f"{path}/data").agg(
        F.lit(generated_at).alias("generated_at"), F.count(F.lit(1)).alias("record_count"), F.lit(version).alias("version")
    )
    manifest.coalesce(1).write.json(f"{path}/manifest")


def newest(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the one last in order."""
    rest = [c for c in df.columns if c not in key]
    best = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return best.select(*key, "_r.*").select(*df.columns)


def upsert(target: DataFrame, updates: DataFrame, key: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Target with the updates in place of rows of equal key."""
    new = newest(updates, key, order) if order else updates
    return target.join(new.select(*key), list(key), "left_anti").unionByName(new, allowMissingColumns=True)


def mark_processed(df: DataFrame, done: DataFrame, key: str, at: Column, column: str = "processed_at") -> DataFrame:
    ids = done.select(F.col(key).alias("_done")).distinct()
    joined = df.join(ids, F.col(key) == F.col("_done"), "left")
    return joined.withColumn(column, F.coalesce(column, F.when(F.col("_done").isNotNull(), at))).drop("_done")


def rewrite(
    df: DataFrame, path: str, drop: Sequence[str] = (), rename: Mapping[str, str] | None = None,
    defaults: Mapping[str, object] | None = None,
) -> DataFrame:
    """The table in a new schema, written as a new version."""
    out = df.drop(*drop).withColumnsRenamed(dict(rename or {}))
    out = out.withColumns({c: F.lit(v) for c, v in (defaults or {}).items()})
    out.write.parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path)


def write_routed(df: DataFrame, path: str, by: str) -> DataFrame:
    """One pass over the rows into a folder per target."""
    df.write.partitionBy(by).parquet(path)
    return df.sparkSession.read.parquet(path)


def catalogue(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    return functools.reduce(lambda a, b: a.unionByName(b), counts)


def first_rows(df: DataFrame, key: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows by key as pretty JSON, with the size of the table."""
    shown = F.to_json(F.struct(*df.columns), {"pretty": "true"}).alias("row_json")
    return df.orderBy(*key).limit(n).select(*key, shown, F.lit(df.count()).alias("total"))


def hand_off(df: DataFrame, columns: Sequence[str], order: Sequence[Column], n: int = 10) -> DataFrame:
    """Best ``n`` rows as JSON tasks."""
    return df.orderBy(*order).limit(n).select(F.to_json(F.struct(*columns)).alias("task"))
