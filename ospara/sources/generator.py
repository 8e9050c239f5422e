"""Tables from a declarative field list, generated in parallel."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Length of a date step by its code.
STEPS = {"D": "1 day", "H": "1 hour", "T": "1 minute", "min": "1 minute", "S": "1 second", "W": "7 days"}


def field_column(name: str, spec: Mapping, index: Column, seed: int) -> Column:
    kind = spec.get("type", "normal")
    if kind == "date":
        return _dates(spec, index)
    if kind == "normal":
        return F.randn(seed) * float(spec.get("std", 1.0)) + float(spec.get("mean", 0.0))
    if kind == "uniform":
        low, high = float(spec.get("low", 0.0)), float(spec.get("high", 1.0))
        return F.rand(seed) * (high - low) + low
    if kind in ("sin", "cos"):
        turn = index * (2 * math.pi / float(spec.get("period", 30.0))) + float(spec.get("phase", 0.0))
        wave = (F.sin(turn) if kind == "sin" else F.cos(turn)) * float(spec.get("amplitude", 1.0))
        noise = float(spec.get("noise", 0.0))
        return wave + F.randn(seed) * noise if noise > 0 else wave
    if kind == "categorical":
        return _category(name, list(spec.get("categories", [])), spec.get("weights"), seed)
    if kind == "id":
        return index * int(spec.get("step", 1)) + int(spec.get("start", 0))
    return F.lit(0.0)


def _dates(spec: Mapping, index: Column) -> Column:
    step = STEPS[spec.get("freq", "D")]
    start = F.lit(str(spec.get("start", "2020-01-01"))).cast("timestamp_ntz")
    amount, unit = step.split()
    part = {"day": "days", "days": "days", "hour": "hours", "minute": "mins", "second": "secs"}[unit]
    return start + F.make_dt_interval(**{part: (index * int(amount)).cast("decimal(18,6)" if part == "secs" else "int")})


def _category(name: str, values: Sequence, weights: Sequence[float] | None, seed: int) -> Column:
    if not values:
        raise ValueError(f"categorical field {name} requires non-empty categories")
    weights = [float(w) for w in (weights or [1.0] * len(values))]
    total, bound, slots = sum(weights), 0.0, []
    for w in weights:
        bound += w / total
        slots.append(bound)
    return _pick(values, slots[:-1], F.rand(seed))


def _pick(values: Sequence, slots: Sequence[float], draw: Column) -> Column:
    """One draw against the cumulative weights; a single expression, one draw."""
    bounds = F.array(*[F.lit(b) for b in slots]).cast("array<double>")
    names = F.array(*[F.lit(v) for v in values])
    hits = F.transform(F.array(draw), lambda d: F.get(names, F.size(F.filter(bounds, lambda b: b <= d))))
    return hits[0]


def generate(spark: SparkSession, spec: Mapping, n: int | None = None, seed: int = 42, partitions: int | None = None) -> DataFrame:
    """``spec`` holds ``n`` and ``fields``; each field gets a seed of its own."""
    rows = int(spec.get("n", 100) if n is None else n)
    base = spark.range(0, rows, 1, partitions) if partitions else spark.range(rows)
    return with_fields(base.withColumnRenamed("id", "_i"), spec.get("fields", {}), "_i", seed).drop("_i")


def with_fields(df: DataFrame, fields: Mapping[str, Mapping], index: str, seed: int = 42) -> DataFrame:
    """The generated fields beside the columns of an indexed table."""
    return df.select(
        "*", *[field_column(name, s, F.col(index), seed + i).alias(name) for i, (name, s) in enumerate(fields.items())]
    )
