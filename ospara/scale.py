"""Building blocks that keep hot keys, long histories and small sides safe.

A key may own a third of all rows. Ordered work on such keys runs in blocks:
their rows are range partitioned by key and order, each range is worked on
alone, and one total per key and range gives the offset of the next. Keys that
fit a block skip all of that.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ospara.session import materialize

MAX_BLOCK_ROWS = 5_000_000
MAX_SMALL_ROWS = 20_000


class TooLarge(ValueError):
    """A side that has to be small is not."""


def collect_small(df: DataFrame, limit: int = MAX_SMALL_ROWS, what: str = "side") -> list[Row]:
    """Rows of a side whose size is checked before the driver takes it."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise TooLarge(f"{what} has more than {limit} rows")
    return rows


def broadcast_if_small(df: DataFrame, limit: int = MAX_SMALL_ROWS) -> DataFrame:
    """Broadcast hint for a side of proven size; without it Spark shuffles."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def top_k(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int,
    salts: int = 16,
    rank: str = "rank",
) -> DataFrame:
    """Best ``k`` rows per key in two steps.

    The first step ranks inside (key, salt), so that a hot key is spread over
    ``salts`` tasks and each of them hands on ``k`` rows at most.
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if _hashable(df, c)]), F.lit(salts))
    inner = Window.partitionBy(*keys, "_salt").orderBy(*order)
    outer = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_salt", salt)
        .withColumn(rank, F.row_number().over(inner))
        .filter(F.col(rank) <= k)
        .withColumn(rank, F.row_number().over(outer))
        .filter(F.col(rank) <= k)
        .drop("_salt")
    )


def _hashable(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() not in ("map", "variant")


def unfold(df: DataFrame, items: Column, name: str, keep: Sequence[str]) -> DataFrame:
    """One row per array item that is not null.

    A plain explode makes the optimizer test the array's size before the row
    is built, which computes a costly array twice; the outer form does not.
    """
    return df.select(*keep, F.explode_outer(items).alias(name)).filter(F.col(name).isNotNull())


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all cores on a freshly read table that has fewer splits than cores.

    Such a table is at most cores x split size; larger ones stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def fine(df: DataFrame, rows: int) -> DataFrame:
    """Tasks of about ``rows`` rows at most, for fits that hold a row much larger than its table does."""
    n = math.ceil(df.count() / rows)
    return df.repartition(n) if n > df.rdd.getNumPartitions() else df


def _same(left: DataFrame, right: DataFrame, key: Sequence[str]) -> Column:
    """Null-safe match of ``key`` on the left with ``_h_`` columns on the right."""
    condition = F.lit(True)
    for c in key:
        condition = condition & left[c].eqNullSafe(right[f"_h_{c}"])
    return condition


def ordered_blocks(
    df: DataFrame, key: Sequence[str], order: Sequence[str], max_rows: int = MAX_BLOCK_ROWS
) -> tuple[DataFrame, bool]:
    """Add ``_blk``, slices of a key along its ascending order.

    Keys of up to ``max_rows`` rows are one slice, 0. The rows of all others
    are range partitioned by key and order together; a hash of the row parts
    even rows of equal order. Ranges are numbered along the order and written,
    so that every later step sees the same ones. The flag tells whether any
    key was cut at all.
    """
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_h_n")).filter(F.col("_h_n") > max_rows)
    hot = materialize(counts.select(*[F.col(c).alias(f"_h_{c}") for c in key], "_h_n"), "hot-keys")
    total = hot.agg(F.sum("_h_n")).first()[0]
    if not total:
        return df.withColumn("_blk", F.lit(0)), False
    tie = F.xxhash64(*[F.col(c) for c in df.columns if _hashable(df, c)])
    rows = df.join(hot, _same(df, hot, key), "left_semi").repartitionByRange(math.ceil(total / max_rows), *key, *order, tie)
    ranges = materialize(rows.withColumn("_blk", F.spark_partition_id() + 1), "ranges")
    cold = df.join(hot, _same(df, hot, key), "left_anti").withColumn("_blk", F.lit(0))
    return cold.unionByName(ranges), True


def positions(
    df: DataFrame, key: Sequence[str], order: Sequence[str], max_rows: int = MAX_BLOCK_ROWS
) -> DataFrame:
    """Add ``pos``, the 1-based place of a row in its key."""
    return _place(*ordered_blocks(df, key, order, max_rows), key, order).drop("_blk")


def _place(blocks: DataFrame, cut: bool, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    local = Window.partitionBy(*key, "_blk").orderBy(*order)
    numbered = blocks.withColumn("pos", F.row_number().over(local).cast("long"))
    if not cut:
        return numbered
    before = Window.partitionBy(*key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocks.filter("_blk > 0").groupBy(*key, "_blk")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select(*[F.col(c).alias(f"_h_{c}") for c in key], F.col("_blk").alias("_b"), "_offset")
    )
    condition = _same(numbered, offsets, key) & (numbered["_blk"] == offsets["_b"])
    return (
        numbered.join(offsets, condition, "left")
        .withColumn("pos", F.col("pos") + F.coalesce("_offset", F.lit(0)))
        .drop("_b", "_offset", *[f"_h_{c}" for c in key])
    )


def halo_blocks(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    halo: int,
    max_rows: int = MAX_BLOCK_ROWS,
) -> DataFrame:
    """Add ``_blk`` and ``_halo`` for windows that look back ``halo`` rows.

    Each block also gets copies of the last ``halo`` rows before it, marked
    ``_halo``; run the window per (key, ``_blk``) and drop the marked rows.
    """
    blocks, cut = ordered_blocks(df, key, order, max_rows)
    if not cut:
        return blocks.withColumn("_halo", F.lit(False))
    size = max(max_rows, halo)
    at = F.col("pos") - 1
    own = F.floor(at / size).cast("int")
    homes = F.when(at % size >= size - halo, F.array(own, own + 1)).otherwise(F.array(own))
    return (
        _place(blocks, cut, key, order)
        .withColumn("_own", own)
        .withColumn("_blk", F.explode(homes))
        .withColumn("_halo", F.col("_blk") != F.col("_own"))
        .drop("_own", "pos")
    )


def running_sums(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    values: dict[str, Column],
    max_rows: int = MAX_BLOCK_ROWS,
) -> DataFrame:
    """Running totals of ``values`` along the order of each key.

    Totals of earlier blocks are added to the running sum inside the block, so
    no task holds more than one block of a key.
    """
    blocks, cut = ordered_blocks(df, key, order, max_rows)
    inside = (
        Window.partitionBy(*key, "_blk").orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = blocks.select(
        *df.columns, "_blk", *[F.sum(c).over(inside).alias(n) for n, c in values.items()]
    )
    if not cut:
        return summed.drop("_blk")
    before = Window.partitionBy(*key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        blocks.filter("_blk > 0").groupBy(*key, "_blk")
        .agg(*[F.sum(c).alias(f"_t_{n}") for n, c in values.items()])
        .select(
            *[F.col(c).alias(f"_h_{c}") for c in key],
            F.col("_blk").alias("_b"),
            *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_t_{n}") for n in values],
        )
    )
    condition = _same(summed, totals, key) & (summed["_blk"] == totals["_b"])
    added = summed.join(totals, condition, "left")
    for n in values:
        added = added.withColumn(n, F.col(n) + F.coalesce(f"_t_{n}", F.lit(0)))
    return added.select(*df.columns, *values)
