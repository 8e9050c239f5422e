"""Per-entity sequences: windows, forecasts, tails, running figures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ospara.scale import MAX_BLOCK_ROWS, halo_blocks, running_sums, top_k

SEASON = 7
HISTORY_LIMIT = 500


def sequence_windows(
    df: DataFrame, key: Sequence[str], order: Sequence[str], value: str, length: int,
    max_rows: int = MAX_BLOCK_ROWS,
) -> DataFrame:
    """Training pairs: the ``length`` values before a row, and its own value.

    Rows with a shorter past give no pair. Histories of hot entities are cut
    into blocks that overlap by ``length`` rows.
    """
    blocks = halo_blocks(df.select(*key, *order, value), key, order, length, max_rows)
    past = Window.partitionBy(*key, "_blk").orderBy(*order).rowsBetween(-length, -1)
    return (
        blocks.withColumn("x", F.collect_list(value).over(past))
        .filter(~F.col("_halo") & (F.size("x") == length))
        .select(*key, *order, "x", F.col(value).alias("y"))
    )


def tail(df: DataFrame, key: Sequence[str], order: Sequence[str], n: int = HISTORY_LIMIT, salts: int = 16) -> DataFrame:
    """Latest ``n`` rows per entity, numbered from the newest (``rank``)."""
    return top_k(df, key, [F.desc(c) for c in order], n, salts)


def seasonal_forecast(
    df: DataFrame, key: str, order: Sequence[str], value: str, horizon: int = SEASON, salts: int = 16
) -> DataFrame:
    """Next ``horizon`` values per entity.

    With a full season behind it step i repeats value ``i mod 7`` of the last
    season; a shorter history gives its mean, an empty one 0.
    """
    recent = top_k(df.select(key, *order, value), [key], [F.desc(c) for c in order], SEASON, salts)
    season = recent.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct((SEASON - F.col("rank")).alias("slot"), F.col(value).alias("v")))).alias("_s"),
        F.avg(value).alias("_mean"),
    )
    steps = F.sequence(F.lit(0), F.lit(horizon - 1))
    return season.select(key, "_s", "_mean", F.explode(steps).alias("step")).select(
        key, "step",
        F.when(F.size("_s") >= SEASON, F.get("_s", F.col("step") % SEASON)["v"])
        .otherwise(F.coalesce("_mean", F.lit(0.0)))
        .alias("forecast"),
    )


def running_counts(
    df: DataFrame, ts: str, order: Sequence[str], labels: Mapping[str, Column], max_rows: int = MAX_BLOCK_ROWS
) -> DataFrame:
    """Counts over all rows so far, after each row of the whole table.

    Days are summed apart; totals of earlier days are added afterwards, so the
    global order never passes through one task.
    """
    values = {name: F.when(c, 1).otherwise(0).cast("long") for name, c in labels.items()}
    with_day = df.withColumn("_day", F.to_date(ts))
    inside = running_sums(with_day, ["_day"], order, values, max_rows)
    by_day = with_day.groupBy("_day").agg(*[F.sum(c).alias(f"_d_{n}") for n, c in values.items()])
    earlier = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    before = by_day.select(
        F.col("_day").alias("_before"),
        *[F.coalesce(F.sum(f"_d_{n}").over(earlier), F.lit(0)).alias(f"_d_{n}") for n in values],
    )
    joined = inside.join(before, F.col("_day") == F.col("_before"))
    return joined.select(*df.columns, *[(F.col(n) + F.col(f"_d_{n}")).alias(n) for n in values])


def explained_cut(components: DataFrame, threshold: float) -> DataFrame:
    """Cumulative share per component and the number needed for ``threshold``.

    All components are needed when the threshold is never reached. The table
    has one row per component.
    """
    running = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cumulative = components.withColumn("cumulative", F.sum("share").over(running))
    whole = Window.partitionBy()
    first = F.min(F.when(F.col("cumulative") >= threshold, F.col("component"))).over(whole)
    return cumulative.withColumn("needed", F.coalesce(first, F.count("component").over(whole).cast("int")))


def latest_state(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Values of the newest row per entity; partial aggregates before the shuffle."""
    at = F.struct(*order)
    newest = df.groupBy(key).agg(F.max_by(F.struct(*columns), at).alias("_s"))
    return newest.select(key, "_s.*")


def merge_fields(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Field-wise last value that is set, per entity."""
    at = F.struct(*order)
    return df.groupBy(key).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns]
    )
