"""Structured Streaming jobs over event files.

Results that change go to a log in the shared folder: one folder per
micro-batch, overwritten when a batch is replayed, so a restart neither loses
nor doubles rows. Older batches are folded into one state, so folders do not
grow with the batches. The current table is read from the log.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.errors import (
    ArithmeticException, ArrayIndexOutOfBoundsException, DateTimeException, NumberFormatException, PythonException,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ospara.scale import top_k
from ospara.session import fresh_path

log = logging.getLogger(__name__)


Fold = Callable[[DataFrame], DataFrame]


class UpdateLog:
    """Table of micro-batches, one folder each, of which older ones are folded.

    A replay repeats the newest batch only. So once ``keep`` batches before it
    have gathered, a job that gives a ``fold`` merges them with the state so far
    into one folder, and folders that an earlier state covers are deleted. A
    state counts once it is complete, and reading takes the newest one and the
    batches after it; a stop at any point leaves a table that reads the same.
    """

    def __init__(self, spark: SparkSession, path: str, keep: int = 16):
        self.spark, self.path, self.keep = spark, path, keep

    def _files(self, place: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(place)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _numbers(self, part: str, name: str) -> list[int]:
        """Numbers of the complete folders ``name=N`` of a part."""
        files, folder = self._files(f"{self.path}/{part}")
        if not files.exists(folder):
            return []
        found = [f.getPath() for f in files.listStatus(folder) if f.getPath().getName().startswith(f"{name}=")]
        done = [p for p in found if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(int(p.getName().partition("=")[2]) for p in done)

    def write(self, batch: DataFrame, batch_id: int, part: str = "rows", fold: Fold | None = None) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/{part}/batch={batch_id}")
        if fold:
            self._fold(part, fold, batch_id)

    def _fold(self, part: str, fold: Fold, newest: int) -> None:
        states = self._numbers(f"{part}-states", "state")
        last = states[-1] if states else -1
        batches = self._numbers(part, "batch")
        if sum(last < b < newest for b in batches) < self.keep:
            return
        fold(self.read(part=part).filter(F.col("batch") < newest)).write.mode("overwrite").parquet(f"{self.path}/{part}-states/state={newest - 1}")
        # What the state before covers is still there for readers that began with it; what that one covered goes.
        for folder, name, numbers in ((part, "batch", [b for b in batches if b <= last]), (f"{part}-states", "state", states[:-1])):
            for n in numbers:
                files, place = self._files(f"{self.path}/{folder}/{name}={n}")
                files.delete(place, True)

    def read(self, schema: StructType | str | None = None, part: str = "rows") -> DataFrame:
        states = self._numbers(f"{part}-states", "state")
        last = states[-1] if states else -1
        folder = f"{self.path}/{part}"
        after = [f"{folder}/batch={b}" for b in self._numbers(part, "batch") if b > last]
        reader = self.spark.read.option("basePath", folder)
        batches = (reader.schema(schema) if schema else reader).parquet(*(after or [folder]))
        batches = batches.withColumn("batch", F.col("batch").cast("long"))
        if not states:
            return batches
        state = self.spark.read.parquet(f"{folder}-states/state={last}")
        return state.unionByName(batches) if after else state

    def has(self, part: str) -> bool:
        files, place = self._files(f"{self.path}/{part}")
        return files.exists(place)

    def current(self, key: Sequence[str], part: str = "rows") -> DataFrame:
        """Newest row per key over all batches."""
        return newest_rows(self.read(part=part), key).drop("batch")

    def last_batch(self, part: str = "rows") -> DataFrame:
        return only_last_batch(self.read(part=part)).drop("batch")


def newest_rows(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in key and c != "batch"]
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch").alias("_r"), F.max("batch").alias("batch"))
    return best.select(*key, "_r.*", "batch")


def only_last_batch(rows: DataFrame) -> DataFrame:
    last = rows.agg(F.max("batch").alias("_last"))
    return rows.join(F.broadcast(last), F.col("batch") == F.col("_last")).drop("_last")


def event_stream(
    spark: SparkSession, folder: str, pattern: str, schema: StructType, ts: str = "ts", files_per_batch: int | None = None
) -> DataFrame:
    """Files of a folder as a stream; the event time gets a time zone type."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(folder)
    return stream.withColumn(ts, F.col(ts).cast("timestamp")) if ts in stream.columns else stream


#: What a handler raises about its rows: its own errors, and those of expressions and functions.
ROW_FAULTS = (
    ValueError, TypeError, LookupError, ArithmeticError, RuntimeError, PythonException, ArithmeticException,
    ArrayIndexOutOfBoundsException, DateTimeException, NumberFormatException,
)


def run(stream: DataFrame, handler: Callable[[DataFrame, int], None], mode: str = "append", checkpoint: str | None = None):
    """Process all available input through ``handler`` and wait for the end."""
    spark = stream.sparkSession
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint or fresh_path(spark, "offsets"))
        .trigger(availableNow=True)
        .foreachBatch(handler)
        .start()
    )
    query.awaitTermination()
    return query


def to_files(stream: DataFrame, path: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Append a stream to parquet files (exactly once) and read them back."""
    spark = stream.sparkSession
    path = path or fresh_path(spark, "stream")
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint or fresh_path(spark, "offsets"))
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def new_log(spark: SparkSession, name: str, keep: int = 16) -> UpdateLog:
    return UpdateLog(spark, fresh_path(spark, name), keep)


def consume(stream: DataFrame, valid: Column, handle: Callable[[DataFrame], DataFrame], sink: UpdateLog) -> UpdateLog:
    """Handle good rows, set bad ones aside; a handler that fails on its rows stops nothing.

    A batch the handler cannot process is kept whole under ``failed``. Faults
    of the engine, such as lost tables or executors, end the stream, so that its
    offsets do not advance.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        good = batch.filter(F.coalesce(valid, F.lit(False)))
        sink.write(batch.filter(~F.coalesce(valid, F.lit(False))), batch_id, "quarantine")
        try:
            sink.write(handle(good), batch_id)
        except ROW_FAULTS as e:
            log.warning("batch %s failed: %s", batch_id, e)
            sink.write(good, batch_id, "failed")
        batch.unpersist()

    run(stream, step)
    return sink


def score_stream(stream: DataFrame, model: PipelineModel, columns: Sequence[str]) -> DataFrame:
    """Class and probability of each event as it arrives; no state."""
    from ospara.operators.models import class_probability

    return class_probability(model.transform(stream)).select(*columns, "prediction", "confidence")


def action_stream(stream: DataFrame, condition: Column, columns: Sequence[str], steps: Sequence[str]) -> DataFrame:
    return stream.filter(condition).select(*columns, F.array(*[F.lit(s) for s in steps]).alias("steps"))


def latest_state(stream: DataFrame, key: str, order: Sequence[str], columns: Sequence[str], sink: UpdateLog) -> UpdateLog:
    """Last values per entity, kept as one aggregate row of state each.

    The aggregate merges rows on the map side first, so a busy device sends
    one row per task to its state, not its whole traffic.
    """
    newest = stream.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_s")).select(key, "_s.*")
    run(newest, lambda batch, i: sink.write(batch, i, fold=lambda rows: newest_rows(rows, [key])), "update")
    return sink


def histories(stream: DataFrame, key: str, order: Sequence[str], value: str, sink: UpdateLog, limit: int = 500) -> UpdateLog:
    """Tail of each entity's values and their number, batch by batch."""

    def tail(rows: DataFrame) -> DataFrame:
        return top_k(rows, [key], [F.desc(c) for c in order], limit).drop("rank")

    def totals(rows: DataFrame) -> DataFrame:
        return rows.groupBy(key).agg(F.sum("n").alias("n"), F.max("batch").alias("batch"))

    def step(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        sink.write(tail(batch.select(key, *order, value)), batch_id, fold=tail)
        sink.write(batch.groupBy(key).agg(F.count(F.lit(1)).alias("n")), batch_id, "counts", totals)
        batch.unpersist()

    run(stream, step)
    return sink


def history_tail(sink: UpdateLog, key: str, order: Sequence[str], limit: int = 500) -> DataFrame:
    return top_k(sink.read().drop("batch"), [key], [F.desc(c) for c in order], limit)


def history_lengths(sink: UpdateLog, key: str, train_at: int = 60) -> DataFrame:
    """Rows seen per entity, and whether there are enough to train."""
    counts = sink.read(part="counts").groupBy(key).agg(F.sum("n").alias("n"))
    return counts.withColumn("train", F.col("n") >= train_at)


def live_counts(stream: DataFrame, label: Column, sink: UpdateLog) -> UpdateLog:
    counts = stream.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"))
    run(counts, lambda batch, i: sink.write(batch, i, fold=only_last_batch), "complete")
    return sink


def windowed_counts(
    stream: DataFrame, ts: str, delay: str, window: str, slide: str | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Closed event-time windows; an addition to bound the state."""
    slots = F.window(ts, window, slide) if slide else F.window(ts, window)
    return (
        stream.withWatermark(ts, delay).groupBy(slots.alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n", "total")
    )


def session_counts(stream: DataFrame, ts: str, delay: str, gap: str, key: str) -> DataFrame:
    return (
        stream.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("w"), key)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("start"), key, "n")
    )


def unique_events(stream: DataFrame, ts: str, delay: str, key: Sequence[str]) -> DataFrame:
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))


def upsert_stream(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], key: Sequence[str], sink: UpdateLog,
                  order: Sequence[str] | None = None) -> UpdateLog:
    """Transform new records only; a later record replaces one of equal key."""
    from ospara.sources.sinks import newest

    def step(batch: DataFrame, batch_id: int) -> None:
        done = transform(batch)
        sink.write(newest(done, key, order) if order else done, batch_id, fold=lambda rows: newest_rows(rows, key))

    run(stream, step)
    return sink
