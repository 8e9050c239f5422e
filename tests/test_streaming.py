"""Streaming jobs over several micro-batches against batch results."""

import pytest
from pyspark.sql import functions as F

from ospara.session import fresh_path
from ospara.streaming import jobs


@pytest.fixture(scope="module")
def feed(spark):
    """Six files, read one per micro-batch, in time order."""
    path = fresh_path(spark, "feed")
    df = spark.range(600).select(
        F.col("id").alias("event_id"), (F.col("id") % 7).alias("user_id"),
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, cast(id as int))").alias("ts"),
        (F.col("id") % 50).cast("double").alias("value"), F.when(F.col("id") % 3 == 0, "error").otherwise("view").alias("kind"),
    )
    for i in range(6):
        df.filter((F.col("event_id") >= i * 100) & (F.col("event_id") < (i + 1) * 100)).coalesce(1).write.mode("append").parquet(path)
    return path, spark.read.parquet(path)


def stream(spark, feed):
    return jobs.event_stream(spark, feed[0], "*.parquet", feed[1].schema, files_per_batch=1)


def test_state_over_batches(spark, feed):
    sink = jobs.latest_state(stream(spark, feed), "user_id", ["ts", "event_id"], ["event_id", "kind"], jobs.new_log(spark, "s"))
    assert sink.read().select("batch").distinct().count() == 6
    want = {r.user_id: r.e for r in feed[1].groupBy("user_id").agg(F.max("event_id").alias("e")).collect()}
    assert {r.user_id: r.event_id for r in sink.current(["user_id"]).collect()} == want


def test_replayed_batch_changes_nothing(spark, feed):
    sink = jobs.new_log(spark, "h")
    jobs.histories(stream(spark, feed), "user_id", ["ts", "event_id"], "value", sink, 5)
    before = sorted(map(tuple, jobs.history_tail(sink, "user_id", ["ts", "event_id"], 5).collect()))
    third = sink.read().filter("batch = 3").drop("batch")
    sink.write(spark.createDataFrame(third.collect(), third.schema), 3)
    assert sorted(map(tuple, jobs.history_tail(sink, "user_id", ["ts", "event_id"], 5).collect())) == before
    assert len(before) == 35
    lengths = {r.user_id: (r.n, r.train) for r in jobs.history_lengths(sink, "user_id", 86).collect()}
    assert lengths[0] == (86, True) and lengths[6] == (85, False)


def folders(sink, part):
    import pathlib

    return sorted(p.name for p in pathlib.Path(f"{sink.path}/{part}".removeprefix("file:")).glob("*=*"))


def test_folded_logs_stay_small_and_replay_exactly(spark, feed):
    order = ["ts", "event_id"]
    sink = jobs.new_log(spark, "f", keep=2)
    jobs.latest_state(stream(spark, feed), "user_id", order, ["event_id", "kind"], sink)
    want = {r.user_id: r.e for r in feed[1].groupBy("user_id").agg(F.max("event_id").alias("e")).collect()}
    assert {r.user_id: r.event_id for r in sink.current(["user_id"]).collect()} == want
    assert len(folders(sink, "rows")) <= 5 and len(folders(sink, "rows-states")) <= 2
    newest = sink.read().filter("batch = 5").drop("batch")
    sink.write(spark.createDataFrame(newest.collect(), newest.schema), 5, fold=lambda rows: jobs.newest_rows(rows, ["user_id"]))
    assert {r.user_id: r.event_id for r in sink.current(["user_id"]).collect()} == want

    tails = jobs.new_log(spark, "t", keep=1)
    jobs.histories(stream(spark, feed), "user_id", order, "value", tails, 5)
    plain = jobs.histories(stream(spark, feed), "user_id", order, "value", jobs.new_log(spark, "p", keep=100), 5)
    rows = [sorted(map(tuple, jobs.history_tail(x, "user_id", order, 5).collect())) for x in (tails, plain)]
    assert rows[0] == rows[1] and len(rows[0]) == 35
    assert sorted(map(tuple, jobs.history_lengths(tails, "user_id").collect())) == sorted(map(tuple, jobs.history_lengths(plain, "user_id").collect()))
    assert len(folders(tails, "counts")) <= 4 and len(folders(plain, "counts")) == 6


def test_incomplete_state_is_not_read(spark, feed):
    sink = jobs.new_log(spark, "i", keep=100)
    jobs.latest_state(stream(spark, feed), "user_id", ["ts", "event_id"], ["event_id"], sink)
    before = sorted(map(tuple, sink.current(["user_id"]).collect()))
    files, place = sink._files(f"{sink.path}/rows-states/state=3/part-0.parquet")
    files.create(place).close()
    assert sorted(map(tuple, sink.current(["user_id"]).collect())) == before


def test_live_counts(spark, feed):
    sink = jobs.live_counts(stream(spark, feed), F.col("kind"), jobs.new_log(spark, "c"))
    assert {r.label: r.n for r in sink.last_batch().collect()} == {"error": 200, "view": 400}


def test_failing_handler_and_bad_rows(spark, feed):
    def handler(batch):
        if batch.filter("event_id = 250").count():
            raise RuntimeError("no")
        return batch.select("event_id")

    sink = jobs.consume(stream(spark, feed), F.col("event_id") % 10 != 0, handler, jobs.new_log(spark, "b"))
    assert sink.read(part="quarantine").count() == 60
    ok, failed = sink.read().count(), 0
    try:
        failed = sink.read(part="failed").count()
    except Exception:  # noqa: BLE001
        pass
    assert ok + failed == 540

    def broken(batch):
        if batch.filter("event_id = 251").count():
            raise RuntimeError("no")
        return batch.select("event_id")

    sink = jobs.consume(stream(spark, feed), F.lit(True), broken, jobs.new_log(spark, "b"))
    assert sink.read().count() == 500 and sink.read(part="failed").count() == 100


def test_restart_continues_from_checkpoint(spark, feed):
    checkpoint, sink = fresh_path(spark, "cp"), jobs.new_log(spark, "r")
    for _ in range(2):
        jobs.run(stream(spark, feed), lambda b, i: sink.write(b.select("event_id"), i), checkpoint=checkpoint)
    assert sink.read().count() == 600


def test_windows_close_and_late_rows_drop(spark):
    path = fresh_path(spark, "late")
    at = lambda m: f"2024-01-01 00:{m:02d}:00"
    batches = [[(1, at(1)), (2, at(4))], [(3, at(30))], [(7, at(31))], [(4, at(2)), (5, at(41))], [(6, at(59))]]
    schema = "event_id long, t string"
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, schema).select("event_id", F.col("t").cast("timestamp_ntz").alias("ts"), F.lit(1.0).alias("value"))
        df.coalesce(1).write.mode("append").parquet(path)
    s = jobs.event_stream(spark, path, "*.parquet", df.schema, files_per_batch=1)
    out = jobs.to_files(jobs.windowed_counts(s, "ts", "5 minutes", "10 minutes")).orderBy("start").collect()
    assert [(r.start.minute, r.n) for r in out] == [(0, 2), (30, 2), (40, 1)]


def test_duplicates_across_batches(spark, feed):
    twice = stream(spark, feed).unionByName(stream(spark, feed))
    out = jobs.to_files(jobs.unique_events(twice, "ts", "2 hours", ["event_id"]))
    assert out.count() == 600 and out.select("event_id").distinct().count() == 600


def test_upsert_over_batches(spark, feed):
    double = lambda b: b.select("user_id", "event_id", (F.col("value") * 2).alias("score"))
    sink = jobs.upsert_stream(stream(spark, feed), double, ["user_id"], jobs.new_log(spark, "u"), ["event_id"])
    got = sink.current(["user_id"]).collect()
    assert len(got) == 7 and max(r.event_id for r in got) == 599
