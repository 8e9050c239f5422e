"""Streaming jobs run over the event files, compared with batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ospara.functions import rules
from ospara.operators import models
from ospara.plans.base import Tables, plan, rnd
from ospara.streaming import jobs

ORDER = ["ts", "event_id"]


def events(t: Tables, name: str = "events"):
    schema = getattr(t, name).schema
    return jobs.event_stream(t.spark, t.folder, f"{name}.parquet", schema)


@plan(
    "k01_publish_subscribe",
    """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'quarantine' ELSE 'handled' END AS state,
         CASE WHEN event_id % 7 = 0 THEN -1 ELSE json_extract(props, '$.k')::BIGINT END AS k FROM events""",
)
def publish_subscribe(t: Tables):
    payload = F.when(F.col("event_id") % 7 == 0, F.substring("props", 1, 4)).otherwise(F.col("props"))
    stream = events(t).select("event_id", payload.alias("payload"))
    valid = F.expr("try_parse_json(payload) is not null")
    handle = lambda b: b.select("event_id", F.get_json_object("payload", "$.k").cast("long").alias("k"))
    sink = jobs.consume(stream, valid, handle, jobs.new_log(t.spark, "bus"))
    handled = sink.read().select("event_id", F.lit("handled").alias("state"), "k")
    aside = sink.read(part="quarantine").select(
        "event_id", F.lit("quarantine").alias("state"), F.lit(-1).cast("long").alias("k")
    )
    parts = handled.unionByName(aside)
    if sink.has("failed"):
        lost = F.lit(None).cast("long").alias("k")
        parts = parts.unionByName(sink.read(part="failed").select("event_id", F.lit("failed").alias("state"), lost))
    return parts


@plan("k02_score_in_flight")
def score_in_flight(t: Tables):
    labelled = t.events.select("event_id", "value", (F.col("event_id") % 24).cast("double").alias("hour"),
                               (F.col("value") > 80).cast("double").alias("label"))
    model = models.anomaly_model(labelled, ["value", "hour"], "label", trees=10)
    stream = events(t).select("event_id", "value", (F.col("event_id") % 24).cast("double").alias("hour"))
    return jobs.to_files(jobs.score_stream(stream, model, ["event_id", "value"]))


@plan("k02_stream_equals_batch", "SELECT event_id, true AS same FROM events")
def stream_equals_batch(t: Tables):
    """Every event is scored in flight, and as a batch of the same model scores it."""
    columns = ["event_id", "value", (F.col("event_id") % 24).cast("double").alias("hour")]
    marked = t.events.select(*columns, (F.col("value") > 80).cast("double").alias("label"))
    model = models.anomaly_model(marked, ["value", "hour"], "label", trees=5)
    streamed = jobs.to_files(jobs.score_stream(events(t).select(*columns), model, ["event_id"]))
    batch = models.class_probability(model.transform(marked)).select(
        "event_id", F.col("prediction").alias("p"), F.col("confidence").alias("c"))
    same = F.col("prediction").eqNullSafe(F.col("p")) & F.col("confidence").eqNullSafe(F.col("c"))
    return streamed.join(batch, "event_id", "full").select("event_id", same.alias("same"))


@plan(
    "k03_anomaly_actions",
    "SELECT event_id, user_id, 'isolate|inspect|notify' AS steps FROM events WHERE event_type = 'error' AND value > 60",
)
def anomaly_actions(t: Tables):
    condition = (F.col("event_type") == "error") & (F.col("value") > 60)
    actions = jobs.action_stream(events(t), condition, ["event_id", "user_id"], ["isolate", "inspect", "notify"])
    return jobs.to_files(actions.withColumn("steps", F.array_join("steps", "|")))


@plan(
    "k04_device_state",
    """SELECT user_id, arg_max(event_id, ts) AS event_id, arg_max(event_type, ts) AS event_type, arg_max(props, ts) AS props
       FROM events GROUP BY user_id""",
)
def device_state(t: Tables):
    sink = jobs.latest_state(events(t), "user_id", ORDER, ["event_id", "event_type", "props"], jobs.new_log(t.spark, "state"))
    return sink.current(["user_id"])


@plan(
    "k05_history",
    """SELECT user_id, event_id, value, rank::INTEGER AS rank, n, n >= 60 AS train FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank,
                count(*) OVER (PARTITION BY user_id) AS n FROM events) x WHERE rank <= 50""",
)
def history(t: Tables):
    sink = jobs.histories(events(t), "user_id", ORDER, "value", jobs.new_log(t.spark, "history"), 50)
    tail = jobs.history_tail(sink, "user_id", ORDER, 50)
    return tail.join(jobs.history_lengths(sink, "user_id"), "user_id").select(
        "user_id", "event_id", "value", "rank", "n", "train"
    )


@plan("k06_live_counts", "SELECT event_type AS label, count(*) AS n FROM events GROUP BY event_type")
def live_counts(t: Tables):
    return jobs.live_counts(events(t), F.col("event_type"), jobs.new_log(t.spark, "kpi")).last_batch()


WATERMARK = "(SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"


@plan(
    "k07_tumbling_windows",
    f"""SELECT strftime(w, '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n, round(sum(value), 2) AS total
        FROM (SELECT date_trunc('hour', ts) AS w, event_type, value FROM events) x
        WHERE w + INTERVAL 1 HOUR <= {WATERMARK} GROUP BY w, event_type""",
)
def tumbling_windows(t: Tables):
    out = jobs.to_files(jobs.windowed_counts(events(t), "ts", "10 minutes", "1 hour", None, ["event_type"]))
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", rnd("total", 2).alias("total"))


@plan(
    "k07_sliding_windows",
    f"""SELECT strftime(w, '%Y-%m-%d %H:%M') AS start, count(*) AS n, round(sum(value), 2) AS total
        FROM (SELECT date_trunc('hour', ts) - to_hours(o::INTEGER) AS w, value FROM events, range(0, 2) r(o)) x
        WHERE w + INTERVAL 2 HOUR <= {WATERMARK} GROUP BY w""",
)
def sliding_windows(t: Tables):
    out = jobs.to_files(jobs.windowed_counts(events(t), "ts", "10 minutes", "2 hours", "1 hour"))
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "n", rnd("total", 2).alias("total"))


@plan(
    "k07_session_windows",
    f"""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events
                   WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
             s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
        SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, sid
        HAVING max(ts) + INTERVAL 30 MINUTE <= {WATERMARK}""",
)
def session_windows(t: Tables):
    out = jobs.to_files(jobs.session_counts(events(t), "ts", "10 minutes", "30 minutes", "user_id"))
    return out.select("user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@plan("k08_unique_events", "SELECT event_id, user_id, value FROM events")
def unique_events(t: Tables):
    twice = events(t).unionByName(events(t))
    return jobs.to_files(jobs.unique_events(twice, "ts", "1 hour", ["event_id"])).select("event_id", "user_id", "value")


@plan(
    "k09_device_commands",
    """SELECT user_id, arg_max(event_id, ts) AS command_id, arg_max(event_type, ts) AS command
       FROM events WHERE event_type IN ('click', 'signup') GROUP BY user_id""",
)
def device_commands(t: Tables):
    commands = events(t).filter(F.col("event_type").isin("click", "signup"))
    sink = jobs.latest_state(commands, "user_id", ORDER, ["event_id", "event_type"], jobs.new_log(t.spark, "commands"))
    return sink.current(["user_id"]).select(
        "user_id", F.col("event_id").alias("command_id"), F.col("event_type").alias("command")
    )


@plan(
    "k10_streaming_upsert",
    """SELECT o_custkey, o_orderkey, CASE WHEN s >= 80 THEN 'S1' WHEN s >= 60 THEN 'S2' WHEN s >= 40 THEN 'S3' ELSE 'S4' END AS level
       FROM (SELECT o_custkey, o_orderkey, o_totalprice / 5000 AS s,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) x WHERE n = 1""",
)
def streaming_upsert(t: Tables):
    schema = t.orders.schema
    stream = jobs.event_stream(t.spark, t.folder, "orders.parquet", schema, ts="o_orderdate")
    score = lambda b: b.select(
        "o_custkey", "o_orderkey", "o_orderdate", rules.severity_bucket(F.col("o_totalprice") / 5000).alias("level")
    )
    sink = jobs.upsert_stream(stream, score, ["o_custkey"], jobs.new_log(t.spark, "scores"), ["o_orderdate", "o_orderkey"])
    return sink.current(["o_custkey"]).select("o_custkey", "o_orderkey", "level")
