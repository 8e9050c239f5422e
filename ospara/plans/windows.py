"""Sequences and time series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ospara.operators import aggregates, profile, timeseries
from ospara.plans.aggregates import FORECAST_SQL
from ospara.plans.base import Tables, plan, rnd

ORDER = ["ts", "event_id"]


@plan(
    "w01_sequence_windows",
    """SELECT user_id, event_id, y, list_aggregate(list_transform(x, lambda v: CAST(v AS VARCHAR)), 'string_agg', ' ') AS x
       FROM (SELECT user_id, event_id, value AS y, list(value) OVER w AS x FROM events
             WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)) s
       WHERE len(x) = 7""",
)
def sequence_windows(t: Tables):
    pairs = timeseries.sequence_windows(t.events, ["user_id"], ORDER, "value", 7)
    return pairs.select("user_id", "event_id", "y", F.array_join(F.transform("x", lambda v: v.cast("string")), " ").alias("x"))


@plan("w02_seasonal_forecast", f"WITH {FORECAST_SQL} SELECT user_id, step::INTEGER AS step, forecast FROM forecast")
def seasonal_forecast(t: Tables):
    return timeseries.seasonal_forecast(t.events, "user_id", ORDER, "value", 10)


@plan(
    "w03_history_tail",
    """SELECT user_id, event_id, rank::INTEGER AS rank FROM (
         SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank
         FROM events) r WHERE rank <= 50""",
)
def history_tail(t: Tables):
    return timeseries.tail(t.events.select("user_id", *ORDER), ["user_id"], ORDER, 50).select("user_id", "event_id", "rank")


@plan(
    "w04_latest_per_topic",
    """SELECT event_type, event_id, rank::INTEGER AS rank FROM (
         SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rank
         FROM events) r WHERE rank <= 5""",
)
def latest_per_topic(t: Tables):
    recent = timeseries.tail(t.events.select("event_type", *ORDER), ["event_type"], ORDER, 5)
    return recent.select("event_type", "event_id", "rank")


@plan(
    "w05_running_kpis",
    """SELECT event_id, count(*) OVER w AS seen,
         (sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER w)::BIGINT AS errors,
         (sum(CASE WHEN value > 100 THEN 1 ELSE 0 END) OVER w)::BIGINT AS high
       FROM events WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""",
)
def running_kpis(t: Tables):
    labels = {"seen": F.lit(True), "errors": F.col("event_type") == "error", "high": F.col("value") > 100}
    return timeseries.running_counts(t.events, "ts", ORDER, labels).select("event_id", *labels)


@plan(
    "w06_explained_cut",
    """WITH v AS (SELECT i, var_samp(embedding[i]::DOUBLE) AS v FROM embeddings, range(1, 65) r(i) GROUP BY i),
         c AS (SELECT row_number() OVER (ORDER BY v DESC, i)::INTEGER AS component, v / sum(v) OVER () AS share FROM v),
         s AS (SELECT *, sum(share) OVER (ORDER BY component) AS cumulative FROM c)
       SELECT component, round(share, 6) AS share, round(cumulative, 6) AS cumulative,
         coalesce((SELECT min(component) FROM s WHERE cumulative >= 0.9), 64)::INTEGER AS needed FROM s""",
)
def explained_cut(t: Tables):
    from pyspark.sql import Window

    dims = [F.var_samp(F.col("embedding")[i].cast("double")).alias(str(i)) for i in range(64)]
    spread = t.embeddings.agg(F.array(*dims).alias("v")).select(F.posexplode("v").alias("i", "v"))
    ranked = spread.select(
        F.row_number().over(Window.orderBy(F.desc("v"), "i")).alias("component"),
        (F.col("v") / F.sum("v").over(Window.partitionBy())).alias("share"),
    )
    cut = timeseries.explained_cut(ranked, 0.9)
    return cut.select("component", rnd("share", 6).alias("share"), rnd("cumulative", 6).alias("cumulative"), "needed")


@plan(
    "w07_long_form",
    """SELECT l_orderkey, l_linenumber, feature, value FROM (
         SELECT l_orderkey, l_linenumber, unnest(['l_quantity', 'l_discount', 'l_tax']) AS feature,
                unnest([l_quantity, l_discount, l_tax]) AS value FROM lineitem) x""",
)
def long_form(t: Tables):
    return profile.long_form(t.lineitem, ["l_quantity", "l_discount", "l_tax"], ["l_orderkey", "l_linenumber"])


@plan(
    "w08_latest_state",
    """SELECT user_id, arg_max(event_id, ts) AS last_event, arg_max(event_type, ts) AS last_type,
              arg_max(props, ts) AS last_payload, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_seen
       FROM events GROUP BY user_id""",
)
def latest_state(t: Tables):
    state = timeseries.latest_state(t.events, "user_id", ORDER, ["event_id", "event_type", "props", "ts"])
    return state.select(
        "user_id", F.col("event_id").alias("last_event"), F.col("event_type").alias("last_type"),
        F.col("props").alias("last_payload"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("last_seen"),
    )


@plan(
    "w09_best_with_ties",
    """SELECT o_custkey, o_orderkey AS best, score::BIGINT AS score FROM (
         SELECT o_custkey, o_orderkey, floor(o_totalprice / 50000) AS score, row_number() OVER (
           PARTITION BY o_custkey ORDER BY floor(o_totalprice / 50000) DESC, o_orderkey) AS n FROM orders) r WHERE n = 1""",
)
def best_with_ties(t: Tables):
    score = F.floor(F.col("o_totalprice") / 50000)
    trials = t.orders.select("o_custkey", "o_orderkey", score.alias("confidence"), F.col("o_orderkey").alias("method_order"))
    best = aggregates.best_vote(trials, "o_custkey", ["o_orderkey", "confidence"])
    return best.select("o_custkey", F.col("o_orderkey").alias("best"), F.col("confidence").alias("score"))
