"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ospara.functions import jsonfields, rules
from ospara.operators import filters
from ospara.plans.base import Tables, plan, rnd
from ospara.plans.bindings import INCIDENT_SQL, READING_SQL, asof, incidents, readings

FAULTS = rules.limits(rules.FAULT_RULES)
FAULT_CASE = """CASE WHEN temperature > 60 THEN 'Overheat' WHEN voltage < 10.5 THEN 'Undervoltage'
  WHEN current > 150 THEN 'Power Surge' WHEN current < 80 THEN 'Low Power' ELSE 'Normal' END"""


@plan("p01_feature_projection", "SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem")
def feature_projection(t: Tables):
    return filters.select_features(t.lineitem, ["l_orderkey", "l_linenumber", "l_quantity", "l_discount"])


@plan(
    "p02_numeric_columns",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
       FROM lineitem""",
)
def numeric_selection(t: Tables):
    return t.lineitem.select(*filters.numeric_columns(t.lineitem))


@plan("p03_feature_exclusion", "SELECT p_size, p_retailprice FROM part")
def feature_exclusion(t: Tables):
    named = t.part.withColumn("humidity", F.lit(1.0)).withColumn("plant_load", F.lit(1.0))
    named = named.withColumn("p_id", F.col("p_partkey")).drop("p_partkey")
    return named.select(*filters.usable_features(named))


def add_price_band(df):
    """A metadata provider: price band of an order."""
    return df.withColumn("price_band", F.when(F.col("o_totalprice") > 250000, "high").otherwise("low"))


@plan(
    "p04_metadata_enrichment",
    """SELECT o_orderkey, o_totalprice,
              CASE WHEN o_totalprice > 250000 THEN 'high' ELSE 'low' END AS price_band FROM orders""",
)
def metadata_enrichment(t: Tables):
    base = t.orders.select("o_orderkey", "o_totalprice")
    return filters.enrich(base, "ospara.plans.predicates:add_price_band")


@plan(
    "p05_threshold_label",
    f"""WITH {READING_SQL} SELECT l_orderkey, l_linenumber, milk_yield, cow_temp, feed_intake,
          milk_yield < 10 OR milk_yield > 32 OR cow_temp > 39.5 OR feed_intake < 8 AS abnormal FROM readings""",
)
def threshold_label(t: Tables):
    milk, temp, feed = F.col("milk_yield"), F.col("cow_temp"), F.col("feed_intake")
    abnormal = (
        (milk < rules.MILK_LOW) | (milk > rules.MILK_HIGH) | (temp > rules.COW_TEMP_HIGH) | (feed < rules.FEED_LOW)
    )
    return readings(t).select(
        "l_orderkey", "l_linenumber", "milk_yield", "cow_temp", "feed_intake", abnormal.alias("abnormal")
    )


@plan(
    "p06_fault_label",
    f"""WITH {READING_SQL} SELECT l_orderkey, l_linenumber, temperature, voltage, current,
          {FAULT_CASE} AS fault FROM readings""",
)
def fault_label(t: Tables):
    return readings(t).select(
        "l_orderkey", "l_linenumber", "temperature", "voltage", "current", rules.fault_label(FAULTS).alias("fault")
    )


@plan(
    "p07_fault_explanation",
    f"""WITH {READING_SQL}, labelled AS (SELECT *, {FAULT_CASE} AS fault FROM readings)
        SELECT l_orderkey, l_linenumber, fault,
          CASE fault WHEN 'Overheat' THEN 'temperature' WHEN 'Undervoltage' THEN 'voltage'
            WHEN 'Power Surge' THEN 'current' WHEN 'Low Power' THEN 'current' ELSE 'None' END AS feature,
          CASE fault WHEN 'Overheat' THEN 'Increase cooling, check fan/AC'
            WHEN 'Undervoltage' THEN 'Check supply line & transformer'
            WHEN 'Power Surge' THEN 'Inspect breakers & load'
            WHEN 'Low Power' THEN 'Check load distribution' ELSE 'No action needed' END AS advice,
          coalesce(CASE fault WHEN 'Overheat' THEN temperature WHEN 'Undervoltage' THEN voltage
            WHEN 'Normal' THEN NULL ELSE current END, -1.0) AS reading
        FROM labelled""",
)
def fault_explanation(t: Tables):
    parts = rules.fault_explanation(FAULTS)
    return readings(t).select(
        "l_orderkey", "l_linenumber", rules.fault_label(FAULTS).alias("fault"),
        parts["feature"].alias("feature"), parts["advice"].alias("advice"),
        F.coalesce(parts["reading"].try_cast("double"), F.lit(-1.0)).alias("reading"),
    )


@plan(
    "p08_baseline_deviation",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
         CASE WHEN l_quantity > 25.0 * 1.1 OR l_quantity < 25.0 * 0.9 THEN 'Red' ELSE 'Green' END AS quantity_flag,
         CASE WHEN l_extendedprice > 38000.0 * 1.1 OR l_extendedprice < 38000.0 * 0.9
              THEN 'Red' ELSE 'Green' END AS price_flag
       FROM lineitem""",
)
def baseline_deviation(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
        rules.deviation_flag("l_quantity", 25.0).alias("quantity_flag"),
        rules.deviation_flag("l_extendedprice", 38000.0).alias("price_flag"),
    )


@plan(
    "p09_metric_trigger",
    """SELECT event_id, value, '{"cpu":85}' AS alert_threshold, CASE WHEN value > 85 THEN 1 ELSE 0 END AS triggered
       FROM events""",
)
def metric_trigger(t: Tables):
    limited = t.events.select("event_id", "value", F.lit('{"cpu":85}').alias("alert_threshold"))
    limit = F.get_json_object("alert_threshold", "$.cpu").cast("double")
    return limited.withColumn("triggered", F.when(F.col("value") > limit, 1).otherwise(0))


@plan(
    "p10_active_records",
    f"""WITH {INCIDENT_SQL} SELECT event_id, status, category FROM (
          SELECT event_id, coalesce(json_extract_string(payload, '$.status.value'),
                   json_extract_string(payload, '$.status')) AS status,
                 json_extract_string(payload, '$.category') AS category FROM incidents) r
        WHERE status <> 'resolved'""",
)
def active_records(t: Tables):
    status = jsonfields.text_or_value("payload", "status")
    return (
        incidents(t)
        .select("event_id", status.alias("status"), F.get_json_object("payload", "$.category").alias("category"))
        .filter(F.col("status") != "resolved")
    )


@plan(
    "p11_recent_alerts",
    """SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS reading, value
       FROM events WHERE value > 85 AND ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR""",
)
def recent_alerts(t: Tables):
    recent = filters.time_range(t.events, "ts", asof(t.events), 1)
    return recent.filter("value > 85").select(
        "event_id", "user_id", F.get_json_object("props", "$.k").cast("bigint").alias("reading"), "value"
    )


@plan(
    "p12_audit_query",
    """SELECT event_id, event_type, user_id FROM (
         SELECT *, CASE WHEN event_type = 'error' THEN 'HIGH' ELSE 'LOW' END AS severity,
           event_type || ' by user ' || user_id AS description,
           CAST(json_extract(props, '$.k') AS VARCHAR) AS k FROM events) e
       WHERE event_type IN ('error', 'purchase', 'view') AND severity IN ('HIGH', 'LOW')
         AND ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-25 00:00:00'
         AND (contains(lower(description), '42') OR contains(lower(event_type), '42')
              OR contains(CAST(user_id AS VARCHAR), '42') OR contains(lower(k), '42'))""",
)
def audit_query(t: Tables):
    events = t.events.select(
        "event_id", "event_type", "user_id", "ts",
        F.when(F.col("event_type") == "error", "HIGH").otherwise("LOW").alias("severity"),
        F.concat("event_type", F.lit(" by user "), F.col("user_id").cast("string")).alias("description"),
        F.from_json("props", "map<string,string>").alias("metadata"),
    )
    return filters.audit_query(
        events, types=["error", "purchase", "view"], severities=["HIGH", "LOW"],
        start="2024-01-05 00:00:00", end="2024-01-25 00:00:00", search="42",
    ).select("event_id", "event_type", "user_id")


@plan(
    "p13_time_range",
    """SELECT d AS days, count(*) AS n, round(sum(value), 2) AS total
       FROM events, (VALUES (1), (7), (30)) r(d)
       WHERE ts >= (SELECT max(ts) FROM events) - to_days(d) GROUP BY d""",
)
def time_range(t: Tables):
    last = asof(t.events)
    days = {"1": 1, "7": 7, "30": 30}
    inside = {d: F.col("ts") >= last - F.expr(f"interval {n} days") for d, n in days.items()}
    wide = t.events.agg(
        *[F.struct(F.lit(int(d)).alias("days"), F.count_if(c).alias("n"),
                   F.sum(F.when(c, F.col("value"))).alias("total")).alias(d) for d, c in inside.items()]
    )
    return wide.select(F.inline(F.array(*days))).select("days", "n", rnd("total", 2).alias("total"))


@plan("p14_metadata_filter", "SELECT vec_id, label FROM embeddings WHERE label = 3")
def metadata_filter(t: Tables):
    return filters.metadata_filter(t.embeddings.select("vec_id", "label"), {"label": 3})


@plan(
    "p15_document_filter",
    "SELECT doc_id, source, n_chars FROM documents WHERE lang = 'en' AND contains(text, 'the')",
)
def document_filter(t: Tables):
    hits = filters.metadata_filter(t.documents, {"lang": "en"}).filter(F.col("text").contains("the"))
    return hits.select("doc_id", "source", "n_chars")


MISSING_SQL = """
joined AS (
  SELECT o_orderkey, o_totalprice, s.l_quantity, s.l_tax FROM orders
  LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS l_quantity, max(l_tax) AS l_tax
             FROM lineitem WHERE l_quantity > 30 GROUP BY l_orderkey) s ON l_orderkey = o_orderkey)
"""


def orders_with_gaps(t: Tables):
    sums = (
        t.lineitem.filter("l_quantity > 30").groupBy("l_orderkey")
        .agg(F.sum("l_quantity").alias("l_quantity"), F.max("l_tax").alias("l_tax"))
    )
    orders = t.orders.select("o_orderkey", "o_totalprice")
    return orders.join(sums, F.col("l_orderkey") == F.col("o_orderkey"), "left").drop("l_orderkey")


@plan(
    "p16_missing_values",
    f"""WITH {MISSING_SQL}, c AS (SELECT count(*) n, count(*) - count(o_totalprice) a,
            count(*) - count(l_quantity) b, count(*) - count(l_tax) d FROM joined)
        SELECT 'o_totalprice' AS feature, a AS missing, round(a * 100.0 / n, 6) AS percent FROM c
        UNION ALL SELECT 'l_quantity', b, round(b * 100.0 / n, 6) FROM c
        UNION ALL SELECT 'l_tax', d, round(d * 100.0 / n, 6) FROM c""",
)
def missing_values(t: Tables):
    report = filters.missing_report(orders_with_gaps(t), ["o_totalprice", "l_quantity", "l_tax"])
    return report.withColumn("percent", rnd("percent", 6))


@plan(
    "p17_json_validity",
    """SELECT event_type, sum(CASE WHEN json_valid(doc) THEN 1 ELSE 0 END)::BIGINT AS good,
              sum(CASE WHEN json_valid(doc) THEN 0 ELSE 1 END)::BIGINT AS quarantined
       FROM (SELECT event_type, CASE WHEN event_id % 7 = 0 THEN substr(props, 1, 4) ELSE props END AS doc
             FROM events) e GROUP BY event_type""",
)
def json_validity(t: Tables):
    docs = t.events.select(
        "event_type",
        F.when(F.pmod("event_id", F.lit(7)) == 0, F.substring("props", 1, 4)).otherwise(F.col("props")).alias("doc"),
    )
    good, bad = filters.split_json(docs, "doc")
    tagged = good.select("event_type", F.lit(True).alias("ok")).unionByName(
        bad.select("event_type", F.lit(False).alias("ok"))
    )
    return tagged.groupBy("event_type").agg(
        F.count_if("ok").alias("good"), F.count_if(~F.col("ok")).alias("quarantined")
    )


@plan(
    "p18_event_routing",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 'model'
              WHEN event_type = 'purchase' THEN 'vision' ELSE 'log' END AS route FROM events""",
)
def event_routing(t: Tables):
    routes = {"model": ["click", "view"], "vision": ["purchase"]}
    return t.events.select("event_id", filters.route(F.col("event_type"), routes, "log").alias("route"))


@plan(
    "p19_trigger_action",
    """SELECT doc_id, 'investigate' AS decision, substr(text, 1, 300) AS reason FROM documents
       WHERE contains(lower(text), 'worthless') OR contains(lower(text), 'urgent') OR contains(lower(text), 'the the')""",
)
def trigger_action(t: Tables):
    return filters.trigger_actions(t.documents, "text", "doc_id", ["worthless", "urgent", "the the"])


@plan(
    "p20_anomaly_action",
    """SELECT event_id, user_id, 'isolate|inspect|notify' AS steps FROM events WHERE event_type = 'error' AND value > 60""",
)
def anomaly_action(t: Tables):
    steps = F.array(*[F.lit(s) for s in ("isolate", "inspect", "notify")])
    anomalies = t.events.filter("event_type = 'error' AND value > 60")
    return anomalies.select("event_id", "user_id", F.array_join(steps, "|").alias("steps"))


@plan(
    "p21_prompt_context",
    """SELECT o_orderkey, 'o_orderkey: ' || o_orderkey || chr(10) || 'o_orderstatus: ' || o_orderstatus || chr(10)
         || 'o_orderpriority: ' || o_orderpriority AS context FROM orders""",
)
def prompt_context(t: Tables):
    return filters.prompt_context(
        t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"),
        "o_orderkey", exclude=["o_custkey", "o_totalprice"],
    )
