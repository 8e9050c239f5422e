"""How the roles of the library map to the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ospara.plans.base import Tables

# Sensor readings: line items rescaled to the value ranges of the rules.
READING_SQL = """
readings AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         l_quantity * 1.4 AS temperature,
         10.0 + l_discount * 20.0 AS voltage,
         l_extendedprice / 500.0 AS current,
         l_quantity * 0.8 AS milk_yield,
         38.0 + l_tax * 25.0 AS cow_temp,
         l_discount * 200.0 AS feed_intake
  FROM lineitem)
"""


def readings(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    q, d, x, p = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax"), F.col("l_extendedprice")
    return (t.lineitem if lines is None else lines).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (q * 1.4).alias("temperature"),
        (F.lit(10.0) + d * 20.0).alias("voltage"),
        (p / 500.0).alias("current"),
        (q * 0.8).alias("milk_yield"),
        (F.lit(38.0) + x * 25.0).alias("cow_temp"),
        (d * 200.0).alias("feed_intake"),
    )


# Incident logs: events as nested JSON records whose fields move about.
INCIDENT_SQL = """
incidents AS (
  SELECT event_id, user_id, ts, event_type, value,
    CASE event_id % 4
      WHEN 0 THEN '{"properties":{"environment":"PROD","error":{"message":"' || event_type || ' failed"}},'
             || '"operationName":{"value":"op-' || event_type || '"},"status":"active","category":"Administrative"}'
      WHEN 1 THEN '{"properties":{"env":"staging"},"operationName":"op-' || event_type
             || '","status":{"value":"resolved"},"category":"Security"}'
      WHEN 2 THEN '{"tags":{"Environment":"Dev"},"operationName":"","status":"active","k":' || props || '}'
      ELSE '{"resourceId":"/subscriptions/uat-' || user_id || '","properties":{"error":{"message":""}},'
             || '"category":"Alert"}'
    END AS payload
  FROM events)
"""


def incidents(t: Tables) -> DataFrame:
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    case = F.pmod("event_id", F.lit(4))
    return t.events.select(
        "event_id", "user_id", "ts", "event_type", "value",
        F.when(
            case == 0,
            F.concat(
                F.lit('{"properties":{"environment":"PROD","error":{"message":"'), kind, F.lit(' failed"}},'),
                F.lit('"operationName":{"value":"op-'), kind,
                F.lit('"},"status":"active","category":"Administrative"}'),
            ),
        )
        .when(
            case == 1,
            F.concat(
                F.lit('{"properties":{"env":"staging"},"operationName":"op-'), kind,
                F.lit('","status":{"value":"resolved"},"category":"Security"}'),
            ),
        )
        .when(
            case == 2,
            F.concat(
                F.lit('{"tags":{"Environment":"Dev"},"operationName":"","status":"active","k":'),
                F.col("props"), F.lit("}"),
            ),
        )
        .otherwise(
            F.concat(
                F.lit('{"resourceId":"/subscriptions/uat-'), user,
                F.lit('","properties":{"error":{"message":""}},"category":"Alert"}'),
            )
        )
        .alias("payload"),
    )


def asof(events: DataFrame, column: str = "ts"):
    """The latest time of a table, as a literal: one small aggregate."""
    return F.lit(events.agg(F.max(column)).first()[0]).cast("timestamp_ntz")
