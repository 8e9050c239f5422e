"""Q01-Q07: relational families reached through plain SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ospara import scale
from ospara.operators import joins
from ospara.plans.base import Tables, plan, rnd
from ospara.sources import registry


def _sql(name: str, query: str, check: str, *views: str) -> None:
    @plan(name, check)
    def build(t: Tables):
        t.views(*views)
        return registry.ingest(t.spark, "sql", query)


_REVENUE = """
SELECT n_name, count(DISTINCT c_custkey) AS customers, count(o_orderkey) AS orders,
       round(coalesce(sum(o_totalprice), 0), 2) AS revenue
FROM nation JOIN customer ON c_nationkey = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey
GROUP BY n_name"""
_sql("q01_equi_joins", _REVENUE, _REVENUE, "nation", "customer", "orders")

_EXISTS = """
SELECT c_custkey, 'open' AS state FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O')
UNION ALL
SELECT c_custkey, 'idle' FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O')"""
_sql("q02_semi_and_anti", _EXISTS, _EXISTS, "customer", "orders")


@plan(
    "q03_range_join",
    """SELECT p.event_id AS purchase_id, count(*) AS before, round(sum(e.value), 2) AS total
       FROM events p JOIN events e ON e.user_id = p.user_id AND e.ts < p.ts AND e.ts >= p.ts - INTERVAL 10 HOUR
       WHERE p.event_type = 'purchase' AND e.event_type <> 'purchase' GROUP BY p.event_id""",
)
def range_join(t: Tables):
    """Other events of a user in the ten hours before each of the purchases."""
    purchases = t.events.filter("event_type = 'purchase'").withColumnRenamed("event_id", "purchase_id")
    others = t.events.filter("event_type <> 'purchase'")
    out = joins.totals_before(purchases, others, "user_id", "ts", "purchase_id", "event_id", "value", 36_000)
    return out.withColumn("total", rnd("total", 2))


_SETS = """
SELECT 'both' AS kind, user_id FROM (
  SELECT user_id FROM events WHERE event_type = 'purchase' INTERSECT SELECT user_id FROM events WHERE event_type = 'signup') a
UNION ALL SELECT 'either', user_id FROM (
  SELECT user_id FROM events WHERE event_type = 'purchase' UNION SELECT user_id FROM events WHERE event_type = 'error') b
UNION ALL SELECT 'only', user_id FROM (
  SELECT user_id FROM events WHERE value > 150 EXCEPT SELECT user_id FROM events WHERE event_type = 'error' AND value > 150) c"""
_sql("q04_set_operations", _SETS, _SETS, "events")

_HAVING = """
WITH means AS (SELECT l_partkey, avg(l_quantity) AS mean FROM lineitem GROUP BY l_partkey HAVING count(*) > 5)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity FROM lineitem l
WHERE l.l_quantity > (SELECT max(mean) * 1.5 FROM means m WHERE m.l_partkey = l.l_partkey)"""
_HAVING_CHECK = _HAVING.replace("1.5", "1.5::DOUBLE")
_sql("q06_having_cte_correlated", _HAVING, _HAVING_CHECK, "lineitem")

_TOP = """
SELECT 'brand' AS kind, p_brand AS item, 0.0 AS amount FROM (SELECT DISTINCT p_brand FROM part) b
UNION ALL SELECT 'order', CAST(o_orderkey AS {text}), o_totalprice FROM (
  SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10) t"""
_sql(
    "q07_distinct_and_top", _TOP.format(text="STRING").replace("0.0 AS", "0.0D AS"),
    _TOP.format(text="VARCHAR").replace("0.0 AS", "0.0::DOUBLE AS"), "part", "orders",
)


@plan(
    "q05_windows",
    """SELECT user_id, event_id, row_number() OVER w AS place,
         coalesce(lag(value) OVER w, -1) AS previous, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
         ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS moving FROM events
       WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def windows(t: Tables):
    """Rank, lag and a moving mean; long histories are worked on in blocks."""
    order = ["ts", "event_id"]
    placed = scale.positions(t.events.select("user_id", *order, "value"), ["user_id"], order)
    blocks = scale.halo_blocks(placed, ["user_id"], order, 6)
    w = Window.partitionBy("user_id", "_blk").orderBy(*order)
    out = blocks.select(
        "user_id", "event_id", F.col("pos").alias("place"), "_halo",
        F.coalesce(F.lag("value").over(w), F.lit(-1.0)).alias("previous"),
        rnd(F.avg("value").over(w.rowsBetween(-6, 0)), 6).alias("moving"),
    )
    return out.filter(~F.col("_halo")).drop("_halo")
