"""Joins and set-like combinations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ospara.operators import access, classify, clustering, joins, monitor, timeseries
from ospara.plans.aggregates import CENTER_SQL, DIMS, label_queries
from ospara.plans.base import Tables, plan, rnd


@plan(
    "j01_not_yet_scored",
    """SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT EXISTS (
         SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
)
def not_yet_scored(t: Tables):
    return joins.not_yet_in(t.orders.select("o_orderkey", "o_orderstatus"), t.lineitem, "o_orderkey", "l_orderkey")


@plan(
    "j02_rule_similarity",
    f"""WITH {CENTER_SQL}, s AS (SELECT vec_id, c.label AS rule, list_cosine_similarity(embedding::DOUBLE[], c) AS s
          FROM embeddings, centers c) SELECT vec_id, rule, round(s, 6) AS similarity FROM s WHERE s >= 0.2""",
)
def rule_similarity(t: Tables):
    names, matrix = label_queries(t)
    hits = joins.rule_matches(t.embeddings, "vec_id", "embedding", names, matrix, 0.2)
    return hits.withColumn("similarity", rnd("similarity", 6))


# Word boundaries that treat letters of any language as letters.
EDGE_L, EDGE_R = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"


def rule_case(column: str) -> str:
    arms = []
    for r in classify.by_priority(classify.CLASS_RULES):
        body = r.pattern.removeprefix(r"\b").removesuffix(r"\b")
        arms.append(f"WHEN regexp_matches(text, '(?i){EDGE_L}{body}{EDGE_R}') THEN '{getattr(r, column)}'")
    return "CASE " + " ".join(arms) + " ELSE 'none' END"


@plan(
    "j03_keyword_rules",
    f"SELECT doc_id, {rule_case('domain')} AS domain, {rule_case('category')} AS category FROM documents",
)
def keyword_rules(t: Tables):
    found = t.texts.select("doc_id", classify.rule_classification("text").alias("c"))
    return found.select(
        "doc_id", F.coalesce("c.domain", F.lit("none")).alias("domain"),
        F.coalesce("c.category", F.lit("none")).alias("category"),
    )


CENTROIDS = ", ".join(f"round(c[{i + 1}], 6) + 0.0 AS centroid_{i}" for i in range(DIMS))
FEATURES = ", ".join(f"embedding[{i + 1}]::DOUBLE AS f{i}" for i in range(DIMS))


@plan(
    "j04_sizes_with_centroids",
    f"""WITH {CENTER_SQL}, s AS (SELECT label, count(*) AS size FROM embeddings GROUP BY label)
        SELECT label, size, {CENTROIDS} FROM s LEFT JOIN centers USING (label)""",
)
def sizes_with_centroids(t: Tables):
    sizes = t.embeddings.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    from ospara.functions import vectors

    centers = vectors.group_means(t.embeddings, "label", "embedding").drop("size")
    return sizes.join(centers, "label", "left").select(
        "label", "size", *[rnd(F.col("center")[i], 6).alias(f"centroid_{i}") for i in range(DIMS)]
    )


@plan(
    "j05_labels_by_key",
    f"""WITH {CENTER_SQL}, d AS (SELECT vec_id, e.label, c.label AS cluster, list_distance(embedding::DOUBLE[], c.c) AS dist,
          row_number() OVER (PARTITION BY vec_id ORDER BY list_distance(embedding::DOUBLE[], c.c), c.label) AS n
          FROM embeddings e, centers c)
        SELECT vec_id, label, cluster, round(dist, 6) AS distance_to_center FROM d WHERE n = 1""",
)
def labels_by_key(t: Tables):
    names, matrix = label_queries(t)
    out = clustering.assign(t.embeddings, "embedding", names, matrix)
    return out.select("vec_id", "label", "cluster", rnd("distance_to_center", 6).alias("distance_to_center"))


ROLE_SQL = """
users AS (SELECT c_custkey AS user_id, c_mktsegment AS segment, c_nationkey AS nation FROM customer),
held AS (SELECT user_id, CASE segment WHEN 'BUILDING' THEN 'analyst' WHEN 'MACHINERY' THEN 'operator'
                 WHEN 'FURNITURE' THEN 'ghost' ELSE 'viewer' END AS role FROM users
         UNION ALL SELECT user_id, 'deleter' FROM users WHERE nation < 5
         UNION ALL SELECT user_id, 'root' FROM users WHERE nation = 24),
granted AS (SELECT user_id, p FROM held JOIN (VALUES ('viewer', 'read'), ('analyst', 'read'), ('analyst', 'write'),
              ('operator', 'write'), ('deleter', 'delete'), ('root', 'admin')) r(role, p) USING (role))
"""


def users(t: Tables):
    """Customers as users: roles from their segment and nation, and attributes."""
    seg, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    main = F.when(seg == "BUILDING", "analyst").when(seg == "MACHINERY", "operator").when(
        seg == "FURNITURE", "ghost").otherwise("viewer")
    roles = F.array_compact(F.array(main, F.when(nation < 5, F.lit("deleter")), F.when(nation == 24, F.lit("root"))))
    return t.customer.select(
        F.col("c_custkey").alias("user_id"), roles.alias("roles"),
        F.create_map(
            F.lit("segment"), F.array(seg), F.lit("nation"), F.array(nation.cast("string"))
        ).alias("attributes"),
    )


DECISION_SQL = f"""
{ROLE_SQL},
decisions AS (
  SELECT user_id, segment, nation,
    EXISTS (SELECT 1 FROM granted g WHERE g.user_id = u.user_id AND p = 'admin')
    OR (EXISTS (SELECT 1 FROM granted g WHERE g.user_id = u.user_id AND p = 'read')
        AND CASE WHEN nation = 7 THEN false WHEN segment = 'BUILDING' THEN true
                 WHEN segment IN ('BUILDING', 'AUTOMOBILE') AND nation IN (1, 2, 3) THEN false ELSE true END) AS allowed
  FROM users u)
"""


def policies(t: Tables):
    """Policies by position: a deny before an allow."""
    rows = [
        (1, "deny", ["write", "read"], '{"nation":["7"]}'),
        (2, "allow", ["read"], '{"segment":["BUILDING"]}'),
        (3, "deny", ["read"], '{"segment":["BUILDING","AUTOMOBILE"],"nation":["1","2","3"]}'),
        (4, "deny", ["delete"], '{"region":["0"]}'),
    ]
    return t.spark.createDataFrame(rows, "position int, effect string, permissions array<string>, conditions_json string")


def roles(t: Tables):
    """Role table; the names stand for what an administrator would enter."""
    rows = [("viewer", ["read"]), ("analyst", ["read", "write"]), ("operator", ["write"]),
            ("deleter", ["delete"]), ("root", ["admin"])]
    return t.spark.createDataFrame(rows, "role string, permissions array<string>")


@plan(
    "j06_role_permissions",
    f"""WITH {ROLE_SQL} SELECT u.user_id, coalesce(string_agg(DISTINCT p, ',' ORDER BY p), '') AS permissions
        FROM users u LEFT JOIN granted g ON g.user_id = u.user_id GROUP BY u.user_id""",
)
def role_permissions(t: Tables):
    held = access.user_permissions(users(t), roles(t))
    return held.select("user_id", F.array_join("permissions", ",").alias("permissions"))


@plan(
    "j07_attribute_row_filter",
    """SELECT doc_id FROM documents WHERE (n_chars <= 1000 OR lang IN ('en', 'fr'))
         AND (doc_id % 3 <> 0 OR source IN ('src1', 'src2', 'src3', 'src4')) AND doc_id % 11 <> 0""",
)
def attribute_row_filter(t: Tables):
    need = F.map_from_entries(
        F.array_compact(
            F.array(
                F.when(F.col("n_chars") > 1000, F.struct(F.lit("lang").alias("k"), F.array("lang").alias("v"))),
                F.when(F.col("doc_id") % 3 == 0, F.struct(F.lit("source").alias("k"), F.array("source").alias("v"))),
                F.when(F.col("doc_id") % 11 == 0, F.struct(F.lit("vault").alias("k"), F.array(F.lit("x")).alias("v"))),
            )
        )
    )
    owned = F.create_map(
        F.lit("lang"), F.array(F.lit("en"), F.lit("fr")),
        F.lit("source"), F.array(*[F.lit(f"src{i}") for i in (1, 2, 3, 4)]),
    )
    docs = t.documents.select("doc_id", need.alias("required_attributes"))
    return access.visible_rows(docs, "required_attributes", owned).select("doc_id")


@plan(
    "j08_tagged_activity",
    """SELECT event_type AS activity_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, value
       FROM events WHERE event_type IN ('view', 'click', 'error', 'purchase')""",
)
def tagged_activity(t: Tables):
    parts = {
        kind: t.events.filter(F.col("event_type") == kind).select("event_id", "ts", "value")
        for kind in ("view", "click", "error", "purchase")
    }
    stacked = monitor.tagged_union(parts, "activity_type").orderBy("ts", "event_id")
    return stacked.select("activity_type", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "value")


@plan(
    "j09_row_append",
    """SELECT event_id, user_id, value FROM events UNION ALL
       SELECT o_orderkey, o_custkey, o_totalprice FROM orders""",
)
def row_append(t: Tables):
    new = t.orders.select(F.col("o_orderkey").alias("event_id"), F.col("o_custkey").alias("user_id"),
                          F.col("o_totalprice").alias("value"))
    return joins.append_rows([t.events.select("event_id", "user_id", "value"), new])


@plan(
    "j10_last_wins_merge",
    """SELECT user_id, coalesce(arg_max(value, ts) FILTER (WHERE event_type = 'purchase'), -1) AS last_purchase,
         coalesce(arg_max(event_id, ts) FILTER (WHERE event_type = 'error'), -1) AS last_error,
         arg_max(props, ts) AS last_props FROM events GROUP BY user_id""",
)
def last_wins_merge(t: Tables):
    kind = F.col("event_type")
    patches = t.events.select(
        "user_id", "ts", "event_id", F.when(kind == "purchase", F.col("value")).alias("last_purchase"),
        F.when(kind == "error", F.col("event_id")).alias("last_error"), F.col("props").alias("last_props"),
    )
    merged = timeseries.merge_fields(patches, "user_id", ["ts", "event_id"], ["last_purchase", "last_error", "last_props"])
    return merged.fillna({"last_purchase": -1.0, "last_error": -1})


@plan(
    "j11_feature_blocks",
    f"""WITH {CENTER_SQL} SELECT vec_id, {FEATURES}, label,
          round(list_distance(embedding::DOUBLE[], c), 6) AS distance FROM embeddings JOIN centers USING (label)""",
)
def feature_blocks(t: Tables):
    stats = clustering.cluster_stats(t.embeddings, "label", "embedding")
    with_distance = clustering.with_center_distance(t.embeddings, "embedding", stats.centers, "label", stats.clusters)
    return with_distance.select(
        "vec_id", *[F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(DIMS)], "label",
        rnd("distance_to_center", 6).alias("distance"),
    )


@plan(
    "j12_nearest_candidate",
    """SELECT p_partkey, k FROM (SELECT p_partkey, k, row_number() OVER (PARTITION BY p_partkey ORDER BY abs(k - p_size), k) AS n
         FROM part, (VALUES (2), (8), (14), (20), (40)) c(k)) x WHERE n = 1""",
)
def nearest_candidate(t: Tables):
    return t.part.select("p_partkey", joins.nearest_candidate(F.col("p_size"), [2, 8, 14, 20, 40]).alias("k"))
