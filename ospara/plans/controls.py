"""Access control on tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ospara.operators import access
from ospara.plans.base import Tables, plan
from ospara.plans.combining import DECISION_SQL, ROLE_SQL, policies, roles, users


@plan(
    "r01_role_check",
    f"""WITH {ROLE_SQL} SELECT user_id, EXISTS (SELECT 1 FROM granted g WHERE g.user_id = u.user_id AND p = 'write') AS may_write
        FROM users u""",
)
def role_check(t: Tables):
    held = access.user_permissions(users(t), roles(t))
    return held.select("user_id", F.array_contains("permissions", "write").alias("may_write"))


CALLER = {
    "department": "F",
    "projects": ["1-URGENT", "3-MEDIUM"],
    "security_clearance": 2,
    "permissions": ["view_rush", "view_plain"],
}
RESOURCE_SQL = """
resources AS (SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'vault' WHEN o_totalprice > 200000 THEN 'rush' ELSE 'plain' END AS kind,
    CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS department,
    CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS project,
    CASE WHEN o_orderkey % 5 <> 0 THEN (o_custkey % 4)::INTEGER END AS clearance FROM orders),
checked AS (SELECT *, (department IS NULL OR department = 'F') AND (project IS NULL OR project IN ('1-URGENT', '3-MEDIUM'))
    AND coalesce(clearance, 0) <= 2 AS allowed FROM resources)
"""


def resources(t: Tables):
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey", F.when(price > 400000, "vault").when(price > 200000, "rush").otherwise("plain").alias("kind"),
        F.when(key % 3 != 0, F.col("o_orderstatus")).alias("department"),
        F.when(key % 2 == 0, F.col("o_orderpriority")).alias("project"),
        F.when(key % 5 != 0, (F.col("o_custkey") % 4).cast("int")).alias("clearance"),
    )


@plan("r02_attribute_check", f"WITH {RESOURCE_SQL} SELECT o_orderkey, allowed FROM checked")
def attribute_check(t: Tables):
    allowed = access.resource_allowed(CALLER, F.col("department"), F.col("project"), F.col("clearance"))
    return resources(t).select("o_orderkey", allowed.alias("allowed"))


@plan("r03_permission_decision", f"WITH {DECISION_SQL} SELECT user_id, allowed FROM decisions")
def permission_decision(t: Tables):
    return access.decide(users(t), roles(t), policies(t), "read").select("user_id", "allowed")


COLLECTION_SQL = f"""
{DECISION_SQL},
pairs AS (SELECT user_id, collection FROM decisions, (SELECT DISTINCT lang AS collection FROM documents) c
  WHERE allowed AND CASE WHEN collection = 'de' AND nation IN (10, 11) THEN false
    WHEN collection = 'de' AND segment = 'HOUSEHOLD' THEN true WHEN collection = 'de' AND nation IN (12, 13, 14) THEN false
    WHEN collection = 'fr' AND segment = 'HOUSEHOLD' THEN false ELSE true END)
"""


def accessible(t: Tables):
    rows = [
        ("de", 1, "deny", ["read"], '{"nation":["10","11"]}'),
        ("de", 2, "allow", ["read", "write"], '{"segment":["HOUSEHOLD"]}'),
        ("de", 3, "deny", ["read"], '{"nation":["12","13","14"]}'),
        ("fr", 1, "deny", ["read"], '{"segment":["HOUSEHOLD"]}'),
        ("es", 1, "deny", ["delete"], '{"segment":["HOUSEHOLD"]}'),
    ]
    own = t.spark.createDataFrame(
        rows, "collection string, position int, effect string, permissions array<string>, conditions_json string"
    )
    collections = t.documents.select(F.col("lang").alias("collection")).distinct()
    return access.collection_access(users(t), roles(t), policies(t), collections, own, "read")


@plan("r04_collection_access", f"WITH {COLLECTION_SQL} SELECT user_id, collection FROM pairs")
def collection_access(t: Tables):
    return accessible(t)


@plan(
    "r05_resource_filter",
    f"WITH {RESOURCE_SQL} SELECT o_orderkey, kind FROM checked WHERE allowed AND kind IN ('rush', 'plain')",
)
def resource_filter(t: Tables):
    kept = access.filter_resources(resources(t), CALLER, "kind", "department", "project", "clearance")
    return kept.select("o_orderkey", "kind")


@plan(
    "r06_accessible_collections",
    f"""WITH {COLLECTION_SQL} SELECT user_id, string_agg(collection, ',' ORDER BY collection) AS collections
        FROM pairs GROUP BY user_id""",
)
def accessible_collections(t: Tables):
    grouped = accessible(t).groupBy("user_id").agg(F.sort_array(F.collect_list("collection")).alias("c"))
    return grouped.select("user_id", F.array_join("c", ",").alias("collections"))


@plan("r07_delete_by_ids", "SELECT vec_id, label FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def delete_by_ids(t: Tables):
    ids = t.labels.filter("toxic = 1").select(F.col("doc_id").alias("vec_id"))
    deleters = access.decide(users(t), roles(t), policies(t), "delete").filter("allowed")
    permitted = deleters.limit(1).count() > 0
    return access.delete_by_ids(t.embeddings.select("vec_id", "label"), ids, "vec_id", permitted)


@plan(
    "r08_metadata_update",
    """SELECT vec_id, e.label::VARCHAR AS label, coalesce(CASE WHEN toxic IS NOT NULL THEN 'yes' END, 'no') AS reviewed,
         coalesce(toxic::VARCHAR, '') AS toxic FROM embeddings e LEFT JOIN labels l ON l.doc_id = e.vec_id""",
)
def metadata_update(t: Tables):
    payload = F.create_map(F.lit("label"), F.col("label").cast("string"), F.lit("reviewed"), F.lit("no"))
    new = F.create_map(F.lit("reviewed"), F.lit("yes"), F.lit("toxic"), F.col("toxic").cast("string"))
    out = access.update_metadata(
        t.embeddings.select("vec_id", payload.alias("metadata")),
        t.labels.select(F.col("doc_id").alias("vec_id"), new.alias("metadata")), "vec_id",
    )
    get = lambda k: F.coalesce(F.try_element_at("metadata", F.lit(k)), F.lit(""))
    return out.select("vec_id", *[get(k).alias(k) for k in ("label", "reviewed", "toxic")])
