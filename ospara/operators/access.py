"""Roles, attributes and policies as relations and column conditions.

User and policy tables hold attributes as MAP<STRING, ARRAY<STRING>>. Role and
policy tables are administered by hand and stay small; user and resource
tables may be of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ospara.scale import broadcast_if_small

ADMIN = "admin"


def user_permissions(users: DataFrame, roles: DataFrame) -> DataFrame:
    """Union of the permissions of each user's roles; unknown roles add none."""
    held = users.select("user_id", F.explode_outer("roles").alias("role"))
    granted = held.join(broadcast_if_small(roles.select("role", "permissions")), "role", "left")
    per_role = granted.select("user_id", F.explode_outer("permissions").alias("permission"))
    return per_role.groupBy("user_id").agg(F.sort_array(F.collect_set("permission")).alias("permissions"))


def attributes_match(required: Column, owned: Column) -> Column:
    """Every required attribute shares a value with the owner's; none required is true."""
    entries = F.coalesce(F.map_entries(required), F.array().cast("array<struct<key:string,value:array<string>>>"))
    return F.forall(
        entries,
        lambda e: F.coalesce(F.arrays_overlap(F.try_element_at(owned, e["key"]), e["value"]), F.lit(False)),
    )


def visible_rows(df: DataFrame, required: str, attributes: Column) -> DataFrame:
    return df.filter(attributes_match(F.col(required), attributes))


def _covering(policies: DataFrame, permission: str) -> DataFrame:
    return policies.filter(F.array_contains("permissions", permission))


def with_class(users: DataFrame) -> DataFrame:
    """Add ``_class``, equal for users whose attributes hold the same values."""
    entries = F.transform(F.map_entries("attributes"), lambda e: F.struct(e["key"], F.array_sort(F.array_distinct(e["value"])).alias("value")))
    return users.withColumn("_class", F.coalesce(F.to_json(F.array_sort(entries)), F.lit("none")))


def conditions_met(classes: DataFrame, conditions: DataFrame) -> DataFrame:
    """(_class, condition) for conditions with requirements: a class meets one if it shares a value with each of its keys.

    A relational division: values meet on (key, value), so only pairs with
    something in common are formed.
    """
    parsed = conditions.select("condition", F.from_json("condition", CONDITIONS).alias("m")).withColumn("n", F.size(F.map_keys("m")))
    need = parsed.select("condition", "n", F.explode("m").alias("key", "values")).select("condition", "n", "key", F.explode("values").alias("value"))
    have = classes.select("_class", F.explode("attributes").alias("key", "values")).select("_class", "key", F.explode("values").alias("value"))
    met = have.distinct().join(need.distinct(), ["key", "value"]).groupBy("_class", "condition", "n")
    return met.agg(F.count_distinct("key").alias("k")).filter("k = n").select("_class", "condition")


CONDITIONS = "map<string,array<string>>"


def first_effects(classes: DataFrame, lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Effects of the first policy that applies, per class of users and list of policies.

    ``lists`` has (list, position, effect, conditions_json). The first table is
    (list, effect) for classes that meet no condition of the list: that of its
    first policy without requirements, or allow. The second is (_class, list,
    effect) for the others.
    """
    named = lists.withColumn("condition", F.col("conditions_json"))
    free = F.coalesce(F.size(F.map_keys(F.from_json("condition", CONDITIONS))), F.lit(0)) <= 0
    entry = F.struct("position", "effect")
    default = named.groupBy("list").agg(F.min(F.when(free, entry)).alias("_free"))
    met = conditions_met(classes, named.filter(~free).select("condition").distinct())
    first = met.join(named.filter(~free).select("list", "condition", entry.alias("_own")), "condition").groupBy("_class", "list").agg(
        F.min("_own").alias("_own"))
    special = first.join(default, "list").select("_class", "list", F.coalesce(F.least("_own", "_free"), "_own")["effect"].alias("effect"))
    return default.select("list", F.coalesce("_free.effect", F.lit("allow")).alias("effect")), special


def decide(users: DataFrame, roles: DataFrame, policies: DataFrame, permission: str) -> DataFrame:
    """(user_id, attributes, allowed) for one permission.

    Administrators pass. Others need the permission by role; then the first
    matching policy decides, and no match allows. Policies are matched once
    per class of users with equal attributes.
    """
    held = user_permissions(users, roles)
    subjects = with_class(users.select("user_id", "attributes")).join(held, "user_id", "left")
    classes = subjects.select("_class", "attributes").dropDuplicates(["_class"])
    listed = _covering(policies, permission).select(F.lit(0).alias("list"), "position", "effect", "conditions_json")
    default, special = first_effects(classes, listed)
    general = default.agg(F.coalesce(F.max("effect"), F.lit("allow")).alias("_default"))
    decided = subjects.join(special.select("_class", "effect"), "_class", "left").crossJoin(F.broadcast(general))
    has = F.coalesce(F.array_contains("permissions", permission), F.lit(False))
    admin = F.coalesce(F.array_contains("permissions", ADMIN), F.lit(False))
    allowed = admin | (has & (F.coalesce("effect", "_default") == "allow"))
    return decided.select("user_id", "attributes", allowed.alias("allowed"))


def collection_access(
    users: DataFrame, roles: DataFrame, policies: DataFrame, collections: DataFrame,
    collection_policies: DataFrame, permission: str,
) -> DataFrame:
    """(user_id, collection): general decision first, then the collection's policies.

    Users fall into classes by their attributes and collections into classes by
    their list of policies. Access is decided per pair of classes, and users
    and collections are joined only where it is granted.
    """
    general = with_class(decide(users, roles, policies, permission).filter("allowed").select("user_id", "attributes"))
    entry = F.struct("position", "effect", "conditions_json")
    listed = _covering(collection_policies, permission).groupBy("collection").agg(F.sort_array(F.collect_list(entry)).alias("_policies"))
    kinds = collections.select("collection").distinct().join(listed, "collection", "left").withColumn(
        "list", F.coalesce(F.sha2(F.to_json("_policies"), 256), F.lit("none")))
    lists = kinds.dropDuplicates(["list"]).select("list", F.inline("_policies"))
    classes = general.select("_class", "attributes").dropDuplicates(["_class"])
    default, special = first_effects(classes, lists)
    named = kinds.select("list").distinct().join(default, "list", "left").select("list", F.coalesce("effect", F.lit("allow")).alias("default"))
    rules = special.join(named, "list")
    denied = rules.filter("effect <> 'allow' AND default = 'allow'").groupBy("_class").agg(F.collect_set("list").alias("_denied"))
    open_lists = named.filter("default = 'allow'").agg(F.collect_set("list").alias("_open"))
    by_default = classes.select("_class").join(denied, "_class", "left").crossJoin(F.broadcast(open_lists)).select(
        "_class", F.explode(F.array_except("_open", F.coalesce("_denied", F.array().cast("array<string>")))).alias("list"))
    granted = by_default.unionByName(rules.filter("effect = 'allow' AND default <> 'allow'").select("_class", "list"))
    return general.select("user_id", "_class").join(granted, "_class").join(kinds.select("collection", "list"), "list").select("user_id", "collection")


def resource_allowed(user: dict, department: Column, project: Column, clearance: Column) -> Column:
    """Department equal, project among the user's, clearance high enough.

    A resource attribute that is unset passes; an unset clearance counts 0.
    """
    own_department = F.lit(user.get("department"))
    projects = user.get("projects") or []
    in_department = department.isNull() | (department == "") | F.coalesce(department == own_department, F.lit(False))
    in_project = project.isNull() | (project == "") | (project.isin(*projects) if projects else F.lit(False))
    cleared = F.coalesce(clearance, F.lit(0)) <= int(user.get("security_clearance") or 0)
    return in_department & in_project & cleared


def filter_resources(df: DataFrame, user: dict, kind: str, department: str, project: str, clearance: str) -> DataFrame:
    """Resources the user's role may view and whose attributes admit the user."""
    granted = list(user.get("permissions") or [])
    viewable = F.concat(F.lit("view_"), F.col(kind)).isin(*granted) if granted else F.lit(False)
    return df.filter(viewable & resource_allowed(user, F.col(department), F.col(project), F.col(clearance)))


def delete_by_ids(df: DataFrame, ids: DataFrame, key: str, permitted: bool) -> DataFrame:
    """The table without the ids; unchanged when the caller may not delete."""
    return df.join(ids.select(key), key, "left_anti") if permitted else df


def update_metadata(df: DataFrame, updates: DataFrame, key: str, metadata: str = "metadata") -> DataFrame:
    """Merge payload maps by id; new values win."""
    new = updates.select(key, F.col(metadata).alias("_new"))
    old = F.coalesce(metadata, F.create_map().cast("map<string,string>"))
    kept = F.map_filter(old, lambda k, _: ~F.coalesce(F.map_contains_key("_new", k), F.lit(False)))
    merged = F.when(F.col("_new").isNull(), F.col(metadata)).otherwise(F.map_concat(kept, F.col("_new")))
    return df.join(new, key, "left").withColumn(metadata, merged).drop("_new")
