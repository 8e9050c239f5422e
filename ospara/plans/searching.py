"""Sort, limit, top-k and similarity search."""

from __future__ import annotations

from pyspark.sql import functions as F

from ospara.functions import text, vectors
from ospara.operators import access, search
from ospara.plans import combining
from ospara.plans.aggregates import CENTER_SQL, KNN_SQL, label_queries
from ospara.plans.base import Tables, plan, rnd
from ospara.session import fresh_path


@plan(
    "t01_nearest_cosine",
    f"""WITH {KNN_SQL} SELECT query_id, vec_id, label, round(cos, 6) AS score, rank::INTEGER AS rank
        FROM byc JOIN embeddings USING (vec_id)""",
)
def nearest_cosine(t: Tables):
    hits = vectors.nearest(t.embeddings, "vec_id", "embedding", *label_queries(t), 10)
    found = hits.join(t.embeddings.select("vec_id", "label"), "vec_id")
    return found.select("query_id", "vec_id", "label", rnd("score", 6).alias("score"), "rank")


@plan(
    "t02_nearest_euclidean",
    f"WITH {KNN_SQL} SELECT query_id, vec_id, round(dist, 6) AS score, rank::INTEGER AS rank FROM bye",
)
def nearest_euclidean(t: Tables):
    hits = vectors.nearest(t.embeddings, "vec_id", "embedding", *label_queries(t), 10, "euclidean")
    return hits.withColumn("score", rnd("score", 6))


@plan(
    "t03_all_cells",
    f"WITH {KNN_SQL} SELECT query_id, vec_id, round(cos, 6) AS score, rank::INTEGER AS rank FROM byc",
)
def nearest_in_all_cells(t: Tables):
    index = search.CellIndex.build(t.embeddings, "vec_id", "embedding", fresh_path(t.spark, "cells"), cells=16)
    hits = index.search(*label_queries(t), 10, probes=16)
    return hits.select("query_id", "vec_id", rnd("score", 6).alias("score"), "rank")


def own_queries(t: Tables):
    """The query set of the index: every twentieth vector, so many at most as ``small_matrix`` allows."""
    return vectors.small_matrix(t.embeddings.filter("vec_id % 20 = 0"), "vec_id", "embedding")


@plan("t03_nearest_approximate")
def nearest_approximate(t: Tables):
    index = search.CellIndex.build(t.embeddings, "vec_id", "embedding", fresh_path(t.spark, "cells"), cells=64, copies=8)
    return index.search(*own_queries(t), 10, probes=8)


@plan(
    "t03_recall",
    "SELECT count(*) AS queries, 10 AS k, 8 AS cells_read, true AS recall_reaches_090 FROM embeddings WHERE vec_id % 20 = 0",
)
def approximate_recall(t: Tables):
    """Recall against exact search of an index of 64 cells of which a query reads 8."""
    index = search.CellIndex.build(t.embeddings, "vec_id", "embedding", fresh_path(t.spark, "cells"), cells=64, copies=8)
    ids, matrix = own_queries(t)
    found = search.recall_of(index, t.embeddings, ids, matrix, 10, 8)
    return found.select(F.lit(len(ids)).cast("long").alias("queries"), F.lit(10).alias("k"), F.lit(8).alias("cells_read"),
                        (F.col("recall") >= 0.9).alias("recall_reaches_090"))


@plan(
    "t04_nearest_filtered",
    f"""WITH {CENTER_SQL}, s AS (SELECT c.label AS query_id, vec_id, list_cosine_similarity(embedding::DOUBLE[], c.c) AS s
          FROM embeddings e, centers c WHERE e.label = 3)
        SELECT query_id, vec_id, round(s, 6) + 0.0 AS score, rank::INTEGER AS rank FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS rank FROM s) r WHERE rank <= 5""",
)
def nearest_filtered(t: Tables):
    hits = search.filtered_nearest(t.embeddings, {"label": 3}, None, "vec_id", "embedding", *label_queries(t), 5)
    return hits.withColumn("score", rnd("score", 6))


@plan(
    "t05_keyword_search",
    """SELECT doc_id, score::INTEGER AS score FROM (SELECT doc_id, (length(lower(text)) - length(replace(lower(text), 'worthless', ''))) / 9
         + CASE WHEN contains(lower(text), 'worthless') THEN 1 ELSE 0 END AS score FROM documents) s
       WHERE score > 0 ORDER BY score DESC, doc_id LIMIT 25""",
)
def keyword_search(t: Tables):
    return search.keyword_search(t.documents, "doc_id", "text", "worthless", 25)


@plan("t06_substring_search", "SELECT doc_id, lang FROM documents WHERE contains(lower(text), 'the of')")
def substring_search(t: Tables):
    return search.substring_search(t.documents, "text", "The of").select("doc_id", "lang")


MATCH_SQL = f"""
{CENTER_SQL},
sims AS (SELECT vec_id, c.label AS rule, list_cosine_similarity(embedding::DOUBLE[], c) AS s FROM embeddings, centers c),
ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, rule) AS n FROM sims WHERE s >= 0.1)
"""


@plan(
    "t07_top_matches",
    f"""WITH {MATCH_SQL} SELECT vec_id, string_agg(rule || ':' || round(s, 4)::VARCHAR, ' ' ORDER BY n) AS matches
        FROM ranked WHERE n <= 3 GROUP BY vec_id""",
)
def top_matches(t: Tables):
    from ospara.operators import severity

    names, matrix = label_queries(t)
    best = severity.with_matches(t.embeddings, "embedding", names, matrix, 0.1).filter(F.size("matches") > 0)
    shown = F.transform(
        F.slice("matches", 1, 3),
        lambda m: F.concat(m["rule"].cast("string"), F.lit(":"), F.round(m["similarity"], 4).cast("string")),
    )
    return best.select("vec_id", F.array_join(shown, " ").alias("matches"))


@plan(
    "t08_score_order",
    """SELECT user_id, round(avg(value) - stddev_samp(value) / 10, 6) AS combined,
         row_number() OVER (ORDER BY avg(value) - stddev_samp(value) / 10 DESC, user_id)::INTEGER AS place
       FROM events GROUP BY user_id""",
)
def score_order(t: Tables):
    from ospara import scale

    scores = t.events.groupBy("user_id").agg((F.avg("value") - F.stddev_samp("value") / 10).alias("_c"))
    ordered = scale.positions(
        scores.select("user_id", (-F.col("_c")).alias("_c"), F.lit(0).alias("_all")), ["_all"], ["_c", "user_id"]
    )
    return ordered.select("user_id", rnd(-F.col("_c"), 6).alias("combined"), F.col("pos").cast("int").alias("place"))


@plan(
    "t09_priority_queue",
    """SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'P'""",
)
def priority_queue(t: Tables):
    pending = t.orders.filter("o_orderstatus = 'P'").select("o_orderkey", "o_orderpriority")
    return pending.orderBy("o_orderpriority", "o_orderkey")


@plan(
    "t10_main_drivers",
    """WITH m AS (SELECT label, i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, range(1, 65) r(i) GROUP BY label, i),
         l AS (SELECT label, i, m / max(abs(m)) OVER (PARTITION BY label) AS w FROM m)
       SELECT label AS component, string_agg('f' || (i - 1) || ' (' || printf('%.3f', w) || ')', ', '
         ORDER BY abs(w) DESC, 'f' || (i - 1)) AS drivers FROM l WHERE abs(w) > 0.3 GROUP BY label""",
)
def main_drivers(t: Tables):
    means = vectors.group_means(t.embeddings, "label", "embedding")
    largest = F.array_max(F.transform("center", lambda x: F.abs(x)))
    loadings = means.select("label", largest.alias("_max"), F.posexplode("center").alias("i", "m")).select(
        F.col("label").alias("component"), F.concat(F.lit("f"), F.col("i")).alias("feature"),
        (F.col("m") / F.col("_max")).alias("loading"),
    )
    return search.main_drivers(loadings).select("component", F.array_join("drivers", ", ").alias("drivers"))


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


@plan(
    "t11_secure_search",
    f"""WITH {combining.DECISION_SQL}, {KNN_SQL},
        me AS (SELECT segment FROM users WHERE user_id = (SELECT min(user_id) FROM decisions WHERE allowed))
        SELECT query_id, vec_id, round(cos, 6) AS score FROM (
          SELECT query_id, vec_id, cos, row_number() OVER (PARTITION BY query_id ORDER BY cos DESC, vec_id) AS place
          FROM s JOIN embeddings e USING (vec_id), me
          WHERE vec_id % 4 <> 0 OR ['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'][e.label % 5 + 1] = segment) x
        WHERE place <= 10""",
)
def secure_search(t: Tables):
    allowed = access.decide(combining.users(t), combining.roles(t), combining.policies(t), "read").filter("allowed")
    caller = allowed.agg(F.min_by("attributes", "user_id").alias("a")).first()["a"]
    segment = F.get(F.array(*[F.lit(s) for s in SEGMENTS]), F.col("label") % 5)
    need = F.when(F.col("vec_id") % 4 == 0, F.create_map(F.lit("segment"), F.array(segment)))
    marked = t.embeddings.select("vec_id", need.alias("required_attributes"))
    hits = search.secure_nearest(marked, t.embeddings, caller, "vec_id", "embedding", *label_queries(t), 10)
    return hits.select("query_id", "vec_id", rnd("score", 6).alias("score"))


@plan(
    "t12_summary_lines",
    r"""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '')[1:20] AS top
          FROM documents), k AS (SELECT doc_id, top, list_filter(top, lambda x: contains(lower(x), 'worth')
            OR contains(lower(x), 'tion') OR contains(lower(x), 'the the')) AS kept FROM l)
        SELECT doc_id, array_to_string(CASE WHEN len(kept) > 0 THEN kept ELSE top[1:5] END, chr(10)) AS summary FROM k""",
)
def summary_lines(t: Tables):
    lines = text.summary_lines("text", ["worth", "tion", "the the"])
    return t.texts.select("doc_id", F.array_join(lines, "\n").alias("summary"))
