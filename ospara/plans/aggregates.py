"""Aggregations and statistics reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ospara.functions import rules, vectors
from ospara.operators import aggregates, clustering, profile, timeseries
from ospara.plans.base import Tables, plan, rnd
from ospara.plans.bindings import INCIDENT_SQL, READING_SQL, asof, incidents, readings
from ospara.plans.predicates import FAULT_CASE, FAULTS, MISSING_SQL, orders_with_gaps

SCORED_SQL = """
scored AS (
  SELECT l_partkey, l_returnflag, l_discount * 10 AS similarity, l_quantity * 2 AS base,
    CASE l_returnflag WHEN 'R' THEN 1.2::DOUBLE WHEN 'N' THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END AS factor FROM lineitem),
levelled AS (
  SELECT *, similarity * 100 * 0.4 + base * factor * 0.6 AS combined,
    CASE WHEN similarity * 100 * 0.4 + base * factor * 0.6 >= 80 THEN 'S1'
         WHEN similarity * 100 * 0.4 + base * factor * 0.6 >= 60 THEN 'S2'
         WHEN similarity * 100 * 0.4 + base * factor * 0.6 >= 40 THEN 'S3' ELSE 'S4' END AS level FROM scored)
"""


def scored(t: Tables, lines=None):
    flag = F.col("l_returnflag")
    base = (t.lineitem if lines is None else lines).select(
        "l_partkey", "l_returnflag", (F.col("l_discount") * 10).alias("similarity"),
        (F.col("l_quantity") * 2).alias("base"),
        F.when(flag == "R", 1.2).when(flag == "N", 0.8).otherwise(1.0).alias("factor"),
    )
    score = rules.combined_score(F.col("similarity"), F.col("base"), F.col("factor"))
    return base.withColumn("combined", score).withColumn("level", rules.severity_bucket(F.col("combined")))


@plan(
    "a01_severity_summary",
    f"""WITH {SCORED_SQL} SELECT level, count(*) AS n, round(avg(similarity), 4) AS avg_similarity,
          round(avg(base), 4) AS avg_base, round(avg(combined), 4) AS avg_combined,
          count(DISTINCT l_partkey) AS patterns FROM levelled GROUP BY level""",
)
def severity_summary(t: Tables):
    out = aggregates.severity_summary(scored(t), "level", ["similarity", "base", "combined"], "l_partkey")
    for c in ("avg_similarity", "avg_base", "avg_combined"):
        out = out.withColumn(c, rnd(c, 4))
    return out


@plan(
    "a02_confidence_summary",
    f"""WITH {SCORED_SQL} SELECT level, l_returnflag, count(*) AS n, round(avg(similarity), 4) AS avg_confidence,
          round(avg(combined), 4) AS avg_score FROM levelled GROUP BY level, l_returnflag""",
)
def confidence_summary(t: Tables):
    return (
        scored(t).groupBy("level", "l_returnflag")
        .agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("similarity"), 4).alias("avg_confidence"),
             rnd(F.avg("combined"), 4).alias("avg_score"))
        .orderBy(F.desc("avg_score"))
    )


@plan(
    "a03_json_path_counts",
    f"""WITH {INCIDENT_SQL} SELECT coalesce(json_extract_string(payload, '$.category'), '(none)') AS category,
          count(*) AS n FROM incidents GROUP BY 1""",
)
def json_path_counts(t: Tables):
    category = F.get_json_object("payload", "$.category")
    grouped = incidents(t).groupBy(category.alias("category")).agg(F.count(F.lit(1)).alias("n"))
    return grouped.withColumn("category", F.coalesce("category", F.lit("(none)")))


@plan(
    "a04_two_key_counts",
    f"""WITH {INCIDENT_SQL} SELECT coalesce(json_extract_string(payload, '$.properties.environment'), '(none)')
          AS environment, event_type, count(*) AS n FROM incidents GROUP BY 1, 2""",
)
def two_key_counts(t: Tables):
    env = F.coalesce(F.get_json_object("payload", "$.properties.environment"), F.lit("(none)"))
    return incidents(t).groupBy(env.alias("environment"), "event_type").agg(F.count(F.lit(1)).alias("n"))


@plan("a05_single_key_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def single_key_counts(t: Tables):
    return t.events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


DIMS = 64
GROUP_STATS = ", ".join(
    f"round(avg(CAST(embedding[{i + 1}] AS DOUBLE)), 2) + 0.0 AS mean_{i}, "
    f"round(stddev_samp(CAST(embedding[{i + 1}] AS DOUBLE)), 2) AS std_{i}"
    for i in range(DIMS)
)


def with_dims(t: Tables, n: int = DIMS):
    dims = [F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(n)]
    return t.embeddings.select("vec_id", "label", *dims)


@plan("a06_group_mean_std", f"SELECT label, {GROUP_STATS} FROM embeddings GROUP BY label")
def group_mean_std(t: Tables):
    parts = []
    for i in range(DIMS):
        parts += [rnd(F.avg(f"f{i}"), 2).alias(f"mean_{i}"), rnd(F.stddev_samp(f"f{i}"), 2).alias(f"std_{i}")]
    return with_dims(t).groupBy("label").agg(*parts)


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def each_measure(body: str) -> str:
    return " UNION ALL ".join(body.replace("{c}", c) for c in MEASURES)


@plan(
    "a07_describe",
    each_measure(
        """SELECT '{c}' AS feature, count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
           min({c}) AS "min", round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
           round(quantile_cont({c}, 0.75), 6) AS q75, max({c}) AS "max" FROM lineitem"""
    ),
)
def describe(t: Tables):
    out = profile.describe(t.lines, MEASURES)
    for c in ("mean", "std"):
        out = out.withColumn(c, rnd(c, 4))
    for c in ("q25", "q50", "q75"):
        out = out.withColumn(c, rnd(c, 6))
    return out


@plan(
    "a08_skew_kurtosis",
    """SELECT 'value' AS feature, round(skewness(value), 6) AS skew, round(kurtosis(value), 6) AS kurt,
         CASE WHEN skewness(value) > 0 THEN 'right-skewed' ELSE 'left-skewed' END AS skew_label,
         CASE WHEN kurtosis(value) > 0 THEN 'heavy-tailed' ELSE 'light-tailed' END AS tail_label FROM events""",
)
def skew_kurtosis(t: Tables):
    return profile.shape_report(t.events, ["value"]).select(
        "feature", rnd("skew", 6).alias("skew"), rnd("kurt", 6).alias("kurt"), "skew_label", "tail_label"
    )


@plan(
    "a09_normality_test",
    """WITH m AS (SELECT count(value)::DOUBLE n, avg(value) mu, var_pop(value) v FROM events),
    c AS (SELECT max(n) n, sum(power(value - mu, 3)) / max(n) / power(max(v), 1.5) g1,
                 sum(power(value - mu, 4)) / max(n) / power(max(v), 2) - 3 g2 FROM events, m),
    s AS (SELECT *, g1 * sqrt((n + 1) * (n + 3) / (6 * (n - 2))) y,
            3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) b,
            (g2 + 3 - 3 * (n - 1) / (n + 1))
              / sqrt(24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))) x,
            6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
              * sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) sb FROM c),
    w AS (SELECT *, sqrt(2 * (b - 1)) - 1 w2, 6 + 8 / sb * (2 / sb + sqrt(1 + 4 / (sb * sb))) a FROM s),
    z AS (SELECT *, asinh(y / sqrt(2 / (w2 - 1))) / sqrt(ln(sqrt(w2))) zs,
            1 + x * sqrt(2 / (a - 4)) d FROM w),
    k AS (SELECT zs, (1 - 2 / (9 * a) - sign(d) * cbrt((1 - 2 / a) / abs(d))) / sqrt(2 / (9 * a)) zk FROM z)
    SELECT 'value' AS feature, round(zs * zs + zk * zk, 3) AS k2, round(exp(-(zs * zs + zk * zk) / 2), 6) AS p_value,
      CASE WHEN exp(-(zs * zs + zk * zk) / 2) > 0.05 THEN 'likely normal' ELSE 'non-normal' END AS normality FROM k""",
)
def normality_test(t: Tables):
    return profile.shape_report(t.events, ["value"]).select(
        "feature", rnd("k2", 3).alias("k2"), rnd("p_value", 6).alias("p_value"), "normality"
    )


PAIRS = [(a, b) for i, a in enumerate(MEASURES) for b in MEASURES[i + 1 :]]
PAIR_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", corr({a}, {b}) AS corr FROM lineitem" for a, b in PAIRS
)


@plan(
    "a10_correlation_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", "
        + ("1.0::DOUBLE" if a == b else f"round(corr({a}, {b}), 6) + 0.0")
        + " AS corr FROM lineitem"
        for a in MEASURES for b in MEASURES if a != b
    )
    + " UNION ALL "
    + " UNION ALL ".join(f"SELECT '{a}', '{a}', 1.0::DOUBLE" for a in MEASURES),
)
def correlation_matrix(t: Tables):
    return profile.correlation_matrix(t.lineitem, MEASURES).withColumn("corr", rnd("corr", 6))


STRENGTH_FEATURES = """
f AS (SELECT l_quantity AS quantity, l_quantity * 2 + l_tax * 100 AS load, l_extendedprice - l_quantity * 900 AS margin,
             l_quantity + l_discount * 300 AS mix FROM lineitem)
"""


@plan(
    "a11_correlation_strength",
    f"""WITH {STRENGTH_FEATURES}, p AS ("""
    + " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", corr({a}, {b}) AS c FROM f"
        for a, b in [("quantity", "load"), ("quantity", "margin"), ("quantity", "mix"),
                     ("load", "margin"), ("load", "mix"), ("margin", "mix")]
    )
    + """) SELECT "left", "right", round(c, 6) AS corr, CASE WHEN abs(c) > 0.7 THEN 'strong'
          WHEN abs(c) > 0.3 THEN 'moderate' ELSE 'weak' END AS strength,
          CASE WHEN c > 0 THEN 'positive' ELSE 'negative' END AS direction FROM p WHERE abs(c) > 0.1""",
)
def correlation_strength(t: Tables):
    q, x, d, p = F.col("l_quantity"), F.col("l_tax"), F.col("l_discount"), F.col("l_extendedprice")
    f = t.lineitem.select(
        q.alias("quantity"), (q * 2 + x * 100).alias("load"), (p - q * 900).alias("margin"), (q + d * 300).alias("mix")
    )
    return profile.correlation_strength(f, ["quantity", "load", "margin", "mix"]).withColumn("corr", rnd("corr", 6))


@plan(
    "a12_preprocessing_advice",
    f"""WITH {MISSING_SQL}, s AS ("""
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, skewness({c}) AS skew, stddev_samp({c}) AS std, "
        f"(count(*) - count({c})) * 100.0 / count(*) AS pct FROM joined"
        for c in ("o_totalprice", "l_quantity", "l_tax")
    )
    + """) SELECT feature, round(skew, 6) AS skew, round(pct, 6) AS missing_pct,
         (SELECT max(std) / min(std) > 10 FROM s) AS rescale,
         CASE WHEN abs(skew) > 1 THEN 'log transform' ELSE 'none' END AS skew_advice,
         CASE WHEN pct = 0 THEN 'none' WHEN pct < 5 THEN 'median' WHEN pct < 15 THEN 'knn or iterative'
              ELSE 'engineer or drop' END AS missing_advice FROM s""",
)
def preprocessing_advice(t: Tables):
    out = profile.preprocessing_advice(orders_with_gaps(t), ["o_totalprice", "l_quantity", "l_tax"])
    return out.withColumn("skew", rnd("skew", 6)).withColumn("missing_pct", rnd("missing_pct", 6))


# Distances of each vector to the members of every label, taken pairwise.
SILHOUETTE_SQL = """
v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
d AS (SELECT a.vec_id, a.label, b.label AS other, power(list_distance(a.e, b.e), 2) AS dist
      FROM v a, v b WHERE a.vec_id <> b.vec_id),
m AS (SELECT vec_id, label, other, avg(dist) AS mean FROM d GROUP BY vec_id, label, other),
ab AS (SELECT vec_id, label, max(CASE WHEN other = label THEN mean END) AS a,
              min(CASE WHEN other <> label THEN mean END) AS b FROM m GROUP BY vec_id, label),
sil AS (SELECT vec_id, label, CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END AS s FROM ab)
"""
CENTER_SQL = """
dims AS (SELECT label, i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, range(1, 65) r(i) GROUP BY label, i),
centers AS (SELECT label, list(m ORDER BY i) AS c FROM dims GROUP BY label)
"""


@plan(
    "a13_cluster_profile",
    f"""WITH {SILHOUETTE_SQL}, {CENTER_SQL},
        p AS (SELECT label AS cluster, count(*) AS size, avg(list_distance(embedding::DOUBLE[], c)) AS dist
              FROM embeddings JOIN centers USING (label) GROUP BY label),
        q AS (SELECT label AS cluster, avg(s) AS s FROM sil GROUP BY label)
        SELECT cluster, size, round(dist, 4) AS avg_distance, round(s, 4) AS silhouette,
               row_number() OVER (ORDER BY s DESC, size DESC) = 1 AS best FROM p JOIN q USING (cluster)""",
)
def cluster_profile(t: Tables):
    out = clustering.cluster_profile(t.embeddings, "label", "embedding")
    return out.select(
        F.col("label").alias("cluster"), "size", rnd("avg_distance", 4).alias("avg_distance"),
        rnd("silhouette", 4).alias("silhouette"), "best",
    )


@plan(
    "a14_deviating_feature",
    """WITH c AS (SELECT label, i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, range(1, 65) r(i) GROUP BY label, i),
         g AS (SELECT i, avg(embedding[i]::DOUBLE) AS g FROM embeddings, range(1, 65) r(i) GROUP BY i),
         r AS (SELECT label, i, m, m - g AS gap, row_number() OVER (PARTITION BY label ORDER BY abs(m - g) DESC, i) AS n
               FROM c JOIN g USING (i))
       SELECT label, 'f' || (i - 1) AS feature, round(m, 6) AS mean, round(gap, 6) AS gap FROM r WHERE n = 1""",
)
def deviating_feature(t: Tables):
    out = aggregates.deviating_feature(with_dims(t), "label", [f"f{i}" for i in range(DIMS)])
    return out.withColumn("mean", rnd("mean", 6)).withColumn("gap", rnd("gap", 6))


@plan("a15_cluster_sizes", "SELECT label, count(*) AS size FROM embeddings GROUP BY label")
def cluster_sizes(t: Tables):
    return t.embeddings.groupBy("label").agg(F.count(F.lit(1)).alias("size"))


@plan(
    "a16_overview_kpis",
    """SELECT count(*) AS total, count(*) FILTER (WHERE o_orderstatus <> 'F') AS active,
         count(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) AS high FROM orders""",
)
def overview_kpis(t: Tables):
    return aggregates.conditional_counts(
        t.orders,
        {"total": F.lit(True), "active": F.col("o_orderstatus") != "F",
         "high": F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")},
    )


RESOLVED_SQL = """
resolved AS (SELECT l_orderkey, max(l_shipdate) AS resolved_at FROM lineitem GROUP BY l_orderkey)
"""


def resolved_orders(t: Tables):
    resolved = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("resolved_at"))
    seconds = F.expr("timestampdiff(SECOND, o_orderdate, resolved_at)")
    return t.orders.join(resolved, F.col("l_orderkey") == F.col("o_orderkey"), "left").withColumn("seconds", seconds)


@plan(
    "a17_mttr_hours",
    f"""WITH {RESOLVED_SQL} SELECT round(coalesce(avg(CASE WHEN o_orderstatus = 'F'
          THEN date_diff('second', o_orderdate, resolved_at) / 3600.0 END), 0), 4) AS mttr_hours
        FROM orders LEFT JOIN resolved ON l_orderkey = o_orderkey""",
)
def mttr_hours(t: Tables):
    hours = F.when(F.col("o_orderstatus") == "F", F.col("seconds") / 3600.0)
    return resolved_orders(t).agg(rnd(F.coalesce(F.avg(hours), F.lit(0.0)), 4).alias("mttr_hours"))


@plan(
    "a18_timeline",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2""",
)
def timeline(t: Tables):
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    return t.events.groupBy(day, "event_type").agg(F.count(F.lit(1)).alias("n"))


@plan(
    "a19_agent_success",
    """SELECT o_custkey AS agent, count(*) AS tasks,
         round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) * 100, 4) AS success_rate
       FROM orders GROUP BY o_custkey""",
)
def agent_success(t: Tables):
    done = F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)
    return t.orders.groupBy(F.col("o_custkey").alias("agent")).agg(
        F.count(F.lit(1)).alias("tasks"), rnd(F.avg(done) * 100, 4).alias("success_rate")
    )


@plan(
    "a20_processing_time",
    f"""WITH {RESOLVED_SQL}, m AS (SELECT o_orderpriority AS agent,
           date_diff('second', o_orderdate, resolved_at) / 60.0 AS minutes
         FROM orders JOIN resolved ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F')
        SELECT agent, round(min(minutes), 4) AS low, round(quantile_cont(minutes, 0.25), 4) AS q25,
          round(quantile_cont(minutes, 0.5), 4) AS q50, round(quantile_cont(minutes, 0.75), 4) AS q75,
          round(max(minutes), 4) AS high FROM m GROUP BY agent""",
)
def processing_time(t: Tables):
    done = resolved_orders(t).filter("o_orderstatus = 'F' and seconds is not null").select(
        F.col("o_orderpriority").alias("agent"), (F.col("seconds") / 60.0).alias("minutes")
    )
    q = profile.quantiles(done, ["minutes"], [0.0, 0.25, 0.5, 0.75, 1.0], ["agent"])
    names = ["low", "q25", "q50", "q75", "high"]
    return q.select("agent", *[rnd(F.col("quantiles")[i], 4).alias(n) for i, n in enumerate(names)])


@plan(
    "a21_fault_kpis",
    f"""WITH {READING_SQL}, f AS (SELECT {FAULT_CASE} AS fault FROM readings)
        SELECT count(*) FILTER (WHERE fault <> 'Normal') AS total,
          count(*) FILTER (WHERE fault = 'Overheat') AS overheat,
          count(*) FILTER (WHERE fault = 'Undervoltage') AS undervoltage,
          count(*) FILTER (WHERE fault = 'Power Surge') AS power_surge,
          count(*) FILTER (WHERE fault = 'Low Power') AS low_power FROM f""",
)
def fault_kpis(t: Tables):
    f = F.col("fault")
    labelled = readings(t).select(rules.fault_label(FAULTS).alias("fault"))
    return aggregates.conditional_counts(
        labelled,
        {"total": f != "Normal", "overheat": f == "Overheat", "undervoltage": f == "Undervoltage",
         "power_surge": f == "Power Surge", "low_power": f == "Low Power"},
    )


@plan("a22_classification_counts", "SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source")
def classification_counts(t: Tables):
    return t.documents.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))


@plan(
    "a23_guardrail_counts",
    r"""WITH r AS (SELECT
          CASE WHEN regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}') THEN 'email'
               WHEN regexp_matches(text, '[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}') THEN 'ip_address' END AS kind,
          CASE WHEN toxic = 1 THEN 'block' WHEN toxic = 0 THEN 'log' END AS verdict
        FROM documents LEFT JOIN labels USING (doc_id))
        SELECT 'kind' AS dimension, kind AS item, count(*) AS n FROM r WHERE kind IS NOT NULL GROUP BY kind
        UNION ALL SELECT 'verdict', verdict, count(*) FROM r WHERE verdict IS NOT NULL GROUP BY verdict""",
)
def guardrail_counts(t: Tables):
    kind = F.when(F.col("text").rlike(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"), "email").when(
        F.col("text").rlike(r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"), "ip_address"
    )
    verdict = F.when(F.col("toxic") == 1, "block").when(F.col("toxic") == 0, "log")
    tagged = t.texts.select("doc_id", kind.alias("kind")).join(
        t.labels.select("doc_id", verdict.alias("verdict")), "doc_id", "left"
    )
    return aggregates.stacked_counts(tagged, ["kind", "verdict"])


@plan(
    "a24_collection_overview",
    """SELECT (SELECT count(*) FROM documents) AS documents, count(*) AS clusters,
         round(coalesce(avg(size), 0), 4) AS avg_cluster_size FROM (SELECT count(*) AS size FROM embeddings GROUP BY label) s""",
)
def collection_overview(t: Tables):
    sizes = t.embeddings.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    return sizes.agg(
        F.lit(t.documents.count()).alias("documents"), F.count(F.lit(1)).alias("clusters"),
        rnd(F.coalesce(F.avg("size"), F.lit(0.0)), 4).alias("avg_cluster_size"),
    )


@plan(
    "a25_recent_incidents",
    """SELECT count(*) AS n FROM events WHERE event_type = 'error'
         AND ts >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR AND ts <= (SELECT max(ts) FROM events)""",
)
def recent_incidents(t: Tables):
    last = asof(t.events)
    recent = (F.col("ts") >= last - F.expr("interval 24 hours")) & (F.col("ts") <= last)
    return t.events.filter((F.col("event_type") == "error") & recent).agg(F.count(F.lit(1)).alias("n"))


@plan(
    "a26_distinct_lists",
    """SELECT DISTINCT 'event_type' AS dimension, event_type AS item FROM events
       UNION ALL SELECT DISTINCT 'user', CAST(user_id AS VARCHAR) FROM events""",
)
def distinct_lists(t: Tables):
    types = t.events.select(F.lit("event_type").alias("dimension"), F.col("event_type").alias("item")).distinct()
    users = t.events.select(F.lit("user").alias("dimension"), F.col("user_id").cast("string").alias("item")).distinct()
    return types.unionByName(users).orderBy("dimension", "item")


VOTE_SQL = """
votes AS (
  SELECT doc_id, 1 AS position, 'technical' AS role, 'technical' AS domain,
         CASE WHEN n_chars > 1000 THEN 'api' ELSE 'data' END AS category, 0.5::DOUBLE + (n_chars % 5) * 0.1::DOUBLE AS confidence
  FROM documents
  UNION ALL SELECT doc_id, 2, 'business', 'business', 'sales', 0.5::DOUBLE + (doc_id % 5) * 0.1::DOUBLE FROM documents WHERE lang <> 'en'
  UNION ALL SELECT doc_id, 3, 'legal', 'legal', 'compliance', 0.4::DOUBLE + (n_chars % 3) * 0.1::DOUBLE FROM documents WHERE source < 'src5'
  UNION ALL SELECT doc_id, 4, 'context', CASE WHEN lang = 'en' THEN 'technical' ELSE 'business' END,
         CASE WHEN lang = 'en' THEN 'data' ELSE 'sales' END, 0.3::DOUBLE + (doc_id % 7) * 0.1::DOUBLE FROM documents)
"""


def votes(t: Tables):
    docs = t.documents.select("doc_id", "n_chars", "lang", "source")

    def vote(condition, position, role, domain, category, confidence):
        record = F.struct(
            F.lit(position).alias("position"), F.lit(role).alias("role"), domain.alias("domain"),
            category.alias("category"), confidence.alias("confidence"),
        )
        return F.when(condition, record)

    english = F.col("lang") == "en"
    cast = F.array(
        vote(F.lit(True), 1, "technical", F.lit("technical"),
             F.when(F.col("n_chars") > 1000, "api").otherwise("data"), F.lit(0.5) + F.col("n_chars") % 5 * 0.1),
        vote(~english, 2, "business", F.lit("business"), F.lit("sales"), F.lit(0.5) + F.col("doc_id") % 5 * 0.1),
        vote(F.col("source") < "src5", 3, "legal", F.lit("legal"), F.lit("compliance"),
             F.lit(0.4) + F.col("n_chars") % 3 * 0.1),
        vote(F.lit(True), 4, "context", F.when(english, "technical").otherwise("business"),
             F.when(english, "data").otherwise("sales"), F.lit(0.3) + F.col("doc_id") % 7 * 0.1),
    )
    return docs.select("doc_id", F.explode(F.array_compact(cast)).alias("v")).select("doc_id", "v.*")


@plan(
    "a27_weighted_consensus",
    f"""WITH {VOTE_SQL}, w AS (SELECT doc_id, domain, category,
            sum(confidence * CASE role WHEN 'context' THEN 1.2::DOUBLE ELSE 1.0::DOUBLE END) AS w, min(position) AS p
          FROM votes GROUP BY doc_id, domain, category),
        r AS (SELECT *, sum(w) OVER (PARTITION BY doc_id) AS total,
            row_number() OVER (PARTITION BY doc_id ORDER BY round(w, 9) DESC, p) AS n FROM w)
        SELECT doc_id, domain, category, round(w / total, 6) AS confidence FROM r WHERE n = 1""",
)
def weighted_consensus(t: Tables):
    return aggregates.consensus(votes(t), "doc_id").withColumn("confidence", rnd("confidence", 6))


@plan(
    "a28_best_vote",
    f"""WITH {VOTE_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY confidence DESC, position) AS n
          FROM votes) SELECT doc_id, domain, category, round(confidence, 6) AS confidence FROM r WHERE n = 1""",
)
def best_vote(t: Tables):
    cast = votes(t).withColumnRenamed("position", "method_order")
    out = aggregates.best_vote(cast, "doc_id", ["domain", "category", "confidence"])
    return out.withColumn("confidence", rnd("confidence", 6))


KNN_SQL = f"""
{CENTER_SQL},
s AS (SELECT c.label AS query_id, vec_id, list_cosine_similarity(embedding::DOUBLE[], c.c) AS cos,
             list_distance(embedding::DOUBLE[], c.c) AS dist FROM embeddings, centers c),
byc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cos DESC, vec_id) AS rank FROM s) x
        WHERE rank <= 10),
bye AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, vec_id) AS rank FROM s) x
        WHERE rank <= 10)
"""


def label_queries(t: Tables):
    """The query set of the searches: one mean vector per label."""
    return vectors.small_matrix(vectors.group_means(t.embeddings, "label", "embedding"), "label", "center")


@plan(
    "a29_recall_at_k",
    f"""WITH {KNN_SQL} SELECT round(count(c.vec_id) / 10.0 / count(DISTINCT e.query_id), 6) AS recall
        FROM bye e LEFT JOIN byc c ON c.query_id = e.query_id AND c.vec_id = e.vec_id""",
)
def recall_at_k(t: Tables):
    from ospara.operators import search

    ids, matrix = label_queries(t)
    found = vectors.nearest(t.embeddings, "vec_id", "embedding", ids, matrix, 10, "cosine")
    truth = vectors.nearest(t.embeddings, "vec_id", "embedding", ids, matrix, 10, "euclidean")
    return search.recall_at_k(found, truth, "vec_id", 10).select(rnd("recall", 6).alias("recall"))


FORECAST_SQL = """
recent AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn,
                  count(*) OVER (PARTITION BY user_id) AS n FROM events),
season AS (SELECT user_id, 7 - rn AS slot, value, n FROM recent WHERE rn <= 7),
forecast AS (
  SELECT u.user_id, st.step, coalesce(CASE WHEN u.n >= 7 THEN s.value ELSE u.mean END, 0.0) AS forecast
  FROM (SELECT user_id, max(n) AS n, avg(value) AS mean FROM season GROUP BY user_id) u
  CROSS JOIN range(0, 10) st(step)
  LEFT JOIN season s ON s.user_id = u.user_id AND s.slot = st.step % 7)
"""


@plan(
    "a30_mean_forecast",
    f"""WITH {FORECAST_SQL} SELECT user_id, round(avg(forecast), 4) AS mean_demand FROM forecast GROUP BY user_id""",
)
def mean_forecast(t: Tables):
    steps = timeseries.seasonal_forecast(t.events, "user_id", ["ts", "event_id"], "value", 10)
    return steps.groupBy("user_id").agg(rnd(F.coalesce(F.avg("forecast"), F.lit(0.0)), 4).alias("mean_demand"))


@plan(
    "a31_top_means",
    """SELECT 'f' || (i - 1) AS feature, round(m, 6) AS mean FROM (
         SELECT i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, range(1, 65) r(i) GROUP BY i) x
       ORDER BY abs(m) DESC, feature LIMIT 3""",
)
def top_means(t: Tables):
    return profile.top_means(with_dims(t, 64), [f"f{i}" for i in range(64)]).withColumn("mean", rnd("mean", 6))
