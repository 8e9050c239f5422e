"""Scalar functions."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from ospara.functions import jsonfields, rules, text, vectors
from ospara.operators import features, guardrails
from ospara.plans.aggregates import CENTER_SQL, SCORED_SQL, scored
from ospara.plans.base import Tables, plan, rnd
from ospara.plans.bindings import INCIDENT_SQL, incidents
from ospara.scale import unfold

TEXT_FIELDS_SQL = f"""
{INCIDENT_SQL},
fields AS (SELECT *, json_extract_string(payload, '$.properties.error.message') AS m,
    coalesce(json_extract_string(payload, '$.operationName.value'), json_extract_string(payload, '$.operationName')) AS o,
    coalesce(json_extract_string(payload, '$.status.value'), json_extract_string(payload, '$.status')) AS s,
    json_extract_string(payload, '$.category') AS c,
    json_extract_string(payload, '$.resourceId') AS r,
    coalesce(nullif(json_extract_string(payload, '$.properties.environment'), ''),
             nullif(json_extract_string(payload, '$.properties.env'), ''),
             nullif(json_extract_string(payload, '$.tags.Environment'), '')) AS e FROM incidents),
described AS (SELECT *, concat_ws(' ', nullif(m, ''), nullif(o, ''), nullif(s, ''), nullif(c, '')) AS analysis,
    lower(coalesce(e, CASE WHEN contains(r, 'prod-') OR contains(r, '/prod/') THEN 'prod'
                           WHEN contains(r, 'uat-') OR contains(r, '/uat/') THEN 'uat'
                           WHEN contains(r, 'dev-') OR contains(r, '/dev/') THEN 'dev' END, '')) AS env FROM fields),
factored AS (SELECT *, CASE WHEN env IN ('prod', 'production') THEN 'prod' WHEN env IN ('uat', 'staging', 'test') THEN 'uat'
                   WHEN env IN ('dev', 'development') THEN 'dev' ELSE 'unknown' END AS environment,
    CASE WHEN env IN ('prod', 'production') THEN 1.2::DOUBLE WHEN env IN ('dev', 'development') THEN 0.8::DOUBLE
         ELSE 1.0::DOUBLE END AS factor FROM described)
"""


@plan("f01_analysis_text", f"WITH {TEXT_FIELDS_SQL} SELECT event_id, analysis FROM described")
def analysis_text(t: Tables):
    return incidents(t).select("event_id", jsonfields.analysis_text("payload").alias("analysis"))


@plan("f02_environment_factor", f"WITH {TEXT_FIELDS_SQL} SELECT event_id, environment, factor FROM factored")
def environment_factor(t: Tables):
    found = incidents(t).select("event_id", jsonfields.environment("payload").alias("raw"))
    return found.select(
        "event_id", rules.environment_name(F.col("raw")).alias("environment"),
        rules.environment_factor(F.col("raw")).alias("factor"),
    )


@plan(
    "f03_environment_case",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1.2::DOUBLE WHEN 'P' THEN 0.8::DOUBLE ELSE 1.0::DOUBLE END
       AS factor FROM orders""",
)
def environment_case(t: Tables):
    env = F.when(F.col("o_orderstatus") == "F", "prod").when(F.col("o_orderstatus") == "P", "dev").otherwise("uat")
    return t.orders.select("o_orderkey", rules.environment_factor(env).alias("factor"))


@plan(
    "f04_rule_score",
    f"WITH {SCORED_SQL} SELECT l_partkey, similarity, base, factor, round(combined, 6) AS combined FROM levelled",
)
def rule_score(t: Tables):
    return scored(t).select("l_partkey", "similarity", "base", "factor", rnd("combined", 6).alias("combined"))


# Learned weights of the severity score.
WEIGHTS = {
    "bert_weight": -42.40998326989009,
    "rule_weight": 0.6392596162191154,
    "env_weight": 0.0,
    "intercept": 84.46650477826527,
}


@plan(
    "f05_learned_score",
    f"""WITH {SCORED_SQL} SELECT l_partkey, similarity, base, factor, round(
          -42.40998326989009::DOUBLE * similarity + 0.6392596162191154::DOUBLE * (base * factor) + 84.46650477826527::DOUBLE, 6)
          AS combined FROM scored""",
)
def learned_score(t: Tables):
    adjusted = F.col("base") * F.col("factor")
    score = rules.learned_score(F.col("similarity"), adjusted, F.col("factor"), WEIGHTS)
    return scored(t).select("l_partkey", "similarity", "base", "factor", rnd(score, 6).alias("combined"))


@plan("f06_severity_bucket", f"WITH {SCORED_SQL} SELECT l_partkey, l_returnflag, level FROM levelled")
def severity_bucket(t: Tables):
    return scored(t).select("l_partkey", "l_returnflag", "level")


@plan(
    "f07_matched_keywords",
    r"""SELECT doc_id, array_to_string(list_filter(regexp_split_to_array(lower(text), '[ \t\n\f\r\x0b]+'),
          lambda w: contains(w, 'worth') OR contains(w, 'tion') OR contains(w, 'the')), ' ') AS keywords FROM documents""",
)
def matched_keywords(t: Tables):
    words = text.matched_keywords("text", ["worth", "tion", "the"])
    return t.texts.select("doc_id", F.array_join(words, " ").alias("keywords"))


@plan(
    "f08_cosine_similarity",
    f"""WITH {CENTER_SQL} SELECT vec_id, label, round(list_cosine_similarity(embedding::DOUBLE[], c), 6) + 0.0 AS similarity
        FROM embeddings JOIN centers USING (label)""",
)
def cosine_similarity(t: Tables):
    names, centers = vectors.small_matrix(vectors.group_means(t.embeddings, "label", "embedding"), "label", "center")
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("label")).cast("int")
    own = F.element_at(vectors.scores_to(centers)(F.col("embedding")), place)
    return t.embeddings.select("vec_id", "label", rnd(own, 6).alias("similarity"))


@plan(
    "f09_unit_vectors",
    """SELECT vec_id, round(list_sum([x * x for x in u]), 6) AS norm, round(u[1], 6) + 0.0 AS first, round(u[64], 6) + 0.0 AS last
       FROM (SELECT vec_id, [x / sqrt(list_sum([y * y for y in e])) for x in e] AS u
             FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings) v) w""",
)
def unit_vectors(t: Tables):
    unit = t.embeddings.select("vec_id", vectors.normalized("embedding").alias("u"))
    square = F.aggregate("u", F.lit(0.0), lambda s, x: s + x * x)
    return unit.select("vec_id", rnd(square, 6).alias("norm"), rnd(F.col("u")[0], 6).alias("first"),
                       rnd(F.element_at("u", -1), 6).alias("last"))


@plan(
    "f10_masked_mean_pooling",
    """SELECT label, i::INTEGER AS dim, round(avg(embedding[i + 1]::DOUBLE), 6) + 0.0 AS mean
       FROM embeddings, range(0, 64) r(i) WHERE vec_id % 5 <> 0 GROUP BY label, i""",
)
def masked_mean_pooling(t: Tables):
    pooled = vectors.group_means(t.embeddings, "label", "embedding", mask=F.col("vec_id") % 5 != 0)
    return pooled.select("label", F.posexplode("center").alias("dim", "mean")).withColumn("mean", rnd("mean", 6))


CHUNK_SQL = """
chunks AS (SELECT doc_id, (s // 450)::INTEGER AS chunk_index, substr(text, s + 1, 500) AS chunk
  FROM (SELECT doc_id, text, unnest(range(0, greatest(length(text) - 50, 1), 450)) AS s FROM documents) x)
"""


@plan("f11_overlapping_chunks", f"WITH {CHUNK_SQL} SELECT * FROM chunks")
def overlapping_chunks(t: Tables):
    return text.chunk_rows(t.texts.select("doc_id", "text"), "text").drop("text")


@plan(
    "f12_sentence_truncation",
    """SELECT doc_id, CASE WHEN length(text) <= 1000 THEN text
         WHEN length(h) - strpos(reverse(h), '.') + 1 > 1 AND contains(h, '.')
           THEN substr(h, 1, length(h) - strpos(reverse(h), '.') + 1) ELSE h END AS head
       FROM (SELECT doc_id, text, substr(text, 1, 1000) AS h FROM documents) d""",
)
def sentence_truncation(t: Tables):
    return t.texts.select("doc_id", text.truncate_at_sentence("text").alias("head"))


PII_SQL = " UNION ALL ".join(
    f"SELECT doc_id, 'default_{n}' AS rule, 'pii' AS content_type, 'mask' AS action, "
    f"regexp_extract_all(text, '(?i){p}') AS matches FROM documents"
    for n, p in text.PII_PATTERNS.items()
)


@plan(
    "f13_pii_values",
    f"""WITH p AS ({PII_SQL}) SELECT doc_id, rule, unnest(matches) AS match FROM p""",
)
def pii_values(t: Tables):
    hits = guardrails.detections(t.texts, "doc_id", "text", text.default_rules())
    return unfold(hits, F.col("matches"), "match", ["doc_id", "rule"])


# Offsets from the pieces between matches: lengths of pieces and earlier matches.
PARTS_SQL = " UNION ALL ".join(
    f"SELECT doc_id, 'default_{n}' AS rule, regexp_extract_all(text, '(?i){p}') AS matches, "
    f"string_split_regex(text, '(?i){p}') AS parts FROM documents"
    for n, p in text.PII_PATTERNS.items()
)


OFFSET_SQL = f"""
        p AS ({PARTS_SQL}),
        u AS (SELECT doc_id, rule, unnest(matches) AS match, unnest(parts[1:len(matches)]) AS part,
                     generate_subscripts(matches, 1) AS i FROM p WHERE len(matches) > 0),
        o AS (SELECT *, sum(length(part)) OVER (PARTITION BY doc_id, rule ORDER BY i)
                + coalesce(sum(length(match)) OVER (PARTITION BY doc_id, rule ORDER BY i
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM u)
"""


@plan(
    "f13_pii_offsets",
    f"""WITH {OFFSET_SQL} SELECT doc_id, rule, s::INTEGER AS "start", (s + length(match))::INTEGER AS "end", match FROM o""",
)
def pii_offsets(t: Tables):
    def named(rule: text.DetectionRule):
        return F.transform(
            text.spans_of(rule)(F.col("text")), lambda s: F.struct(F.lit(rule.name).alias("rule"), s.alias("s"))
        )

    spans = [named(r) for r in text.default_rules()]
    hits = unfold(t.texts, F.concat(*spans), "h", ["doc_id"])
    return hits.select("doc_id", "h.rule", "h.s.start", "h.s.end", F.col("h.s.text").alias("match"))


@plan(
    "f14_literal_matches",
    """WITH p AS (SELECT doc_id, string_split(lower(text), 'the ') AS parts FROM documents),
         u AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i, len(parts) AS n FROM p),
         o AS (SELECT doc_id, i, n, sum(length(part) + 4) OVER (PARTITION BY doc_id ORDER BY i) - 4 AS pos FROM u)
       SELECT doc_id, count(*) AS n, min(pos)::BIGINT AS first, sum(pos)::BIGINT AS offsets FROM o WHERE i < n GROUP BY doc_id""",
)
def literal_matches(t: Tables):
    rule = text.DetectionRule("the", "the ", is_regex=False)
    spans = unfold(t.texts, text.spans_of(rule)(F.col("text")), "s", ["doc_id"])
    return spans.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("s.start").cast("long").alias("first"), F.sum("s.start").alias("offsets")
    )


@plan(
    "f15_span_masking",
    f"""WITH {OFFSET_SQL},
        hidden AS (SELECT DISTINCT doc_id, unnest(range(s::BIGINT, (s + length(match))::BIGINT)) AS at FROM o),
        chars AS (SELECT doc_id, unnest(string_split(text, '')) AS c, unnest(range(0, length(text))) AS at
                  FROM documents WHERE doc_id IN (SELECT doc_id FROM o)),
        redone AS (SELECT c.doc_id, string_agg(CASE WHEN h.at IS NULL THEN c ELSE '*' END, '' ORDER BY c.at) AS masked
                   FROM chars c LEFT JOIN hidden h ON h.doc_id = c.doc_id AND h.at = c.at GROUP BY c.doc_id)
        SELECT doc_id, text, coalesce(masked, text) AS masked FROM documents LEFT JOIN redone USING (doc_id)""",
)
def span_masking(t: Tables):
    safe = text.masker(text.default_rules())(F.col("text"))
    return t.texts.select("doc_id", "text", safe.alias("masked"))


@plan(
    "f16_block_or_allow",
    r"""SELECT doc_id, coalesce(toxic, 0) = 1 OR regexp_matches(text, '(?i)\bworthless\b') AS blocked,
         CASE WHEN coalesce(toxic, 0) = 1 OR regexp_matches(text, '(?i)\bworthless\b') THEN 0 ELSE length(text) END AS kept
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def block_or_allow(t: Tables):
    checks = [*text.default_rules(), text.DetectionRule("insult", r"\bworthless\b", "offensive", "block")]
    scored_docs = t.texts.select("doc_id", "text").join(t.labels.select("doc_id", "toxic"), "doc_id", "left")
    guarded = guardrails.guard(scored_docs, "text", checks, F.col("toxic").cast("double"))
    return guarded.select("doc_id", "blocked", F.length("safe_text").cast("long").alias("kept"))


@plan(
    "f17_secret_rule",
    r"""SELECT doc_id, len(regexp_extract_all(t, '(?i)\b(?:api_key|token|secret)=\S+\b'))::INTEGER AS hits
        FROM (SELECT doc_id, replace(text, ' the ', ' token=abc-') AS t FROM documents) d
        WHERE regexp_matches(t, '(?i)\b(?:api_key|token|secret)=\S+\b')""",
)
def secret_rule(t: Tables):
    rule = text.DetectionRule("secret", text.SECRET_PATTERN, "security")
    docs = t.texts.select("doc_id", F.replace("text", F.lit(" the "), F.lit(" token=abc-")).alias("text"))
    return docs.select("doc_id", F.size(text.found("text", rule)).alias("hits")).filter("hits > 0")


@plan(
    "f18_toxicity_gate",
    """SELECT doc_id, score, CASE WHEN score > 0.9 THEN 'block' WHEN score >= 0.8 THEN 'log' ELSE 'none' END AS verdict
       FROM (SELECT doc_id, toxic * 0.5::DOUBLE + (doc_id % 6) * 0.1::DOUBLE AS score FROM labels) s""",
)
def toxicity_gate(t: Tables):
    score = F.col("toxic") * 0.5 + F.col("doc_id") % 6 * 0.1
    return t.labels.select("doc_id", score.alias("score")).withColumn("verdict", rules.toxicity_gate(F.col("score")))


@plan(
    "f19_confidence_gate",
    """SELECT doc_id, CASE WHEN d >= 0.7 THEN lang ELSE 'unknown' END AS domain,
         CASE WHEN d >= 0.7 THEN source ELSE 'unknown' END AS category,
         round(CASE WHEN d >= 0.7 THEN least(d, c) ELSE d END, 6) AS confidence
       FROM (SELECT doc_id, lang, source, 0.4::DOUBLE + (doc_id % 6) * 0.1::DOUBLE AS d,
                    0.3::DOUBLE + (n_chars % 7) * 0.1::DOUBLE AS c FROM documents) x""",
)
def confidence_gate(t: Tables):
    docs = t.documents.select(
        "doc_id", "lang", "source", (F.lit(0.4) + F.col("doc_id") % 6 * 0.1).alias("d"),
        (F.lit(0.3) + F.col("n_chars") % 7 * 0.1).alias("c"),
    )
    gate = rules.confidence_gate(F.col("lang"), F.col("d"), F.col("source"), F.col("c"))
    return docs.select("doc_id", gate.alias("g")).select(
        "doc_id", "g.domain", "g.category", rnd("g.confidence", 6).alias("confidence")
    )


@plan(
    "f20_category_domain",
    """SELECT doc_id, category, CASE WHEN category IN ('api', 'data', 'testing') THEN 'technical'
         WHEN category IN ('sales', 'hr') THEN 'business' ELSE 'general' END AS domain
       FROM (SELECT doc_id, ['api', 'sales', 'recipes', 'data', 'hr', 'testing'][(doc_id % 6 + 1)::INTEGER] AS category
             FROM documents) d""",
)
def category_domain(t: Tables):
    names = F.array(*[F.lit(c) for c in ("api", "sales", "recipes", "data", "hr", "testing")])
    docs = t.documents.select("doc_id", F.get(names, (F.col("doc_id") % 6).cast("int")).alias("category"))
    return docs.withColumn("domain", rules.domain_of(F.col("category")))


@plan(
    "f21_severity_priority",
    """SELECT o_orderkey, CASE split_part(o_orderpriority, '-', 2) WHEN 'LOW' THEN 1 WHEN 'MEDIUM' THEN 2
         WHEN 'HIGH' THEN 3 ELSE 1 END AS priority FROM orders""",
)
def severity_priority(t: Tables):
    severity = F.split_part("o_orderpriority", F.lit("-"), F.lit(2))
    return t.orders.select("o_orderkey", rules.priority_of(severity).alias("priority"))


@plan(
    "f22_label_encoding",
    """SELECT o_orderkey, o_orderpriority, (dense_rank() OVER (ORDER BY o_orderpriority) - 1)::DOUBLE AS code FROM orders""",
)
def label_encoding(t: Tables):
    indexer = StringIndexer(inputCol="o_orderpriority", outputCol="code", stringOrderType="alphabetAsc")
    orders = t.orders.select("o_orderkey", "o_orderpriority")
    return features.decode_labels(indexer.fit(orders), orders, "code").select(
        "o_orderkey", F.col("code_text").alias("o_orderpriority"), "code"
    )


@plan(
    "f23_one_hot",
    """SELECT o_orderkey, o_orderstatus = 'F' AS "o_orderstatus_F", o_orderstatus = 'O' AS "o_orderstatus_O",
         o_orderstatus = 'P' AS "o_orderstatus_P", o_orderpriority = '1-URGENT' AS "o_orderpriority_1-URGENT",
         o_orderpriority = '2-HIGH' AS "o_orderpriority_2-HIGH", o_orderpriority = '3-MEDIUM' AS "o_orderpriority_3-MEDIUM",
         o_orderpriority = '4-NOT SPECIFIED' AS "o_orderpriority_4-NOT SPECIFIED",
         o_orderpriority = '5-LOW' AS "o_orderpriority_5-LOW" FROM orders""",
)
def one_hot(t: Tables):
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return features.one_hot(orders, ["o_orderstatus", "o_orderpriority"])


@plan(
    "f24_time_difference",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso,
         round(date_diff('microsecond', TIMESTAMP '2024-01-01', date_trunc('second', ts)) / 3600000000.0, 6) AS hours,
         round(date_diff('microsecond', TIMESTAMP '2024-01-01', date_trunc('second', ts)) / 60000000.0, 6) AS minutes
       FROM events""",
)
def time_difference(t: Tables):
    iso = t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("iso"))
    parsed = F.to_timestamp_ntz("iso", F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))
    gap = iso.withColumn("_at", parsed).withColumn(
        "_s", F.expr("timestampdiff(SECOND, timestamp_ntz'2024-01-01 00:00:00', _at)")
    )
    return gap.select("event_id", "iso", rnd(F.col("_s") / 3600.0, 6).alias("hours"), rnd(F.col("_s") / 60.0, 6).alias("minutes"))


@plan(
    "f25_trig_series",
    """SELECT event_id, round(3 * sin(2 * pi() * event_id / 24 + 0.5), 6) + 0.0 AS wave,
              round(2 * cos(2 * pi() * event_id / 30), 6) + 0.0 AS swing FROM events""",
)
def trig_series(t: Tables):
    turn = F.lit(2) * F.pi() * F.col("event_id")
    return t.events.select(
        "event_id", rnd(F.lit(3) * F.sin(turn / 24 + 0.5), 6).alias("wave"), rnd(F.lit(2) * F.cos(turn / 30), 6).alias("swing")
    )


@plan(
    "f26_rounding",
    """SELECT o_orderkey, round(o_totalprice / 7, 2) AS r2, printf('%.1f%%', o_totalprice / 7000) AS share FROM orders""",
)
def rounding(t: Tables):
    p = F.col("o_totalprice")
    return t.orders.select("o_orderkey", rnd(p / 7, 2).alias("r2"), F.concat(text.fixed_text(p / 7000, 1), F.lit("%")).alias("share"))


@plan(
    "f27_reorder",
    """SELECT p_partkey, round(threshold, 4) AS threshold, CASE WHEN p_size < threshold THEN 'reorder' ELSE 'hold' END AS decision,
         CASE WHEN p_size < threshold THEN greatest(1, round_even(threshold - p_size, 0)::BIGINT) ELSE 0 END AS qty
       FROM (SELECT p_partkey, p_size, coalesce(avg(l_quantity), 0) * 1.2::DOUBLE AS threshold FROM part
             LEFT JOIN lineitem ON l_partkey = p_partkey GROUP BY p_partkey, p_size) x""",
)
def reorder(t: Tables):
    demand = t.lineitem.groupBy("l_partkey").agg(F.avg("l_quantity").alias("mean"))
    stock = t.part.select("p_partkey", "p_size").join(demand, F.col("l_partkey") == F.col("p_partkey"), "left")
    parts = rules.reorder_quantity(F.col("p_size"), F.coalesce("mean", F.lit(0.0)))
    return stock.select("p_partkey", rnd(parts["threshold"], 4).alias("threshold"), parts["decision"].alias("decision"),
                        parts["qty"].alias("qty"))


@plan(
    "f28_array_json",
    """SELECT doc_id, '["' || lang || '","' || source || '"]' AS tags, '[{"rank":1,"chars":' || n_chars || '}]' AS matches
       FROM documents""",
)
def array_json(t: Tables):
    best = F.array(F.struct(F.lit(1).alias("rank"), F.col("n_chars").alias("chars")))
    return t.documents.select(
        "doc_id", F.to_json(F.array("lang", "source")).alias("tags"), F.to_json(best).alias("matches")
    )


@plan(
    "f29_task_record",
    """SELECT o_orderkey, '{"action":"analyze_incident","incident_id":' || o_orderkey || ',"vector_id":"vec-' || o_custkey || '"}'
         AS task_json, 'pending' AS status, 'triage' AS agent,
         CASE split_part(o_orderpriority, '-', 2) WHEN 'LOW' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'HIGH' THEN 3 ELSE 1 END AS priority
       FROM orders""",
)
def task_record(t: Tables):
    from ospara.operators import monitor

    orders = t.orders.select(
        F.col("o_orderkey").alias("incident_id"), F.concat(F.lit("vec-"), F.col("o_custkey")).alias("vector_id"),
        F.split_part("o_orderpriority", F.lit("-"), F.lit(2)).alias("severity"),
    )
    tasks = monitor.task_records(orders, "analyze_incident")
    return tasks.select(F.col("incident_id").alias("o_orderkey"), "task_json", "status", "agent", "priority")
