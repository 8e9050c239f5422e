"""Scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ospara.operators import filters, monitor
from ospara.plans.base import TABLES, Tables, plan, rnd
from ospara.plans.bindings import asof
from ospara.session import fresh_path
from ospara.sources import generator, readers, registry, sinks


@plan("s01_ingest_dispatch", "SELECT l_orderkey, l_quantity, l_extendedprice FROM lineitem")
def ingest_dispatch(t: Tables):
    return registry.ingest(t.spark, "parquet", t.path("lineitem"), ["l_orderkey", "l_quantity", "l_extendedprice"])


def nations_of(spark, source, **_):
    """A user's loader: customers with the region of their nation."""
    tables = Tables(spark, source)
    home = tables.nation.join(tables.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return tables.customer.join(home, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "r_name")


@plan(
    "s02_custom_loader",
    """SELECT c_custkey, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def custom_loader(t: Tables):
    registry.register_loader("customer_regions", nations_of)
    return registry.ingest(t.spark, "customer_regions", t.folder)


@plan("s03_csv_round_trip", "SELECT * FROM customer")
def csv_round_trip(t: Tables):
    path = fresh_path(t.spark, "csv")
    sinks.write_csv(t.customer, path)
    return registry.ingest(t.spark, "csv", path, schema=t.customer.schema)


@plan("s03_csv_inferred", "SELECT p_partkey::BIGINT AS p_partkey, p_name, p_size, p_retailprice FROM part")
def csv_inferred(t: Tables):
    path = fresh_path(t.spark, "csv")
    sinks.write_csv(t.part, path)
    inferred = registry.ingest(t.spark, "csv", path, ["p_partkey", "p_name", "p_size", "p_retailprice"])
    return inferred.withColumn("p_partkey", F.col("p_partkey").cast("long"))


@plan("s04_sql_scan", "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def sql_scan(t: Tables):
    t.orders.createOrReplaceTempView("data")
    whole = registry.ingest(t.spark, "sql", None)
    return whole.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), rnd(F.sum("o_totalprice"), 2).alias("total"))


@plan(
    "s05_json_payload",
    """SELECT event_id, json_extract(props, '$.k')::BIGINT AS k, CASE WHEN event_id % 2 = 0 THEN event_type ELSE '' END AS kind
       FROM events""",
)
def json_payload(t: Tables):
    extra = F.concat(F.lit(',"kind":"'), F.col("event_type"), F.lit('"}'))
    widened = F.when(F.col("event_id") % 2 == 0, F.concat(F.expr("substring(props, 1, length(props) - 1)"), extra))
    payload = t.events.select("event_id", F.coalesce(widened, "props").alias("payload"))
    fields = registry.ingest(t.spark, "json", payload, column="payload")
    return fields.withColumn("kind", F.coalesce("kind", F.lit("")))


@plan(
    "s06_embedding_norms",
    "SELECT doc_id, CASE WHEN regexp_matches(text, '[A-Za-z0-9_]') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS norm FROM documents",
)
def embedding_norms(t: Tables):
    names = [F.col(f"emb_{i}") for i in range(64)]
    out = readers.text_embeddings(t.texts.select("doc_id", "text"), "text", 64)
    return out.select("doc_id", F.round(F.sqrt(sum((c * c for c in names), F.lit(0.0))), 6).alias("norm"))


@plan("s06_text_embeddings")
def text_embeddings(t: Tables):
    return readers.text_embeddings(t.texts.select("doc_id", "text"), "text", 64).drop("text")


@plan(
    "s07_rows_as_chunks",
    """SELECT '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey || ',"c_mktsegment":"'
         || c_mktsegment || '"}' AS content, 'customer' AS origin, 'c_custkey,c_name,c_nationkey,c_mktsegment' AS columns,
         'sql' AS source_type, c_custkey::VARCHAR AS chunk_id FROM customer""",
)
def rows_as_chunks(t: Tables):
    rows = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    chunks = readers.row_chunks(rows, F.col("c_custkey"), "customer", "sql")
    return chunks.select(
        "content", F.col("metadata")["source"].alias("origin"), F.col("metadata")["columns"].alias("columns"),
        "source_type", "chunk_id",
    )


@plan(
    "s08_csv_documents",
    """SELECT '{"n_nationkey":' || n_nationkey || ',"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '"}' AS content
       FROM customer JOIN nation ON n_nationkey = c_nationkey""",
)
def csv_documents(t: Tables):
    path = fresh_path(t.spark, "csv")
    rows = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    sinks.write_csv(rows.select("n_nationkey", "c_custkey", "c_mktsegment"), path)
    return readers.csv_documents(t.spark, path, schema="n_nationkey int, c_custkey long, c_mktsegment string")


@plan("s08_text_files", "SELECT lang, source, sum(length(text) + 1)::BIGINT AS chars FROM documents GROUP BY lang, source")
def text_files(t: Tables):
    path = fresh_path(t.spark, "texts")
    t.documents.select("lang", "source", "text").write.partitionBy("lang", "source").text(path)
    files = registry.ingest(t.spark, "text", path, recursiveFileLookup=True)
    where = [F.regexp_extract("chunk_id", f"{c}=([^/]+)/", 1).alias(c) for c in ("lang", "source")]
    return files.groupBy(*where).agg(F.sum(F.length("content")).alias("chars"))


@plan(
    "s09_directory_scan",
    """SELECT 'text' AS content_type, sum(strlen(html) + 1)::BIGINT AS bytes FROM pages
       UNION ALL SELECT 'json', sum(strlen('{"page_id":' || page_id || ',"url":"' || url || '"}') + 1)::BIGINT FROM pages""",
)
def directory_scan(t: Tables):
    path = fresh_path(t.spark, "pages")
    t.pages.select(F.pmod("page_id", F.lit(4)).alias("shelf"), F.col("html").alias("value")).write.partitionBy(
        "shelf"
    ).text(f"{path}/text")
    t.pages.select("page_id", "url").write.json(f"{path}/deep/json")
    files = registry.ingest(t.spark, "directory", path)
    return files.groupBy("content_type").agg(F.sum("length").alias("bytes"))


PAGE_RECORD = """'{"page_id":' || page_id || ',"url":"' || url || '"}'"""


@plan(
    "s09_directory_contents",
    f"""SELECT 'html' AS content_type, NULL AS content, sum(length(html) + 1)::BIGINT AS chars, NULL AS error FROM pages WHERE page_id % 4 = 0
        UNION ALL SELECT ['', 'json', 'csv', 'parquet'][page_id % 4 + 1], {PAGE_RECORD}, length({PAGE_RECORD}), NULL
        FROM pages WHERE page_id % 4 > 0
        UNION ALL VALUES ('json', '{{"page_id":', 11, 'malformed record'), ('parquet', NULL, NULL, 'unreadable'), (NULL, NULL, NULL, 'unknown type')""",
)
def directory_contents(t: Tables):
    """A folder of four types of files with one broken record, a broken and an unknown file among them."""
    path = fresh_path(t.spark, "mixed")
    pages = t.pages.withColumn("shelf", F.pmod("page_id", F.lit(4)))
    pages.filter("shelf = 0").select("html").write.text(f"{path}/a")
    for shelf, kind in ((1, "json"), (2, "csv"), (3, "parquet")):
        rows = pages.filter(F.col("shelf") == shelf).select("page_id", "url")
        (rows.write.option("header", True) if kind == "csv" else rows.write).format(kind).save(f"{path}/deep/{kind}")
    place = t.spark._jvm.org.apache.hadoop.fs.Path
    files = place(path).getFileSystem(t.spark._jsc.hadoopConfiguration())
    for part in files.listStatus(place(f"{path}/a")):
        name = part.getPath().toString()
        if name.endswith(".txt"):
            files.rename(part.getPath(), place(name.removesuffix(".txt") + ".html"))
    for name, text in (("x.json", '{"page_id":'), ("deep/broken.parquet", "no table"), ("x.unknown", "?")):
        out = files.create(place(f"{path}/{name}"))
        out.writeBytes(text)
        out.close()
    found = registry.ingest_directory(t.spark, path)
    pages_read = found.filter("content_type = 'html'").groupBy("content_type").agg(
        F.lit(None).cast("string").alias("content"), F.sum(F.length("content")).alias("chars"), F.max("error").alias("error"))
    others = found.filter("content_type IS NULL OR content_type <> 'html'")
    return pages_read.unionByName(others.select("content_type", "content", F.length("content").cast("long").alias("chars"), "error"))


class EventPlugin:
    """Takes sources of kind "event_log": a Parquet table, only events of the named types."""

    def can_handle(self, kind, source) -> bool:
        return kind == "event_log"

    def ingest(self, spark, source, types=(), **options):
        return spark.read.options(**options).parquet(source).filter(F.col("event_type").isin(*types))


@plan(
    "u03_plugin_ingestor",
    "SELECT event_id, user_id, event_type, value FROM events WHERE event_type IN ('click', 'purchase')",
)
def plugin_ingestor(t: Tables):
    """A plugin named by its class answers for its kind before the built-in loaders."""
    plugin = registry.load_plugin(f"{EventPlugin.__module__}.{EventPlugin.__name__}")
    try:
        return registry.ingest(
            t.spark, "event_log", t.path("events"), ["event_id", "user_id", "event_type", "value"], types=("click", "purchase"))
    finally:
        registry.unregister_plugin(plugin)


@plan(
    "s10_multi_source",
    """SELECT 'document' AS source_type, doc_id::VARCHAR AS chunk_id, text AS content FROM documents
       UNION ALL SELECT 'page', page_id::VARCHAR, html FROM pages
       UNION ALL SELECT 'turn', conv_id || '-' || turn, text FROM conversations""",
)
def multi_source(t: Tables):
    spark = t.views("documents", "pages", "conversations")
    queries = {
        "documents": "SELECT 'document' AS source_type, string(doc_id) AS chunk_id, text AS content FROM documents",
        "missing": "SELECT * FROM no_such_table_here",
        "pages": "SELECT 'page' AS source_type, string(page_id) AS chunk_id, html AS content FROM pages",
        "conversations": "SELECT 'turn' AS source_type, conv_id || '-' || turn AS chunk_id, text AS content FROM conversations",
    }
    return registry.ingest_many(spark, [registry.DataSource(n, "sql", q) for n, q in queries.items()])


@plan(
    "s11_log_routing",
    """SELECT event_id, CASE WHEN event_type IN ('signup', 'error', 'purchase') THEN 'incident_logs'
         WHEN event_type = 'click' THEN 'alert_emails' ELSE 'system_metrics' END AS target,
         CASE WHEN event_type = 'view' AND value > 85 THEN 1 ELSE 0 END AS triggered FROM events""",
)
def log_routing(t: Tables):
    routes = {"incident_logs": ["signup", "error", "purchase"], "alert_emails": ["click"]}
    routed = t.events.select(
        "event_id", filters.route(F.col("event_type"), routes, "system_metrics").alias("target"),
        F.when((F.col("event_type") == "view") & (F.col("value") > 85), 1).otherwise(0).alias("triggered"),
    )
    return sinks.write_routed(routed, fresh_path(t.spark, "routed"), "target").select("event_id", "target", "triggered")


FIELDS = {
    "day": {"type": "date", "start": "2023-01-01", "freq": "H"},
    "serial": {"type": "id", "start": 100, "step": 5},
    "wave": {"type": "sin", "amplitude": 3.0, "period": 24.0, "phase": 0.5},
    "swing": {"type": "cos", "amplitude": 2.0, "period": 30.0},
    "other": {"type": "unknown"},
}


@plan(
    "s12_generated_fixed",
    """SELECT event_id, strftime(TIMESTAMP '2023-01-01' + to_hours(event_id::INTEGER), '%Y-%m-%d %H:%M') AS day, 100 + event_id * 5 AS serial,
         round(3 * sin(2 * pi() * event_id / 24 + 0.5), 6) + 0.0 AS wave, round(2 * cos(2 * pi() * event_id / 30), 6) + 0.0 AS swing,
         0.0::DOUBLE AS other FROM events""",
)
def generated_fixed(t: Tables):
    out = generator.with_fields(t.events.select("event_id"), FIELDS, "event_id")
    return out.select("event_id", F.date_format("day", "yyyy-MM-dd HH:mm").alias("day"), "serial",
                      rnd("wave", 6).alias("wave"), rnd("swing", 6).alias("swing"), "other")


@plan("s12_generated_random")
def generated_random(t: Tables):
    fields = {
        "reading": {"type": "normal", "mean": 25.0, "std": 2.0},
        "load": {"type": "uniform", "low": 10.0, "high": 20.0},
        "status": {"type": "categorical", "categories": ["OK", "WARN", "FAIL"], "weights": [8, 1.5, 0.5]},
    }
    return generator.with_fields(t.events.select("event_id"), fields, "event_id")


@plan("s13_preview", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 5")
def preview(t: Tables):
    return t.customer.select("c_custkey", "c_name").orderBy("c_custkey").limit(5)


@plan(
    "s14_json_sink",
    """SELECT o_orderkey, o_totalprice, o_orderpriority, (SELECT count(*) FROM orders) AS record_count, '1.0' AS version FROM orders""",
)
def json_sink(t: Tables):
    path = fresh_path(t.spark, "json")
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    sinks.write_json(rows, path, "2024-01-01T00:00:00Z")
    manifest = t.spark.read.schema("generated_at string, record_count long, version string").json(f"{path}/manifest")
    data = registry.ingest(t.spark, "json", f"{path}/data", schema=rows.schema)
    envelope = manifest.first()
    return data.withColumn("record_count", F.lit(envelope.record_count)).withColumn("version", F.lit(envelope.version))


@plan(
    "s15_upsert",
    """WITH u AS (SELECT l_orderkey, max(l_shipdate) AS at, arg_max(l_linenumber, (l_shipdate, l_linenumber)) AS line
                  FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey)
       SELECT o_orderkey, CASE WHEN l_orderkey IS NULL THEN o_orderstatus ELSE 'returned' END AS status,
              coalesce(line, 0) AS line FROM orders LEFT JOIN u ON l_orderkey = o_orderkey""",
)
def upsert(t: Tables):
    target = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"), F.lit(0).alias("line"))
    updates = t.lineitem.filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("o_orderkey"), F.lit("returned").alias("status"), F.col("l_linenumber").alias("line"),
        F.col("l_shipdate").alias("_at"),
    )
    latest = sinks.newest(updates, ["o_orderkey"], ["_at", "line"]).drop("_at")
    return sinks.upsert(target, latest, ["o_orderkey"])


@plan(
    "s16_mark_processed",
    """SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
         THEN '2024-01-01' ELSE 'open' END AS processed_at FROM orders""",
)
def mark_processed(t: Tables):
    table = t.orders.select("o_orderkey", F.lit(None).cast("string").alias("processed_at"))
    done = t.lineitem.filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    marked = sinks.mark_processed(table, done, "o_orderkey", F.lit("2024-01-01"))
    return marked.fillna({"processed_at": "open"})


@plan(
    "s17_retention",
    """SELECT event_id FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY""",
)
def retention(t: Tables):
    kept = monitor.keep_recent(t.events.select("event_id", "ts"), "ts", asof(t.events), 7)
    return sinks.rewrite(kept, fresh_path(t.spark, "kept")).select("event_id")


@plan("s18_rewrite", "SELECT o_orderkey AS order_id, o_orderstatus, o_orderpriority, 'MEDIUM' AS severity FROM orders")
def rewrite(t: Tables):
    return sinks.rewrite(
        t.orders, fresh_path(t.spark, "rewrite"), drop=["o_custkey", "o_totalprice", "o_orderdate"],
        rename={"o_orderkey": "order_id"}, defaults={"severity": "MEDIUM"},
    )


@plan("s19_catalogue", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {n}" for n in TABLES))
def catalogue(t: Tables):
    return sinks.catalogue({n: getattr(t, n) for n in TABLES})


@plan(
    "s20_table_view",
    """SELECT p_partkey, (SELECT count(*) FROM part) AS total, '{' || chr(10) || '  "p_partkey" : ' || p_partkey || ',' || chr(10)
         || '  "p_brand" : "' || p_brand || '"' || chr(10) || '}' AS row_json FROM part ORDER BY p_partkey LIMIT 10""",
)
def table_view(t: Tables):
    return sinks.first_rows(t.part.select("p_partkey", "p_brand"), ["p_partkey"], 10)


_ADHOC = """
SELECT r_name, p_type, count(*) AS lines, round(sum(l_extendedprice), 2) AS price
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
WHERE l_quantity BETWEEN 10 AND 30 GROUP BY r_name, p_type"""


@plan("s21_sql_pass_through", _ADHOC)
def sql_pass_through(t: Tables):
    return registry.ingest(t.views("lineitem", "part", "supplier", "nation", "region"), "sql", _ADHOC)


@plan(
    "s22_batch_hand_off",
    """SELECT '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus
         || '","o_orderpriority":"' || o_orderpriority || '"}' AS task FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def batch_hand_off(t: Tables):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    return sinks.hand_off(t.orders, columns, [F.desc("o_totalprice"), F.asc("o_orderkey")], 10)
