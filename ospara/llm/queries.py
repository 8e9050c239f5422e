"""The numbered queries over the driver's tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ospara.llm import binary, bpe, centroids, counts, licenses, lines, minhash, packing, quality, rules, secret_scan, topk, trie
from ospara.plans.base import Tables

Query = Callable[[SparkSession, str], DataFrame]


def op1_lsh_forest(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash.near_duplicates(Tables(spark, folder).documents, width=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op2_word_table_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(bpe.encode_and_decode(Tables(spark, folder).documents))


def op3_power_of_two_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.piece_digests(packing.pack_pieces(Tables(spark, folder).documents))


def op4_naive_bayes_machine(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    return quality.scored(t.documents, quality.train(t.documents, t.labels))


def op5_pre_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts.over_limit(counts.count_tokens(Tables(spark, folder).documents))


def op6_best_fit_matrices(spark: SparkSession, folder: str) -> DataFrame:
    return binary.packed(Tables(spark, folder).documents)


def op7_weak_supervision(spark: SparkSession, folder: str) -> DataFrame:
    return rules.judged(Tables(spark, folder).documents)


def op8_positional_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scanned(Tables(spark, folder).documents)


def op9_no_random_access_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = topk.quantised(Tables(spark, folder).embeddings)
    return topk.exact_top_k(vectors, vectors.filter("id % 100 = 0")).drop("lists_read")


def op10_line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return lines.report(Tables(spark, folder).documents)


def op11_randomness_battery(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.digests(secret_scan.secrets(Tables(spark, folder).documents))


def op12_splitter_skeleton(spark: SparkSession, folder: str) -> DataFrame:
    return trie.prefix_trie(trie.rebuilt(Tables(spark, folder).conversations))


def op13_pivot_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.clustered(Tables(spark, folder).embeddings).select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


OP9_SQL = """
WITH valid AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
wanted AS (
    SELECT q.vec_id AS query_id, unnest(q.v) AS a, generate_subscripts(q.v, 1) AS j FROM valid q WHERE q.vec_id % 100 = 0
),
held AS (SELECT vec_id, unnest(v) AS b, generate_subscripts(v, 1) AS j FROM valid),
scored AS (
    SELECT query_id, vec_id, CAST(sum(a * b) AS BIGINT) AS score
    FROM wanted JOIN held USING (j) WHERE query_id <> vec_id GROUP BY query_id, vec_id
),
ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

#: The CRC of a decimal number: its characters are folded in, each followed by eight shifts.
CRC_SQL = """xor(list_reduce(
        list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
            lambda x: list_concat([ascii(x)::BIGINT], [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, CASE WHEN a % 2 = 1 THEN 3988292384 ELSE 0 END) END
    ), 4294967295)"""

OP12_SQL = f"""
WITH said AS (
    SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
),
named AS (SELECT c, turn, sha256(length(role) || ':' || role || text) AS s, length(text) AS chars FROM said),
turns AS (SELECT c, s, chars, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, s) AS k FROM named),
convs AS (SELECT c, c - c % 100 AS b, {CRC_SQL} % 6 AS h FROM (SELECT DISTINCT c FROM said)),
joined AS (
    SELECT v.c, 0 AS part, t.k, t.s, t.chars FROM convs v JOIN turns t ON t.c = v.b AND t.k <= v.h
    UNION ALL SELECT v.c, 1, t.k, t.s, t.chars FROM convs v JOIN turns t ON t.c = v.c AND t.k > v.h
),
steps AS (
    SELECT c, chars, row_number() OVER w AS d, string_agg(s, '') OVER w AS path FROM joined
    WINDOW w AS (PARTITION BY c ORDER BY part, k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
members AS (SELECT c, 0 AS chars, 0 AS d, '' AS path FROM convs UNION ALL SELECT c, chars, d, path FROM steps),
lengths AS (SELECT c, max(d) AS depth FROM members GROUP BY c),
nodes AS (
    SELECT path, any_value(d) AS d, min(c) AS conv_id, count(*) AS n, any_value(chars) AS chars,
           sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE d = depth), '')) AS ends
    FROM members JOIN lengths USING (c) GROUP BY path
),
children AS (SELECT left(path, length(path) - 64) AS path, count(*) AS children FROM nodes WHERE d > 0 GROUP BY ALL),
whole AS (SELECT nodes.*, coalesce(children, 0) AS children FROM nodes LEFT JOIN children USING (path)),
totals AS (
    SELECT left(path, 64 * i) AS path, count(*) FILTER (WHERE children = 0) AS leaves, sum((n - 1) * chars) AS saved
    FROM (SELECT *, unnest(generate_series(0, d)) AS i FROM whole) GROUP BY ALL
)
SELECT w.conv_id, CAST(w.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, w.n AS n_convs, w.children AS n_children,
       t.leaves AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, w.ends AS ends_sha256
FROM whole w JOIN totals t USING (path) LEFT JOIN nodes p ON w.d > 0 AND p.path = left(w.path, length(w.path) - 64)
"""


def op13_sql(k: int = 40, rounds: int = 5) -> str:
    """Five rounds and the last assignment, each over all pairs of vectors and centroids."""
    steps = ["""WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""", "x AS MATERIALIZED (SELECT r, unnest(v) AS a, generate_subscripts(v, 1) AS j FROM kept)", f"""c0 AS MATERIALIZED (
    SELECT c, unnest(v) AS b, generate_subscripts(v, 1) AS j
    FROM (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) - 1 AS c, v FROM kept) WHERE c < {k}
)"""]
    for i in range(rounds + 1):
        steps.append(f"d{i} AS (SELECT r, c, sum((a - b) * (a - b)) AS d FROM x JOIN c{i} USING (j) GROUP BY r, c)")
        steps.append(f"a{i} AS MATERIALIZED (SELECT r, c, d FROM d{i} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
    SELECT c, j, CASE WHEN n > 0 THEN (s - ((s % n) + n) % n) // n ELSE b END AS b
    FROM c{i} LEFT JOIN (SELECT c, j, sum(a) AS s, count(*) AS n FROM a{i} JOIN x USING (r) GROUP BY c, j) USING (c, j)
)""")
    return ",\n".join(steps) + f"""
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN kept USING (r)
JOIN (SELECT c, sha256(string_agg(CAST(CAST(b AS BIGINT) AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM c{rounds} GROUP BY c) USING (c)
"""


def queries() -> dict[str, Query]:
    return {
        "op1_lsh_forest": op1_lsh_forest,
        "op2_word_table_bpe": op2_word_table_bpe,
        "op3_power_of_two_packing": op3_power_of_two_packing,
        "op4_naive_bayes_machine": op4_naive_bayes_machine,
        "op5_pre_token_counts": op5_pre_token_counts,
        "op6_best_fit_matrices": op6_best_fit_matrices,
        "op7_weak_supervision": op7_weak_supervision,
        "op8_positional_licenses": op8_positional_licenses,
        "op9_no_random_access_top_k": op9_no_random_access_top_k,
        "op10_line_chunks": op10_line_chunks,
        "op11_randomness_battery": op11_randomness_battery,
        "op12_splitter_skeleton": op12_splitter_skeleton,
        "op13_pivot_centroids": op13_pivot_centroids,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op7_weak_supervision": rules.sql(),
        "op8_positional_licenses": licenses.sql(),
        "op9_no_random_access_top_k": OP9_SQL,
        "op12_splitter_skeleton": OP12_SQL,
        "op13_pivot_centroids": op13_sql(),
    }
