"""Statistics and machine-learning operators."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import Window
from pyspark.sql import functions as F

from ospara.functions import jsonfields, rules, text, vectors
from ospara.operators import classify, clustering, density, features, hyper, models, profile, severity
from ospara.plans.aggregates import CENTER_SQL, SCORED_SQL, SILHOUETTE_SQL, label_queries, scored, with_dims
from ospara.plans.base import Tables, plan, rnd
from ospara.plans.bindings import incidents, readings
from ospara.plans.combining import rule_case
from ospara.plans.kmeans_sql import kmeans_sql
from ospara.plans.scalars import TEXT_FIELDS_SQL, WEIGHTS
from ospara.session import fresh_path, materialize

GAP_COLUMNS = ["quantity", "discount", "tax"]
GAP_SQL = """
gaps AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 10 <> 3 THEN l_quantity END AS quantity,
                CASE WHEN l_orderkey % 10 <> 7 THEN l_discount END AS discount, l_tax AS tax FROM lineitem)
"""


def with_gaps(t: Tables, *more):
    key = F.col("l_orderkey") % 10
    return t.lines.select(
        "l_orderkey", "l_linenumber", *more, F.when(key != 3, F.col("l_quantity")).alias("quantity"),
        F.when(key != 7, F.col("l_discount")).alias("discount"), F.col("l_tax").alias("tax"),
    )


def imputed(t: Tables, strategy: str):
    out = features.impute(with_gaps(t), GAP_COLUMNS, strategy)
    return out.select("l_orderkey", "l_linenumber", *[rnd(c, 6).alias(c) for c in GAP_COLUMNS])


def impute_sql(value: str) -> str:
    filled = ", ".join(
        f"round(coalesce({c}, (SELECT {value.replace('{c}', c)} FROM gaps)), 6) AS {c}" for c in GAP_COLUMNS
    )
    return f"WITH {GAP_SQL} SELECT l_orderkey, l_linenumber, {filled} FROM gaps"


@plan("m01_impute_median", impute_sql("quantile_cont({c}, 0.5)"))
def impute_median(t: Tables):
    return imputed(t, "median")


@plan("m01_impute_mean", impute_sql("avg({c})"))
def impute_mean(t: Tables):
    return imputed(t, "mean")


MODE_SQL = ", ".join(
    f"(SELECT {c} FROM gaps WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS m_{c}"
    for c in GAP_COLUMNS
)


@plan(
    "m01_impute_most_frequent",
    f"WITH {GAP_SQL}, m AS (SELECT {MODE_SQL}) SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"round(coalesce({c}, m_{c}), 6) AS {c}" for c in GAP_COLUMNS) + " FROM gaps, m",
)
def impute_most_frequent(t: Tables):
    return imputed(t, "most_frequent")


@plan(
    "m02_impute_knn",
    """WITH g AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 10 <> 3 THEN l_quantity END AS quantity,
                         l_discount AS discount, l_tax AS tax FROM lineitem),
         d AS (SELECT quantity, discount, tax, count(*) AS n FROM g WHERE quantity IS NOT NULL GROUP BY ALL),
         r AS (SELECT DISTINCT discount, tax FROM g WHERE quantity IS NULL),
         p AS (SELECT r.discount, r.tax, d.quantity, d.n,
                 round(sqrt((power(r.discount - d.discount, 2) + power(r.tax - d.tax, 2)) * 3 / 2), 9) AS dist FROM r, d),
         o AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY discount, tax ORDER BY dist, quantity
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM p),
         a AS (SELECT discount, tax, sum(quantity * least(n, 5 - before)) / 5.0 AS v FROM o WHERE before < 5
               GROUP BY discount, tax)
       SELECT l_orderkey, l_linenumber, round(coalesce(g.quantity, a.v), 6) AS quantity
       FROM g LEFT JOIN a USING (discount, tax)""",
)
def impute_knn(t: Tables):
    gaps = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 10 != 3, F.col("l_quantity")).alias("quantity"),
        F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax"),
    )
    filled = features.knn_impute(gaps, GAP_COLUMNS)
    return filled.select("l_orderkey", "l_linenumber", rnd("quantity", 6).alias("quantity"))


@plan(
    "m03_impute_iterative",
    """WITH g AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 10 <> 3 THEN l_quantity END AS quantity,
                         l_extendedprice / 1000 AS price FROM lineitem),
         f AS (SELECT regr_slope(quantity, price) AS a, regr_intercept(quantity, price) AS b FROM g WHERE quantity IS NOT NULL)
       SELECT l_orderkey, l_linenumber, round(coalesce(quantity, b + a * price), 4) AS quantity FROM g, f""",
)
def impute_iterative(t: Tables):
    gaps = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 10 != 3, F.col("l_quantity")).alias("quantity"),
        (F.col("l_extendedprice") / 1000).alias("price"),
    )
    filled = features.iterative_impute(gaps, ["quantity", "price"])
    return filled.select("l_orderkey", "l_linenumber", rnd("quantity", 4).alias("quantity"))


SCALE_COLUMNS = ["l_quantity", "l_extendedprice"]


def scale_sql(offset: str, divisor: str) -> str:
    parts = ", ".join(
        f"round(({c} - (SELECT {offset.replace('{c}', c)} FROM lineitem)) / "
        f"(SELECT {divisor.replace('{c}', c)} FROM lineitem), 6) + 0.0 AS {c}"
        for c in SCALE_COLUMNS
    )
    return f"SELECT l_orderkey, l_linenumber, {parts} FROM lineitem"


def scaled(t: Tables, method: str):
    out = features.scale(t.lines.select("l_orderkey", "l_linenumber", *SCALE_COLUMNS), SCALE_COLUMNS, method)
    return out.select("l_orderkey", "l_linenumber", *[rnd(c, 6).alias(c) for c in SCALE_COLUMNS])


@plan("m04_scale_standard", scale_sql("avg({c})", "stddev_pop({c})"))
def scale_standard(t: Tables):
    return scaled(t, "standard")


@plan("m04_scale_robust", scale_sql("quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"))
def scale_robust(t: Tables):
    return scaled(t, "robust")


@plan("m04_scale_minmax", scale_sql("min({c})", "max({c}) - min({c})"))
def scale_minmax(t: Tables):
    return scaled(t, "minmax")


@plan(
    "m05_impute_and_scale",
    f"""WITH {GAP_SQL}, f AS (SELECT l_orderkey, l_linenumber, """
    + ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM gaps)) AS {c}" for c in GAP_COLUMNS)
    + """ FROM gaps) SELECT l_orderkey, l_linenumber, """
    + ", ".join(
        f"round(({c} - (SELECT quantile_cont({c}, 0.5) FROM f)) / "
        f"(SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM f), 6) + 0.0 AS {c}" for c in GAP_COLUMNS
    )
    + " FROM f",
)
def impute_and_scale(t: Tables):
    out = features.preprocess(with_gaps(t), GAP_COLUMNS)
    return out.select("l_orderkey", "l_linenumber", *[rnd(c, 6).alias(c) for c in GAP_COLUMNS])


def reduction(t: Tables, n: int | None = None):
    names = [f"f{i}" for i in range(64)]
    table = with_dims(t, 64)
    return table, features.reduce(table, names, n=n, threshold=0.95)


VARIANCES_SQL = "SELECT round(" + " + ".join(f"var_samp(embedding[{i + 1}]::DOUBLE)" for i in range(64)) + ", 4) AS total, true AS falling, true AS uncorrelated FROM embeddings"


@plan("m06_component_variances", VARIANCES_SQL)
def component_variances(t: Tables):
    """Variances of all components fall and sum to those of the columns; neighbours do not correlate."""
    table, fit = reduction(t, 64)
    names = [f"pca{j + 1}" for j in range(64)]
    row = fit.apply(table).agg(
        F.array(*[F.var_samp(n) for n in names]).alias("v"),
        F.array(*[F.abs(F.covar_samp(a, b)) for a, b in zip(names, names[1:])]).alias("c"),
    )
    falling = F.forall(F.sequence(F.lit(1), F.lit(63)), lambda i: F.get("v", i) <= F.get("v", i - 1) + 1e-9)
    return row.select(
        F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + x), 4).alias("total"), falling.alias("falling"),
        (F.array_max("c") < 1e-6).alias("uncorrelated"))


@plan("m06_components")
def components(t: Tables):
    table, fit = reduction(t)
    return fit.apply(table).select("vec_id", *[rnd(f"pca{j + 1}", 6).alias(f"pca{j + 1}") for j in range(fit.components)])


@plan("m07_component_report")
def component_report(t: Tables):
    from ospara.operators import search

    _, fit = reduction(t, 10)
    loadings = t.spark.createDataFrame(fit.loading_rows(), "component int, feature string, loading double")
    shares = t.spark.createDataFrame(
        [(j + 1, float(s)) for j, s in enumerate(fit.shares)], "component int, share double"
    )
    drivers = search.main_drivers(loadings, 0.2)
    return shares.join(drivers, "component", "left").orderBy("component")


TOTAL_SQL = "(SELECT sum(v) FROM (SELECT var_samp(embedding[i]::DOUBLE) AS v FROM embeddings, range(1, 65) x(i) GROUP BY i))"


def component_check(t: Tables, n: int):
    """Each component solves the eigenvalue equation over all rows, with unit length, at right angles, in falling order."""
    table, fit = reduction(t, n)
    rows = fit.check(table)
    shares = F.get(F.array(*[F.lit(float(s)) for s in fit.shares]), F.col("component") - 1)
    earlier = F.lag("eigenvalue").over(Window.orderBy("component"))
    return rows.select(
        "component", rnd(F.col("eigenvalue") / F.col("share"), 6).alias("total"), (F.col("residual") < 1e-9).alias("solves"),
        (F.abs(F.col("length") - 1) < 1e-9).alias("unit"), (F.col("overlap") < 1e-9).alias("at_right_angles"),
        (F.abs(F.col("share") - shares) < 1e-9).alias("share_agrees"), F.coalesce(earlier >= F.col("eigenvalue"), F.lit(True)).alias("falling"))


def component_check_sql(n: int) -> str:
    return f"""SELECT i::INTEGER AS component, round({TOTAL_SQL}, 6) AS total, true AS solves, true AS unit, true AS at_right_angles,
        true AS share_agrees, true AS falling FROM range(1, {n + 1}) x(i)"""


@plan("m06_eigen_equation", component_check_sql(64))
def eigen_equation(t: Tables):
    return component_check(t, 64)


@plan("m07_report_components", component_check_sql(10))
def report_components(t: Tables):
    return component_check(t, 10)


@plan("m27_projected_plane", component_check_sql(2))
def projected_plane(t: Tables):
    return component_check(t, 2)


@plan("m08_kmeans")
def kmeans(t: Tables):
    _, out = clustering.kmeans(t.embeddings.select("vec_id", "embedding"), "embedding", 8)
    return out.select("vec_id", "cluster")


@plan(
    "m08_fixed_assignment",
    f"""WITH {CENTER_SQL}, d AS (SELECT vec_id, c.label AS cluster, row_number() OVER (
            PARTITION BY vec_id ORDER BY list_distance(embedding::DOUBLE[], c.c), c.label) AS n FROM embeddings, centers c)
        SELECT vec_id, cluster FROM d WHERE n = 1""",
)
def fixed_assignment(t: Tables):
    return clustering.assign(t.embeddings, "embedding", *label_queries(t)).select("vec_id", "cluster")


def dbscan_sql(points: str, key: str, distance: str, eps: float) -> str:
    """All pairs, the closure of core points, numbers along the smallest core point, and border points."""
    return f"""WITH RECURSIVE pts AS ({points}),
        near AS (SELECT a.{key} AS a, b.{key} AS b FROM pts a JOIN pts b ON {distance} <= {eps}),
        core AS (SELECT a AS {key} FROM near GROUP BY a HAVING count(*) >= 5),
        links AS (SELECT a, b FROM near WHERE a IN (FROM core) AND b IN (FROM core)),
        reach AS (SELECT {key} AS root, {key} FROM core UNION SELECT r.root, l.b FROM reach r JOIN links l ON l.a = r.{key}),
        comp AS (SELECT {key}, min(root) AS c FROM reach GROUP BY {key}),
        first AS (SELECT c, min(p) AS p FROM comp JOIN pts USING ({key}) GROUP BY c),
        num AS (SELECT c, row_number() OVER (ORDER BY p) - 1 AS cluster FROM first),
        own AS (SELECT comp.{key}, cluster FROM comp JOIN num USING (c)),
        edge AS (SELECT n.a AS {key}, min(cluster) AS cluster FROM near n JOIN own ON own.{key} = n.b
                 WHERE n.a NOT IN (FROM core) GROUP BY n.a)
        SELECT p.{key}, own.cluster IS NOT NULL AS core, coalesce(own.cluster, edge.cluster, -1) AS cluster
        FROM pts p LEFT JOIN own USING ({key}) LEFT JOIN edge USING ({key})"""


VECTOR_SQL = "SELECT vec_id, embedding::DOUBLE[] AS p FROM embeddings"
ACCOUNT_SQL = "SELECT c_custkey, c_acctbal / 1000 AS x, c_nationkey / 4.0 AS y, {'x': x, 'y': y} AS p FROM customer"


@plan(
    "m09_dbscan_core",
    f"""WITH pts AS ({VECTOR_SQL}) SELECT a.vec_id, count(*) >= 5 AS core
        FROM pts a JOIN pts b ON list_distance(a.p, b.p) <= 1.16 GROUP BY a.vec_id""",
)
def dbscan_core(t: Tables):
    points = t.embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return points.join(density.core_points(points, "v", 1.16, 5), "v").select("vec_id", "core")


@plan("m09_dbscan_clusters", dbscan_sql(VECTOR_SQL, "vec_id", "list_distance(a.p, b.p)", 1.16))
def dbscan_clusters(t: Tables):
    return density.dbscan(t.embeddings, "embedding", 1.16, 5).select("vec_id", "core", "cluster")


@plan("m09_dbscan_plane", dbscan_sql(ACCOUNT_SQL, "c_custkey", "sqrt(power(a.x - b.x, 2) + power(a.y - b.y, 2))", 0.1))
def dbscan_plane(t: Tables):
    accounts = t.customer.select("c_custkey", (F.col("c_acctbal") / 1000).alias("x"), (F.col("c_nationkey") / 4.0).alias("y"))
    return density.dbscan(accounts, ["x", "y"], 0.1, 5).select("c_custkey", "core", "cluster")


@plan("m10_cluster_sums", "SELECT count(*) AS n, 6::BIGINT AS clusters, true AS tighter FROM embeddings")
def cluster_sums(t: Tables):
    """All vectors fall into the asked number of clusters, whose inner squares stay below the whole's."""
    labelled = clustering.hierarchical(t.embeddings.select("vec_id", "embedding"), "embedding", 6)
    stats = clustering.cluster_stats(labelled, "cluster", "embedding")
    whole = clustering.cluster_stats(labelled.withColumn("one", F.lit(0)), "one", "embedding")

    def inner(s) -> float:
        return float((s.squares - (s.sums**2).sum(axis=1) / s.counts).sum())

    tighter = inner(stats) < inner(whole)
    return t.spark.range(1).select(
        F.lit(int(stats.counts.sum())).cast("long").alias("n"), F.lit(len(stats.counts)).cast("long").alias("clusters"),
        F.lit(tighter).alias("tighter"))


@plan("m10_hierarchical")
def hierarchical(t: Tables):
    return clustering.hierarchical(t.embeddings.select("vec_id", "embedding"), "embedding", 6).select("vec_id", "cluster")


@plan("m11_silhouette", f"WITH {SILHOUETTE_SQL} SELECT vec_id, label, round(s, 6) + 0.0 AS silhouette FROM sil")
def silhouette(t: Tables):
    out = clustering.with_silhouette(t.embeddings, "label", "embedding")
    return out.select("vec_id", "label", rnd("silhouette", 6).alias("silhouette"))


@plan(
    "m12_davies_bouldin",
    f"""WITH {CENTER_SQL}, s AS (SELECT label, avg(list_distance(embedding::DOUBLE[], c)) AS s
            FROM embeddings JOIN centers USING (label) GROUP BY label),
        r AS (SELECT a.label, max((sa.s + sb.s) / list_distance(a.c, b.c)) AS worst
              FROM centers a JOIN centers b ON a.label <> b.label JOIN s sa ON sa.label = a.label
              JOIN s sb ON sb.label = b.label GROUP BY a.label)
        SELECT count(*) AS clusters, round(avg(worst), 6) AS davies_bouldin FROM r""",
)
def davies_bouldin(t: Tables):
    value = clustering.davies_bouldin(t.embeddings, "label", "embedding")
    count = t.embeddings.agg(F.count_distinct("label").alias("clusters"))
    return count.select("clusters", rnd(F.lit(value), 6).alias("davies_bouldin"))


@plan(
    "m13_choose_k",
    f"""WITH {kmeans_sql("SELECT vec_id AS r, embedding::DOUBLE[] AS v FROM embeddings", range(2, 11))}
        SELECT k::INTEGER AS k, round(silhouette, 6) AS silhouette, round(davies_bouldin, 6) AS davies_bouldin,
               round(combined, 6) + 0.0 AS combined, row_number() OVER (ORDER BY combined DESC, k) = 1 AS best FROM score""",
)
def choose_k(t: Tables):
    best, table = clustering.choose_k(t.embeddings, "embedding", range(2, 11), key="vec_id")
    return table.select("k", *[rnd(c, 6).alias(c) for c in ("silhouette", "davies_bouldin", "combined")], (F.col("k") == best).alias("best"))


@plan(
    "m14_center_distance",
    f"""WITH {CENTER_SQL} SELECT vec_id, round(min(list_distance(embedding::DOUBLE[], c.c)), 6) AS distance_to_center
        FROM embeddings, centers c GROUP BY vec_id""",
)
def center_distance(t: Tables):
    _, centers = label_queries(t)
    out = clustering.with_center_distance(t.embeddings, "embedding", centers)
    return out.select("vec_id", rnd("distance_to_center", 6).alias("distance_to_center"))


@plan("m15_feature_table")
def feature_table(t: Tables):
    base = t.lines.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag")
    return hyper.feature_table(base, ["l_quantity", "l_extendedprice", "l_discount"], ["l_returnflag"], 6)


TRIALS = [
    {"k": 4, "imputer": "median", "scaler": "robust"},
    {"k": 6, "imputer": "mean", "scaler": "standard"},
    {"k": 5, "imputer": "most_frequent", "scaler": "minmax"},
]
IMPUTE_SQL = {"median": "quantile_cont({c}, 0.5)", "mean": "avg({c})", "most_frequent": "any_value(m_{c})"}
SCALE_SQL = {
    "robust": ("quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"),
    "standard": ("avg({c})", "stddev_pop({c})"), "minmax": ("min({c})", "max({c}) - min({c})"),
}


ROW_KEY_SQL = "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey"


def sweep_sql() -> str:
    """All trials prepared and clustered; a full rotation changes no distance, so components are left out."""
    keyed = GAP_SQL.strip().replace("l_linenumber, CASE", f"l_linenumber, {ROW_KEY_SQL} AS r, CASE", 1)
    parts = [keyed, f"modes AS (SELECT {MODE_SQL})"]
    for i, trial in enumerate(TRIALS):
        low, width = SCALE_SQL[trial["scaler"]]
        gaps = ", ".join(f"{IMPUTE_SQL[trial['imputer']].format(c=c)} AS i_{c}" for c in GAP_COLUMNS)
        filled = ", ".join(f"coalesce({c}, i_{c}) AS {c}" for c in GAP_COLUMNS)
        sizes = ", ".join(f"{low.format(c=c)} AS l_{c}, {width.format(c=c)} AS w_{c}" for c in GAP_COLUMNS)
        vector = ", ".join(f"({c} - l_{c}) / CASE WHEN w_{c} = 0 THEN 1 ELSE w_{c} END" for c in GAP_COLUMNS)
        parts += [
            f"gap{i} AS (SELECT {gaps} FROM gaps, modes)",
            f"fill{i} AS (SELECT r, {filled} FROM gaps, gap{i})",
            f"size{i} AS (SELECT {sizes} FROM fill{i})",
            kmeans_sql(f"SELECT r, [{vector}] AS v FROM fill{i}, size{i}", [trial["k"]], f"t{i}"),
        ]
    rows = " UNION ALL ".join(
        f"SELECT {i} AS iteration, k::INTEGER AS k, '{t['imputer']}' AS imputer, '{t['scaler']}' AS scaler, silhouette, davies_bouldin AS db, combined FROM scoret{i}"
        for i, t in enumerate(TRIALS))
    labels = " UNION ALL ".join(f"SELECT {i} AS iteration, r, c FROM labelt{i}" for i in range(len(TRIALS)))
    return "WITH " + ",\n".join(parts) + f",\nhistory AS ({rows}),\nlabels AS ({labels})"


def keyed_gaps(t: Tables):
    return with_gaps(t, F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_key"))


@plan(
    "m16_sweep",
    f"""{sweep_sql()} SELECT iteration, k, imputer, scaler, round(silhouette, 6) AS silhouette, round(db, 6) AS db,
        round(combined, 6) AS combined FROM history""",
)
def sweep(t: Tables):
    history = hyper.sweep(keyed_gaps(t), GAP_COLUMNS, TRIALS, threshold=1.0, key="row_key")
    return history.select("iteration", "k", "imputer", "scaler", *[rnd(c, 6).alias(c) for c in ("silhouette", "db", "combined")])


@plan(
    "m16_best_setting",
    f"""{sweep_sql()} SELECT l_orderkey, l_linenumber, c::INTEGER AS cluster FROM gaps JOIN labels USING (r)
        WHERE iteration = (SELECT iteration FROM history ORDER BY combined DESC, iteration LIMIT 1)""",
)
def best_setting(t: Tables):
    """The best setting of the sweep, run again and stored."""
    rows = keyed_gaps(t)
    history = hyper.sweep(rows, GAP_COLUMNS, TRIALS, threshold=1.0, key="row_key")
    return hyper.rerun_best(rows, GAP_COLUMNS, history, threshold=1.0, key="row_key").select("l_orderkey", "l_linenumber", "cluster")


def labelled_readings(t: Tables):
    milk, temp, feed = F.col("milk_yield"), F.col("cow_temp"), F.col("feed_intake")
    abnormal = (milk < 10) | (milk > 32) | (temp > 39.5) | (feed < 8)
    return readings(t, t.lines).withColumn("label", abnormal.cast("double"))


SENSORS = ["milk_yield", "cow_temp", "feed_intake"]


@plan("m17_anomaly_forest")
def anomaly_forest(t: Tables):
    data = labelled_readings(t)
    model = models.anomaly_model(data, SENSORS, "label", trees=20)
    out = models.class_probability(model.transform(data))
    return out.select("l_orderkey", "l_linenumber", "label", "prediction", rnd("confidence", 6).alias("confidence"))


@plan("m18_gate", "SELECT vec_id, label::DOUBLE AS label, true AS gate_holds FROM embeddings")
def classifier_gate(t: Tables):
    """Every vector has a class; it is accepted just where its probability reaches the gate."""
    out = vector_classifier(t)
    fits = F.col("accepted") == F.when(F.col("confidence") >= 0.6, F.col("prediction")).otherwise(-1.0)
    known = F.col("prediction").isin(*[float(i) for i in range(10)]) & F.col("confidence").between(0.0, 1.0)
    return out.select("vec_id", "label", (fits & known).alias("gate_holds"))


@plan("m18_vector_classifier")
def vector_classifier(t: Tables):
    data = t.embeddings.select("vec_id", "embedding", F.col("label").cast("double").alias("label"))
    model = models.vector_classifier(data, "embedding", "label", trees=20)
    out = models.class_probability(model.transform(models.as_features(data, "embedding")))
    accepted = F.when(F.col("confidence") >= 0.6, F.col("prediction")).otherwise(-1.0)
    return out.select("vec_id", "label", "prediction", rnd("confidence", 6).alias("confidence"), accepted.alias("accepted"))


def severity_features(t: Tables):
    return scored(t, t.lines).select("similarity", (F.col("base") * F.col("factor")).alias("adjusted"), "factor", "level")


@plan("m19_severity_logistic")
def severity_logistic(t: Tables):
    _, test = models.severity_model(severity_features(t), ["similarity", "adjusted", "factor"], "level")
    return models.classification_report(test, "label", "prediction")


@plan(
    "m20_one_weight",
    f"""WITH {SCORED_SQL}, y AS (SELECT base * factor AS adjusted, CASE level WHEN 'S1' THEN 100 WHEN 'S2' THEN 75
            WHEN 'S3' THEN 50 ELSE 25 END::DOUBLE AS target FROM levelled)
        SELECT round(regr_slope(target, adjusted), 6) AS weight, round(regr_intercept(target, adjusted), 6) AS intercept FROM y""",
)
def one_weight(t: Tables):
    out = models.learn_one_weight(severity_features(t), "adjusted", "level")
    return out.select(rnd("weight", 6).alias("weight"), rnd("intercept", 6).alias("intercept"))


@plan("m20_learned_weights")
def learned_weights(t: Tables):
    columns = ["similarity", "adjusted", "factor"]
    fit = models.learn_weights(severity_features(t), columns, "level")
    rows = [(c, float(w)) for c, w in zip(columns, fit.coefficients)] + [("intercept", float(fit.intercept))]
    return t.spark.createDataFrame(rows, "feature string, weight double")


@plan(
    "m21_classification_report",
    f"""WITH {CENTER_SQL}, d AS (SELECT vec_id, e.label AS a, c.label AS p, row_number() OVER (
            PARTITION BY vec_id ORDER BY list_distance(embedding::DOUBLE[], c.c), c.label) AS n FROM embeddings e, centers c),
        q AS (SELECT a, p FROM d WHERE n = 1),
        s AS (SELECT k AS class, (SELECT count(*) FROM q WHERE a = k AND p = k) AS tp,
                (SELECT count(*) FROM q WHERE a = k) AS support, (SELECT count(*) FROM q WHERE p = k) AS called
              FROM (SELECT a AS k FROM q UNION SELECT p FROM q) u)
        SELECT class, round(coalesce(tp / nullif(called, 0), 0), 6) AS precision,
               round(coalesce(tp / nullif(support, 0), 0), 6) AS recall,
               round(coalesce(2.0 * tp / nullif(called + support, 0), 0), 6) AS f1, support FROM s""",
)
def classification_report(t: Tables):
    out = clustering.assign(t.embeddings, "embedding", *label_queries(t))
    report = models.classification_report(out, "label", "cluster")
    return report.select("class", *[rnd(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@plan("m22_model_round_trip")
def model_round_trip(t: Tables):
    data = labelled_readings(t)
    model = models.anomaly_model(data, SENSORS, "label", trees=5)
    loaded = models.save_and_load(model, fresh_path(t.spark, "model"))
    return loaded.transform(data).groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@plan("m22_reloaded_equals_model", "SELECT l_orderkey, l_linenumber, true AS same FROM lineitem")
def reloaded_equals_model(t: Tables):
    """A loaded model gives every row the class and probability of the saved one."""
    data = labelled_readings(t)
    model = models.anomaly_model(data, SENSORS, "label", trees=5)
    loaded = models.save_and_load(model, fresh_path(t.spark, "model"))
    first = models.class_probability(model.transform(data)).select(
        *data.columns, F.col("prediction").alias("p"), F.col("confidence").alias("c"))
    again = models.class_probability(loaded.transform(first))
    same = F.col("prediction").eqNullSafe(F.col("p")) & F.col("confidence").eqNullSafe(F.col("c"))
    return again.select("l_orderkey", "l_linenumber", same.alias("same"))


DOC_TIERS = {"critical": (1.0, ("worthless", "the the")), "high": (0.8, ("tion of",)), "low": (0.4, ("is the", "una"))}


@plan(
    "m23_two_tier_severity",
    """SELECT doc_id, CASE WHEN contains(x, 'worthless') OR contains(x, 'the the') THEN 'critical'
         WHEN contains(x, 'tion of') THEN 'high' ELSE 'low' END AS severity,
         CASE WHEN contains(x, 'worthless') OR contains(x, 'the the') OR contains(x, 'tion of') OR contains(x, 'is the')
              OR contains(x, 'una') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS confidence,
         CASE WHEN contains(x, 'worthless') THEN 'worthless' WHEN contains(x, 'the the') THEN 'the the'
              WHEN contains(x, 'tion of') THEN 'tion of' WHEN contains(x, 'is the') THEN 'is the'
              WHEN contains(x, 'una') THEN 'una' ELSE '' END AS rule_match
       FROM (SELECT doc_id, lower(text) AS x FROM documents) d""",
)
def two_tier_severity(t: Tables):
    out = severity.tiered(t.texts.select("doc_id", "text"), "text", tiers=DOC_TIERS)
    return out.select("doc_id", "severity", "confidence", F.coalesce("rule_match", F.lit("")).alias("rule_match"))


SEVERITY_THRESHOLD = 0.15
BUCKET_SQL = f"('0x' || substr(md5({{w}}), 1, 6))::INTEGER % {severity.WORD_BUCKETS}"


def similarity_sql(rows: str) -> str:
    """Similarity of each analysis text with each pattern of ``rows`` (rule, weight, place), as hashed word vectors."""
    word, text = BUCKET_SQL.format(w="unnest(string_split(rule, ' '))"), BUCKET_SQL.format(w="w")
    return f"""{TEXT_FIELDS_SQL}, patterns(rule, weight, place) AS (VALUES {rows}),
        rw AS (SELECT rule, b, count(*)::DOUBLE AS n FROM (SELECT rule, {word} AS b FROM patterns) GROUP BY ALL),
        rn AS (SELECT rule, sqrt(sum(n * n)) AS norm FROM rw GROUP BY rule),
        tw AS (SELECT analysis, b, count(*)::DOUBLE AS n FROM (SELECT analysis, {text} AS b FROM (
                 SELECT analysis, unnest(regexp_extract_all(lower(analysis), '[a-z0-9]+')) AS w
                 FROM (SELECT DISTINCT analysis FROM factored))) GROUP BY ALL),
        tn AS (SELECT analysis, sqrt(sum(n * n)) AS norm FROM tw GROUP BY analysis),
        sims AS (SELECT analysis, rule, weight, place, round(sum(tw.n * rw.n) / (any_value(tn.norm) * any_value(rn.norm)), 9) AS s
                 FROM tw JOIN rw USING (b) JOIN tn USING (analysis) JOIN rn USING (rule) JOIN patterns USING (rule)
                 GROUP BY analysis, rule, weight, place)"""


TIER_PATTERNS = [(tier, p) for tier, (_, patterns) in severity.TIERS.items() for p in patterns]
TIER_ROWS = ", ".join(f"('{p}', {severity.TIERS[tier][0]}::DOUBLE, {n})" for n, (tier, p) in enumerate(TIER_PATTERNS))
TIER_NAMES = " ".join(f"WHEN '{p}' THEN '{tier}'" for tier, p in TIER_PATTERNS)
LITERAL = " ".join(f"WHEN contains(lower(analysis), '{p}') THEN '{p}'" for _, p in TIER_PATTERNS)


@plan(
    "m23_similarity_tier",
    f"""WITH {similarity_sql(TIER_ROWS)},
        soft AS (SELECT analysis, rule AS soft_rule, s * weight AS soft_score FROM sims WHERE s > 0
                 QUALIFY row_number() OVER (PARTITION BY analysis ORDER BY s * weight DESC, place) = 1),
        found AS (SELECT event_id, CASE {LITERAL} END AS literal, soft_rule, soft_score FROM factored LEFT JOIN soft USING (analysis))
        SELECT event_id, coalesce(CASE coalesce(literal, soft_rule) {TIER_NAMES} END, 'low') AS severity,
          CASE WHEN literal IS NOT NULL THEN 1.0 ELSE round(coalesce(soft_score, 0.0), 6) END AS confidence,
          coalesce(literal, soft_rule, '') AS rule_match FROM found""",
)
def similarity_tier(t: Tables):
    records = materialize(incidents(t).select("event_id", jsonfields.analysis_text("payload").alias("analysis")), "records")
    scores = severity.text_scores([p for _, p in TIER_PATTERNS])(F.col("_text"))
    out = severity.once_per_text(
        records, "analysis", lambda d: severity.tiered(d, "_text", patterns=TIER_PATTERNS, scores=scores))
    return out.select("event_id", "severity", rnd("confidence", 6).alias("confidence"),
                      F.coalesce("rule_match", F.lit("")).alias("rule_match"))


RULE_ROWS = ", ".join(f"('{r[0]}', {r[2]}::DOUBLE, {n})" for n, r in enumerate(severity.SEVERITY_RULES))


def severity_scores(t: Tables):
    """All incident records, their analysis text scored by the severity rules."""
    records = materialize(incidents(t).select(
        "event_id", jsonfields.analysis_text("payload").alias("analysis"), jsonfields.environment("payload").alias("raw_env")), "records")
    base = {r[0]: float(r[2]) for r in severity.SEVERITY_RULES}
    matched = severity.with_text_matches(records, "analysis", list(base), SEVERITY_THRESHOLD)
    out = severity.score(matched, base, rules.environment_factor(F.col("raw_env")))
    return out.withColumn("environment", rules.environment_name(F.col("raw_env")))


@plan(
    "m24_severity_scoring",
    f"""WITH {similarity_sql(RULE_ROWS)},
        best AS (SELECT *, count(*) OVER (PARTITION BY analysis) AS hits FROM sims WHERE s >= {SEVERITY_THRESHOLD}
                 QUALIFY row_number() OVER (PARTITION BY analysis ORDER BY s DESC, rule) = 1),
        scores AS (SELECT event_id, environment, analysis, coalesce(b.s, 0.0) AS sim, coalesce(rule, '') AS rule,
            least(coalesce(hits, 0), 3) AS top, CASE WHEN b.s IS NULL THEN 10.0 ELSE weight * factor END AS rule_score,
            CASE WHEN b.s IS NULL THEN 10.0 ELSE b.s * 100 * 0.4::DOUBLE + weight * factor * 0.6::DOUBLE END AS combined
          FROM factored LEFT JOIN best b USING (analysis))
        SELECT event_id, environment, analysis, round(sim, 6) AS bert_score, round(rule_score, 6) AS rule_score,
          round(combined, 6) AS combined_score, rule AS matched_pattern, top::INTEGER AS top_matches,
          CASE WHEN rule = '' THEN 'S4' WHEN combined >= 80 THEN 'S1' WHEN combined >= 60 THEN 'S2' WHEN combined >= 40 THEN 'S3' ELSE 'S4' END
            AS severity_level FROM scores""",
)
def severity_scoring(t: Tables):
    return severity_scores(t).select(
        "event_id", "environment", "analysis", rnd("bert_score", 6).alias("bert_score"),
        rnd("rule_score", 6).alias("rule_score"), rnd("combined_score", 6).alias("combined_score"),
        F.coalesce("matched_pattern", F.lit("")).alias("matched_pattern"), F.size("top_matches").alias("top_matches"),
        "severity_level",
    )


KEYWORD_LIST = ", ".join(f"'{r[0]}'" for r in severity.SEVERITY_RULES)


@plan(
    "m24_learned_job",
    f"""WITH {similarity_sql(RULE_ROWS)},
        best AS (SELECT * FROM sims WHERE s >= {SEVERITY_THRESHOLD} QUALIFY row_number() OVER (PARTITION BY analysis ORDER BY s DESC, rule) = 1),
        new AS (SELECT event_id, environment, analysis, b.s AS s, rule, weight * factor AS adj, factor,
                  b.s * 100 * 0.4::DOUBLE + weight * factor * 0.6::DOUBLE AS combined
                FROM factored LEFT JOIN best b USING (analysis) WHERE event_id % 3 <> 0),
        feats AS (SELECT *, CASE WHEN combined >= 80 THEN 'S1' WHEN combined >= 60 THEN 'S2' WHEN combined >= 40 THEN 'S3' ELSE 'S4' END AS lvl
                  FROM new WHERE s IS NOT NULL),
        means AS (SELECT lvl, avg(s) AS ms, avg(adj) AS ma, avg(factor) AS mf FROM feats GROUP BY lvl),
        widths AS (SELECT stddev_pop(s) AS ws, stddev_pop(adj) AS wa, stddev_pop(factor) AS wf FROM feats),
        class AS (SELECT event_id, m.lvl AS level FROM feats f, means m, widths w QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY
            round(power((s - ms) / coalesce(nullif(ws, 0), 1), 2) + power((adj - ma) / coalesce(nullif(wa, 0), 1), 2)
                  + power((factor - mf) / coalesce(nullif(wf, 0), 1), 2), 9), m.lvl) = 1),
        scored AS (SELECT event_id, coalesce(level, 'S4') AS severity_id, coalesce(s, 0.0) AS bert_score, coalesce(adj, 10.0) AS rule_score,
            coalesce({WEIGHTS['bert_weight']}::DOUBLE * s + {WEIGHTS['rule_weight']}::DOUBLE * adj + {WEIGHTS['env_weight']}::DOUBLE * factor
                     + {WEIGHTS['intercept']}::DOUBLE, 10.0) AS combined_score,
            coalesce(rule, '') AS matched_pattern, array_to_string(list_filter(regexp_split_to_array(lower(analysis), '[ \\t\\n]+'),
              lambda w: s IS NOT NULL AND len(list_filter([{KEYWORD_LIST}], lambda p: contains(w, p))) > 0), ' ') AS keywords, environment
          FROM new LEFT JOIN class USING (event_id))
        SELECT event_id, severity_id, round(bert_score, 6) AS bert_score, round(rule_score, 6) AS rule_score,
          round(combined_score, 6) AS combined_score, matched_pattern, keywords, environment FROM scored
        UNION ALL SELECT event_id, 'S0', 0.0, 0.0, 0.0, 'earlier', '', 'unknown' FROM events WHERE event_id % 6 = 0""",
)
def learned_job(t: Tables):
    """New records scored in learned mode with the level of a fitted classifier, and stored beside earlier mappings.

    Every third record was processed before; earlier mappings are those of even
    ids, of which the new records' are replaced.
    """
    records = materialize(incidents(t).select(
        "event_id", jsonfields.analysis_text("payload").alias("analysis"), jsonfields.environment("payload").alias("raw_env"),
        F.when(F.col("event_id") % 3 == 0, F.lit("2024-01-01")).alias("processed_at")), "records")
    earlier = t.events.filter("event_id % 2 = 0").select(
        "event_id", F.lit("S0").alias("severity_id"), *[F.lit(0.0).alias(c) for c in ("bert_score", "rule_score", "combined_score")],
        F.lit("earlier").alias("matched_pattern"), F.array().cast("array<string>").alias("matched_keywords"), F.lit("unknown").alias("environment"))
    trained = severity.match_features(records.filter("processed_at IS NULL"), "analysis", "raw_env", threshold=SEVERITY_THRESHOLD)
    level = models.nearest_class(trained, ["similarity", "adjusted", "factor"], "level")
    after = severity.score_new(records, earlier, "event_id", "analysis", "raw_env", threshold=SEVERITY_THRESHOLD, weights=WEIGHTS, level=level)
    return after.select(
        "event_id", "severity_id", *[rnd(c, 6).alias(c) for c in ("bert_score", "rule_score", "combined_score")],
        F.coalesce("matched_pattern", F.lit("")).alias("matched_pattern"), F.array_join("matched_keywords", " ").alias("keywords"), "environment")


@plan(
    "m25_hybrid_cascade",
    f"""SELECT doc_id, CASE WHEN c = 'none' THEN CASE WHEN toxic = 1 THEN 'business' ELSE 'unknown' END ELSE d END AS domain,
          CASE WHEN c = 'none' THEN CASE WHEN toxic = 1 THEN 'support' ELSE 'unknown' END ELSE c END AS category,
          CASE WHEN c = 'none' THEN CASE WHEN toxic = 1 THEN 0.7::DOUBLE ELSE 0.0::DOUBLE END ELSE 1.0::DOUBLE END AS confidence,
          CASE WHEN c = 'none' THEN CASE WHEN toxic = 1 THEN 'ml-based' ELSE 'fallback' END ELSE 'rule-based' END AS method,
          (CASE WHEN c = 'none' THEN 0 ELSE 1 END + CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS tried
        FROM (SELECT doc_id, {rule_case('domain')} AS d, {rule_case('category')} AS c, coalesce(toxic, 0) AS toxic
              FROM documents LEFT JOIN labels USING (doc_id)) x""",
)
def hybrid_cascade(t: Tables):
    docs = t.texts.select("doc_id", "text").join(t.labels.select("doc_id", "toxic"), "doc_id", "left")
    model = F.struct(F.lit("business").alias("domain"), F.lit("support").alias("category"), F.lit(0.7).alias("confidence"))
    both = docs.select(
        "doc_id", classify.rule_classification("text").alias("by_rule"), F.when(F.col("toxic") == 1, model).alias("by_model")
    )
    out = classify.cascade(both, [("rule-based", "by_rule"), ("ml-based", "by_model")])
    return out.select("doc_id", "domain", "category", "confidence", "method", F.size("previous").alias("tried"))


#: Bound of the labelled rows that the text model is fitted on, those with the smallest hash.
TEXT_MODEL_ROWS = 5_000

CASCADE_CHECK_SQL = f"""SELECT doc_id, CASE WHEN c = 'none' THEN '' ELSE d END AS rule_domain, CASE WHEN c = 'none' THEN '' ELSE c END AS rule_category,
          c <> 'none' AS by_rule, true AS gate_holds, true AS known_class
        FROM (SELECT doc_id, {rule_case('domain')} AS d, {rule_case('category')} AS c FROM documents) x"""


def fitted_cascade(t: Tables, classifier=None):
    """Rules first, then a text model fitted on labelled documents; the model's part is shown by its gate."""
    marked = t.documents.select("doc_id", "text").join(t.labels.select("doc_id", "toxic"), "doc_id")
    named = marked.withColumn("kind", F.when(F.col("toxic") == 1, "support").otherwise("technical"))
    sample = named.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TEXT_MODEL_ROWS)
    model = classify.train_text_classifier(sample, "text", "kind", classifier, trees=20)
    judged = classify.model_classification(model.transform(t.documents.select("doc_id", "text")), 0.6)
    both = judged.select("doc_id", classify.rule_classification("text").alias("by_rule"), "ml_result", "predicted")
    out = classify.cascade(both, [("rule-based", "by_rule"), ("ml-based", "ml_result")])
    ruled = F.col("method") == "rule-based"
    sure = F.col("confidence") >= 0.6
    return out.select(
        "doc_id", F.when(ruled, F.col("domain")).otherwise("").alias("rule_domain"),
        F.when(ruled, F.col("category")).otherwise("").alias("rule_category"), ruled.alias("by_rule"),
        (sure == (F.col("method") != "fallback")).alias("gate_holds"),
        F.when(F.col("method") == "ml-based", (F.col("category") == F.col("predicted")) & F.col("predicted").isin("support", "technical"))
        .otherwise(True).alias("known_class"),
    )


@plan("m25_fitted_cascade", CASCADE_CHECK_SQL)
def cascade_with_forest(t: Tables):
    return fitted_cascade(t)


@plan("u05_own_estimator", CASCADE_CHECK_SQL)
def cascade_with_own_estimator(t: Tables):
    return fitted_cascade(t, LogisticRegression(featuresCol="features", labelCol="_label", maxIter=20, regParam=0.01))


@plan(
    "m26_cluster_terms",
    r"""WITH w AS (SELECT doc_id, lang, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS term FROM documents),
         df AS (SELECT term, count(DISTINCT doc_id) AS df FROM w GROUP BY term),
         tf AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term),
         s AS (SELECT lang, term, round(n * ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1.0))
                 / sum(n) OVER (PARTITION BY lang), 8) AS weight FROM tf JOIN df USING (term))
       SELECT lang, term, weight, rank::INTEGER AS rank FROM (
         SELECT *, row_number() OVER (PARTITION BY lang ORDER BY weight DESC, term) AS rank FROM s) r WHERE rank <= 10""",
)
def cluster_terms(t: Tables):
    return profile.cluster_terms(t.texts, "doc_id", "lang", "text", 10)


@plan(
    "m26_cluster_similarity",
    f"""WITH {CENTER_SQL} SELECT label, round(avg(list_cosine_similarity(embedding::DOUBLE[], c)), 6) AS similarity
        FROM embeddings JOIN centers USING (label) GROUP BY label""",
)
def cluster_similarity(t: Tables):
    names, centers = label_queries(t)
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("label")).cast("int")
    own = F.element_at(vectors.scores_to(centers)(F.col("embedding")), place)
    return t.embeddings.select("label", own.alias("s")).groupBy("label").agg(rnd(F.avg("s"), 6).alias("similarity"))


@plan("m27_projection")
def projection(t: Tables):
    table, fit = reduction(t, 2)
    return fit.apply(table).select("vec_id", "label", rnd("pca1", 6).alias("pca1"), rnd("pca2", 6).alias("pca2"))


@plan(
    "m28_histogram",
    """WITH b AS (SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 30 AS w, count(*) AS n FROM events)
       SELECT least(floor((value - lo) / w), 29)::INTEGER AS bin, count(*) AS n, round(count(*) / (max(b.n) * max(w)), 8) AS density
       FROM events, b GROUP BY 1""",
)
def histogram(t: Tables):
    return profile.histogram(t.events, "value", 30).select("bin", "n", rnd("density", 8).alias("density"))


@plan(
    "m28_normal_quantiles",
    """SELECT (i - 1)::INTEGER AS point, round(q, 6) AS sample FROM (
         SELECT unnest(quantile_cont(value, list_transform(range(1, 101), lambda i: (i - 0.5) / 100))) AS q,
                unnest(range(1, 101)) AS i FROM events) x""",
)
def normal_quantiles(t: Tables):
    return profile.qq_points(t.events, "value", 100).select("point", rnd("sample", 6).alias("sample"))
