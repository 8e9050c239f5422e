"""Features, clusters, models and statistics against brute force."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from ospara.functions import stats, vectors
from ospara.session import fresh_path
from ospara.operators import (
    clustering, density, features, hyper, imputing, joins, models, nearby, profile, search, timeseries,
)


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    centers = np.array([[0, 0, 1], [10, 0, 1], [0, 10, 1], [1, 1, 12]])
    rows = [(i, (centers[i % 4] + rng.normal(size=3)).tolist(), i % 4) for i in range(160)] + [(160, [9.0, 9.0, 9.0], 9)]
    return spark.createDataFrame(rows, "id long, v array<float>, label int").cache()


def as_arrays(points):
    rows = points.orderBy("id").collect()
    return np.array([r.v for r in rows], dtype=float), np.array([r.label for r in rows])


def brute_silhouette(x, y, squared):
    out = []
    for i in range(len(x)):
        d = ((x - x[i]) ** 2).sum(axis=1)
        d = d if squared else np.sqrt(d)
        own = (y == y[i]) & (np.arange(len(x)) != i)
        if not own.any():
            out.append(0.0)
            continue
        a, b = d[own].mean(), min(d[y == c].mean() for c in set(y) if c != y[i])
        out.append((b - a) / max(a, b))
    return out


def test_silhouettes(points):
    x, y = as_arrays(points)
    fast = [r.silhouette for r in clustering.with_silhouette(points, "label", "v").orderBy("id").collect()]
    assert fast == pytest.approx(brute_silhouette(x, y, True), abs=1e-9)


def test_davies_bouldin(points):
    x, y = as_arrays(points)
    names = sorted(set(y))
    c = np.array([x[y == n].mean(axis=0) for n in names])
    s = [np.linalg.norm(x[y == n] - c[i], axis=1).mean() for i, n in enumerate(names)]
    worst = [max((s[i] + s[j]) / np.linalg.norm(c[i] - c[j]) for j in range(len(names)) if j != i) for i in range(len(names))]
    assert clustering.davies_bouldin(points, "label", "v") == pytest.approx(np.mean(worst))


def test_equal_centers_do_not_divide_by_zero(spark):
    df = spark.createDataFrame([(0, [0.0]), (0, [2.0]), (1, [1.0]), (1, [1.0])], "label int, v array<double>")
    assert math.isfinite(clustering.davies_bouldin(df, "label", "v"))


def test_choose_k_finds_groups_and_stops_at_rows(points, spark):
    best, table = clustering.choose_k(points.filter("label < 4"), "v", range(2, 7))
    assert best == 4 and table.count() == 5
    few = spark.createDataFrame([([float(i)],) for i in range(4)], "v array<double>")
    assert clustering.choose_k(few, "v", range(2, 12))[1].count() == 2


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_nearest_equals_brute_force(points, metric):
    x, _ = as_arrays(points)
    queries = x[:3] + 0.1
    hits = vectors.nearest(points.repartition(7), "id", "v", [10, 20, 30], queries, 6, metric)
    got = {q: [r.id for r in hits.filter(F.col("query_id") == q).orderBy("rank").collect()] for q in (10, 20, 30)}
    for q, v in zip((10, 20, 30), queries):
        if metric == "cosine":
            score = -(x @ v) / np.linalg.norm(x, axis=1) / np.linalg.norm(v)
        else:
            score = np.linalg.norm(x - v, axis=1)
        assert got[q] == np.lexsort((np.arange(len(x)), score))[:6].tolist()


def test_nearest_with_ties_and_odd_rows(spark):
    rows = [(i, [1.0, 0.0]) for i in range(20)] + [(50, None), (51, [1.0]), (52, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, v array<float>").repartition(5)
    hits = vectors.nearest(df, "id", "v", [1], np.array([[1.0, 0.0]]), 4).orderBy("rank").collect()
    assert [r.id for r in hits] == [0, 1, 2, 3]
    few = vectors.nearest(df, "id", "v", [1], np.array([[1.0, 0.0]]), 40, "euclidean")
    assert few.count() == 21


def test_cell_index_finds_most_and_reads_few_cells(points, spark):
    x, _ = as_arrays(points)
    index = search.CellIndex.build(points, "id", "v", fresh_path(spark, "cells"), cells=8)
    found = index.search(list(range(5)), x[:5], 5, probes=3)
    truth = vectors.nearest(points, "id", "v", list(range(5)), x[:5], 5)
    assert search.recall_at_k(found, truth, "id", 5).first()[0] > 0.8
    whole = index.search(list(range(5)), x[:5], 5, probes=8)
    assert search.recall_at_k(whole, truth, "id", 5).first()[0] == 1.0


def test_index_copies_codes_and_bad_rows(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(900, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2001, [1.0]), (2002, [0.0] * 24), (2003, x[3].tolist())]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    index = search.CellIndex.build(df, "id", "v", fresh_path(spark, "cells"), cells=12, copies=3)
    ids, q = list(range(40)), x[:40] * 3
    truth = vectors.nearest(df, "id", "v", ids, q, 6).select("query_id", "id", "rank").collect()
    whole = index.search(ids, q, 6, probes=12).select("query_id", "id", "rank").collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, truth))
    part = [search.recall_of(index, df, ids, q, 6, n).first()[0] for n in (1, 4)]
    assert part[0] < part[1] and part[1] > 0.7


def test_searches_with_many_queries(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(12000, 8))
    x[7000:7040] = x[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>").repartition(3)
    asked = np.arange(0, len(x), 4)
    index = search.CellIndex.build(df, "id", "v", fresh_path(spark, "many"), cells=8, copies=2)
    start = time.monotonic()
    found = index.search(asked.tolist(), x[asked], 5, probes=8).collect()
    took = time.monotonic() - start
    exact = vectors.nearest(df, "id", "v", asked.tolist(), x[asked], 5).collect()
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    truth = np.sort(unit[asked] @ unit.T, axis=1)[:, :-6:-1]
    for rows in (found, exact):
        scores = np.zeros(truth.shape)
        for r in rows:
            scores[r.query_id // 4, r["rank"] - 1] = r.score
        assert len(rows) == truth.size and np.allclose(scores, truth, atol=1e-9)
        assert len({(r.query_id, r.id) for r in rows}) == len(rows)
    assert took < 12


def test_rule_matches(points):
    names, m = vectors.small_matrix(vectors.group_means(points, "label", "v"), "label", "center")
    hits = joins.rule_matches(points, "id", "v", names, m, 0.9)
    x, _ = as_arrays(points)
    sims = (x @ m.T) / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(m, axis=1)
    assert hits.count() == int((sims >= 0.9).sum())


def brute_dbscan(x, eps, least):
    near = np.linalg.norm(x[:, None] - x[None], axis=2) <= eps
    core = near.sum(axis=1) >= least
    label = np.full(len(x), -1)
    order = sorted(np.flatnonzero(core), key=lambda i: tuple(x[i]))
    n = 0
    for i in order:
        if label[i] >= 0:
            continue
        todo = [i]
        while todo:
            p = todo.pop()
            if label[p] < 0:
                label[p] = n
                todo += [q for q in np.flatnonzero(near[p] & core) if label[q] < 0]
        n += 1
    for i in np.flatnonzero(~core):
        reach = label[near[i] & core]
        if len(reach):
            label[i] = reach.min()
    return core, label


def test_dbscan_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    x = np.round(np.vstack([rng.normal([0, 0], 0.25, (60, 2)), rng.normal([2, 1], 0.2, (50, 2)),
                            rng.uniform(-3, 4, (40, 2)), np.repeat([[3.5, -2.0]], 6, axis=0)]), 3)
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(x)], "id int, x double, y double")
    core, label = brute_dbscan(x, 0.3, 5)
    rows = density.dbscan(df, ["x", "y"], 0.3, 5).orderBy("id").collect()
    assert [r.core for r in rows] == core.tolist()
    assert [r.cluster for r in rows] == label.tolist()


def test_dbscan_in_three_coordinates(spark):
    rng = np.random.default_rng(4)
    x = np.round(np.vstack([rng.normal(0, 0.3, (70, 3)), rng.normal(1.5, 0.3, (70, 3)), rng.uniform(-2, 3, (30, 3))]), 3)
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(x)], "id int, x double, y double, z double")
    core, label = brute_dbscan(x, 0.45, 6)
    rows = density.dbscan(df, ["x", "y", "z"], 0.45, 6).orderBy("id").collect()
    assert [r.core for r in rows] == core.tolist() and [r.cluster for r in rows] == label.tolist()


def check_dbscan(spark, x, eps, least):
    df = spark.createDataFrame([(i, p.tolist(), 1) for i, p in enumerate(x)], "id int, p array<double>, core int").repartition(4)
    core, label = brute_dbscan(x, eps, least)
    rows = density.dbscan(df.drop("core"), "p", eps, least).orderBy("id").collect()
    assert [r.core for r in rows] == core.tolist()
    assert [r.cluster for r in rows] == label.tolist()
    return core, label


@pytest.mark.parametrize("dims, eps", [(1, 0.02), (5, 1.1), (16, 4.2), (40, 7.9)])
def test_dbscan_in_many_coordinates(spark, monkeypatch, dims, eps):
    monkeypatch.setattr(density, "FOLD_ROWS", 40)
    monkeypatch.setattr(nearby, "OWNERS", 32)
    monkeypatch.setattr(nearby, "SLICE", 48)
    rng = np.random.default_rng(dims)
    x = np.vstack([rng.normal(0, 1, (150, dims)), rng.normal(4, 0.7, (120, dims)), rng.uniform(-4, 8, (60, dims))])
    x = np.vstack([x, np.repeat(x[:3], 6, axis=0)])
    core, label = check_dbscan(spark, x, eps, 6)
    assert 0 < core.sum() < len(x) and label.max() >= 1


def test_dbscan_joins_dense_groups_only_by_their_members(spark, monkeypatch):
    """Balls whose leaders are farther apart than eps, linked or not by single members."""
    monkeypatch.setattr(density, "FOLD_ROWS", 60)
    rng = np.random.default_rng(2)
    balls = []
    for k, gap in enumerate((0.0, 1.85, 3.9, 5.6)):
        angle = rng.uniform(0, 2 * np.pi, 300)
        radius = 0.45 * np.sqrt(rng.uniform(0, 1, 300))
        balls.append(np.column_stack([gap + radius * np.cos(angle), radius * np.sin(angle)]))
    x = np.round(np.vstack([*balls, [[0.95, 0.0], [0.9, 0.3]]]), 6)
    check_dbscan(spark, x, 1.0, 5)


@pytest.mark.parametrize("block, hubs, eps", [(200, 60, 1.28), (120, 1, 1.13)])
def test_dbscan_without_structure_copies_few_points(spark, monkeypatch, block, hubs, eps):
    """Unit vectors reach every cell: only points that their block leaves open meet all the others."""
    monkeypatch.setattr(density, "BLOCK_ROWS", block)
    monkeypatch.setattr(density, "HUBS", hubs)
    monkeypatch.setattr(nearby, "OWNERS", 64)
    met, meetings = [], nearby.meetings

    def counted(*args):
        rows = meetings(*args)
        met.append(rows.count())
        return rows

    monkeypatch.setattr(nearby, "meetings", counted)
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (700, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x = np.vstack([x, x[:4] * 9, x[0] + 30 + rng.normal(0, 0.05, (40, 64))])
    core, label = check_dbscan(spark, x, eps, 5)
    assert (~core).any() and label.max() >= 1
    if hubs > 1:
        assert sum(met) < 4 * len(x)


def test_dbscan_of_missing_coordinates_and_of_nothing(spark):
    rows = [(1, 0.0, 0.0), (2, 0.1, 0.0), (3, None, 0.0), (4, float("nan"), 1.0), (5, float("inf"), 0.0), (6, -0.0, 0.0), (7, 9.0, 9.0)]
    df = spark.createDataFrame(rows, "id int, x double, y double")
    found = {r.id: (r.core, r.cluster) for r in density.dbscan(df, ["x", "y"], 0.5, 3).collect()}
    assert found == {1: (True, 0), 2: (True, 0), 3: (False, -1), 4: (False, -1), 5: (False, -1), 6: (True, 0), 7: (False, -1)}
    assert density.dbscan(df.limit(0), ["x", "y"], 0.5, 3).count() == 0
    with pytest.raises(ValueError):
        density.dbscan(spark.createDataFrame([([1.0],), ([1.0, 2.0],)], "p array<double>"), "p")


def test_components_of_a_long_chain(spark):
    n = 64
    nodes = spark.createDataFrame([(f"{i:03d}",) for i in range(n + 2)], "node string")
    edges = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}") for i in range(n - 1)], "u string, v string")
    got = {r.node: r.component for r in density.connected_components(nodes, edges).collect()}
    assert all(got[f"{i:03d}"] == "000" for i in range(n)) and got["064"] == "064" and got["065"] == "065"


def test_scaling_edge_cases(spark):
    df = spark.createDataFrame([(1.0, 5.0), (1.0, 5.0), (1.0, 5.0), (1.0, 9.0), (1.0, 5.0)], "a double, b double")
    for method in ("standard", "robust", "minmax", "none"):
        out = features.scale(df, ["a", "b"], method).collect()
        assert all(math.isfinite(v) for r in out for v in r)
    assert [r.b for r in features.scale(df, ["b"], "robust").collect()] == [0.0, 0.0, 0.0, 4.0, 0.0]
    with pytest.raises(ValueError):
        features.scale(df, ["a"], "unknown")


def test_imputers(spark):
    df = spark.createDataFrame(
        [(1.0, 1.0, None), (2.0, None, None), (None, 3.0, None), (2.0, 4.0, None)], "a double, b double, c double"
    )
    assert features.impute(df, ["a", "b", "c"], "most_frequent").collect()[2].a == 2.0
    median = features.impute(df, ["a", "b", "c"], "median").collect()
    assert median[1].b == 3.0 and median[2].a == 2.0 and median[0].c is None
    filled = features.knn_impute(df.drop("c"), ["a", "b"], k=2).collect()
    assert filled[1].b == pytest.approx((4.0 + 1.0) / 2) and filled[2].a == pytest.approx(1.5)


def test_iterative_imputer_recovers_a_plane(spark):
    rows = []
    for i in range(80):
        a, c = float(i % 9), float((i * 7) % 13)
        rows.append((i, a, None if i % 5 == 0 else 2 * a + c, None if i % 5 == 1 else c))
    out = features.iterative_impute(spark.createDataFrame(rows, "i int, a double, b double, c double"), ["a", "b", "c"])
    for r in out.collect():
        c = (r.i * 7) % 13
        assert r.c == pytest.approx(c, abs=0.05) and r.b == pytest.approx(2 * r.a + c, abs=0.05)


def test_components_match_numpy(points):
    table = features.vector_columns(points, "v", 3)
    fit = features.reduce(table, ["f0", "f1", "f2"], n=3)
    x, _ = as_arrays(points)
    values, vecs = np.linalg.eigh(np.cov((x - x.mean(axis=0)).T))
    assert fit.shares == pytest.approx(sorted(values / values.sum(), reverse=True))
    scores = np.array([[r.pca1, r.pca2] for r in fit.apply(table).orderBy("id").collect()])
    assert np.abs(scores[:, 0]) == pytest.approx(np.abs((x - x.mean(axis=0)) @ vecs[:, -1]))
    assert (fit.loadings[np.abs(fit.loadings).argmax(axis=0), range(3)] > 0).all()
    assert features.reduce(table, ["f0", "f1", "f2"], threshold=0.5).components >= 1
    assert scores == pytest.approx((x - x.mean(axis=0)) @ fit.loadings[:, :2])
    for r in fit.check(table.repartition(3)).collect():
        assert r.eigenvalue == pytest.approx(sorted(values)[-r.component]) and r.share == pytest.approx(fit.shares[r.component - 1])
        assert r.residual < 1e-9 and r.length == pytest.approx(1.0) and r.overlap < 1e-9


def test_cumulative_cut(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.3), (3, 0.1)], "component int, share double")
    assert {r.needed for r in timeseries.explained_cut(df, 0.7).collect()} == {2}
    assert {r.needed for r in timeseries.explained_cut(df, 0.95).collect()} == {3}


@pytest.mark.parametrize("n,expected", [(0, []), (3, [2.0] * 10), (6, [3.5] * 10), (7, [1, 2, 3, 4, 5, 6, 7, 1, 2, 3]),
                                        (20, [14, 15, 16, 17, 18, 19, 20, 14, 15, 16])])
def test_forecast_lengths(spark, n, expected):
    df = spark.createDataFrame([(1, i, float(i)) for i in range(1, n + 1)], "k int, t int, v double")
    got = [r.forecast for r in timeseries.seasonal_forecast(df, "k", ["t"], "v", 10).orderBy("step").collect()]
    assert got == pytest.approx(expected)


def test_merge_fields(spark):
    df = spark.createDataFrame([(1, 1, "a", None), (1, 2, None, 5), (1, 3, "c", None), (2, 1, None, None)], "k int, t int, x string, y int")
    got = {r.k: (r.x, r.y) for r in timeseries.merge_fields(df, "k", ["t"], ["x", "y"]).collect()}
    assert got == {1: ("c", 5), 2: (None, None)}


def test_report_counts_missing_classes(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("c", "a"), ("b", "b")], "y string, p string")
    got = {r["class"]: (r.precision, r.recall, r.f1, r.support) for r in models.classification_report(df, "y", "p").collect()}
    assert got["a"] == (0.5, 0.5, 0.5, 2) and got["c"] == (0.0, 0.0, 0.0, 1)
    assert got["b"] == pytest.approx((0.5, 1.0, 2 / 3, 1))


def test_severity_models(spark):
    rows = [(s / 50, 2.0 * s, 1.0 + (s % 3) * 0.1, "S1" if s > 37 else "S2" if s > 25 else "S3" if s > 12 else "S4") for s in range(50)] * 4
    df = spark.createDataFrame(rows, "a double, b double, c double, level string")
    model, test = models.severity_model(df, ["a", "b", "c"], "level")
    good = test.filter("label = prediction").count() / test.count()
    assert good > 0.7 and set(models.mean_importance(model, ["a", "b", "c"])) == {"a", "b", "c"}
    fit = models.learn_weights(df.drop("b"), ["a", "c"], "level")
    assert fit.coefficients[0] > 0


def test_inverse_normal(spark):
    df = spark.createDataFrame([(0.001,), (0.025,), (0.5,), (0.975,), (0.999,)], "p double")
    got = [r[0] for r in df.select(stats.inverse_normal(F.col("p"))).collect()]
    assert got == pytest.approx([-3.090232, -1.959964, 0.0, 1.959964, 3.090232], abs=1e-5)


def test_normality(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(rng.normal(size=400), rng.exponential(size=400))], "n double, e double")
    got = {r.feature: r.normality for r in profile.shape_report(df, ["n", "e"]).collect()}
    assert got == {"n": "likely normal", "e": "non-normal"}


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (None,)], "x double")
    got = profile.histogram(df, "x", 4).collect()
    assert sum(r.n for r in got) == 2


def test_sweep_and_feature_table(points):
    table = features.vector_columns(points, "v", 3).withColumn("kind", F.when(F.col("id") % 2 == 0, "even").otherwise("odd"))
    trials = [{"k": 2, "imputer": "median", "scaler": "robust"}, {"k": 5, "imputer": "mean", "scaler": "standard"}]
    history = hyper.sweep(table, ["f0", "f1", "f2"], trials).collect()
    assert len(history) == 2 and history[0].combined >= history[1].combined
    out = hyper.feature_table(table.select("id", "f0", "f1", "f2", "kind"), ["f0", "f1", "f2"], ["kind"], 4)
    assert {"kind_even", "kind_odd", "cluster", "distance_to_center", "pca1", "pca2"} <= set(out.columns)
    assert out.count() == 161


def test_sweep_scans_equal_rows_once(spark, monkeypatch):
    rows = [(f"{i}-{j}", float(i % 4), float(i % 3) if j % 5 else None) for i in range(24) for j in range(50)]
    df = spark.createDataFrame(rows, "r string, a double, b double").repartition(5)
    sizes, sums = [], clustering._sums
    monkeypatch.setattr(clustering, "_sums", lambda d, *more: sizes.append(d.count()) or sums(d, *more))
    trial = {"k": 3, "imputer": "median", "scaler": "standard"}
    data, centers, scores = hyper.trial_centers(df, ["a", "b"], trial, 1.0, "r")
    assert sizes and max(sizes) <= 16
    plain = clustering.fit_all(data, "_v", [3], "r")
    assert np.allclose(plain[3], centers, atol=1e-9)
    assert clustering.score_all(data, "_v", plain)[3] == pytest.approx((scores["silhouette"], scores["db"]), abs=1e-9)


def test_suggestions():
    assert hyper.suggest("5 features, missing 12.5%") == {"k": 10, "imputer": "knn", "scaler": "robust"}
    assert hyper.suggest("nothing known")["k"] == 6 and hyper.suggest("1 features missing")["imputer"] == "median"


def test_knn_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(features, "DONORS_PER_BLOCK", 16)
    monkeypatch.setattr(imputing, "VISITS_PER_TASK", 7)
    monkeypatch.setattr(imputing, "PATTERNS", 3)
    rng = np.random.default_rng(9)
    values = rng.integers(0, 6, (120, 3)).astype(float)
    values[rng.random((120, 3)) < 0.15] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in x]) for i, x in enumerate(values)]
    out = features.knn_impute(spark.createDataFrame(rows, "i int, a double, b double, c double"), ["a", "b", "c"], k=4)
    means = np.nanmean(values, axis=0)
    for r in out.collect():
        for j, got in enumerate((r.a, r.b, r.c)):
            x = values[r.i]
            if not np.isnan(x[j]):
                assert got == x[j]
                continue
            shared = (~np.isnan(values - x)).sum(axis=1)
            donors = [n for n in range(120) if shared[n] and not np.isnan(values[n, j])]
            gap = {n: round(float(np.sqrt(np.nansum((values[n] - x) ** 2) * 3 / shared[n])), 9) for n in donors}
            near = sorted(donors, key=lambda n: (gap[n], values[n, j]))[:4]
            assert got == pytest.approx(np.mean([values[n, j] for n in near]) if near else means[j])


def test_knn_meets_few_blocks(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 3)) + 6 * rng.integers(0, 5, (4000, 1))
    rows = [(*map(float, p[:2]), None if i % 8 == 0 else float(p[2]), 1) for i, p in enumerate(x)]
    table = spark.createDataFrame(rows, "a double, b double, c double, _n long")
    search = imputing.NearestRows(table, ["a", "b", "c"], 5, 64)
    got = {tuple(r.v[:2]): r.answer for r in search.answers().join(search.rows, "id").collect()}
    known = np.array([r[:3] for r in rows if r[2] is not None], dtype=float)
    for a, b, c, _ in rows:
        if c is None:
            near = np.round(np.sqrt(((known[:, :2] - (a, b)) ** 2).sum(axis=1) * 3 / 2), 9)
            assert got[a, b] == pytest.approx(known[np.lexsort((known[:, 2], near))[:5], 2].mean())
    assert search.met < search.possible / 10


def test_knn_without_gaps_and_without_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 3.0)], "a double, b double")
    assert sorted(map(tuple, features.knn_impute(df, ["a", "b"]).collect())) == [(1.0, 2.0), (2.0, 3.0)]
    assert features.knn_impute(df.limit(0), ["a", "b"]).count() == 0
    gaps = spark.createDataFrame([(None, None), (None, 4.0), (5.0, None)], "a double, b double")
    assert sorted(map(tuple, features.knn_impute(gaps, ["a", "b"]).collect()), key=str) == [(5.0, 4.0)] * 3


def test_models_as_expressions(spark):
    from pyspark.ml.functions import vector_to_array

    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 3)).round(3)
    rows = [(*map(float, p), "S1" if p[0] > 0.5 else "S2" if p[1] > 0 else "S3", float(p[0] + p[2] > 0)) for p in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, level string, label double")
    model, _ = models.severity_model(df.drop("label"), ["a", "b", "c"], "level")
    names = model.stages[0].labels
    both = model.transform(df.drop("label")).select("prediction", models.logistic_expression(model, ["a", "b", "c"]).alias("own")).collect()
    assert all(names[int(r.prediction)] == r.own for r in both)
    vectors_of = df.withColumn("v", F.array("a", "b", "c"))
    forest = models.vector_classifier(vectors_of, "v", "label", trees=7)
    scored = forest.transform(models.as_features(vectors_of, "v")).withColumn("p", vector_to_array("probability")[1]).drop("features")
    for r in scored.withColumn("features", F.col("v")).withColumn("own", models.forest_expression(forest.stages[-1])).collect():
        assert r.own == pytest.approx(r.p, abs=1e-9)
    assert df.withColumn("own", models.nearest_class(df, ["a", "b", "c"], "level")).filter("own = level").count() > 250


def test_rows_with_gaps_are_scored(spark):
    from ospara.operators import models

    rows = [(float(i), None if i % 7 == 0 else float(i % 3), float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    assert models.anomaly_model(df, ["a", "b"], "label", trees=3).transform(df).count() == 60


def test_vectors_without_numbers_get_no_cluster(spark):
    df = spark.createDataFrame([(1, [0.0, 0.0]), (2, None), (3, [1.0]), (4, [5.0, 5.0])], "i int, v array<double>")
    out = {r.i: (r.cluster, r.distance_to_center) for r in clustering.assign(df, "v", [10, 20], np.array([[0.0, 0.0], [5.0, 5.0]])).collect()}
    assert out == {1: (10, 0.0), 2: (None, None), 3: (None, None), 4: (20, 0.0)}


def test_severity_model_fits_equal_rows_once(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 3, (400, 2)).astype(float)
    level = np.where(x.sum(axis=1) + rng.normal(0, 0.8, 400) > 2, "S1", "S3")
    df = spark.createDataFrame([(i, *map(float, p), str(v)) for i, (p, v) in enumerate(zip(x, level))], "id int, a double, b double, level string")
    model, test = models.severity_model(df, ["a", "b"], "level")
    fit = model.stages[-1]
    assert fit.summary.predictions.count() <= 18 and "id" in test.columns
    train, _ = df.randomSplit([0.8, 0.2], models.SEED)
    plain = models.LogisticRegression(family="multinomial", regParam=1.0 / train.count(), standardization=False, maxIter=100)
    rows = models.PipelineModel(stages=model.stages[:3]).transform(train)
    assert np.allclose(plain.fit(rows).coefficientMatrix.toArray(), fit.coefficientMatrix.toArray(), atol=1e-4)


def test_forest_tasks_hold_few_rows(spark, monkeypatch):
    seen, fit = [], models.Pipeline.fit
    monkeypatch.setattr(models.Pipeline, "fit", lambda self, df: seen.append(df) or fit(self, df))
    monkeypatch.setattr(models, "FOREST_ROWS", 50, raising=False)
    df = spark.range(400, numPartitions=2).select("id", F.col("id").cast("double").alias("a"), (F.col("id") % 2).cast("double").alias("y"))
    model = models.anomaly_model(df, ["a"], "y", trees=2)
    sizes = [len(p) for p in seen[0].rdd.glom().collect()]
    assert sum(sizes) == 400 and max(sizes) < 100 and model.transform(df).count() == 400


def test_preprocess_shares_the_scans_of_columns_without_gaps(spark, monkeypatch):
    rng = np.random.default_rng(6)
    data = [(i, float(a), None if i % 3 == 0 else float(b), int(c)) for i, (a, b, c) in enumerate(rng.normal(0, 5, (60, 3)))]
    df = spark.createDataFrame(data, "id int, a double, b double, c int")
    names = ["a", "b", "c"]
    expected = features.scale(features.impute(df, names), names).orderBy("id").collect()
    asked, quantiles = [], features.profile.quantiles
    monkeypatch.setattr(features.profile, "quantiles", lambda d, c, p: asked.append(list(c)) or quantiles(d, c, p))
    assert features.preprocess(df, names).orderBy("id").collect() == expected
    assert asked == [names, ["b"]]
