"""Hot keys: cut results must equal the plain ones."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ospara import scale
from ospara.operators import profile, timeseries


@pytest.fixture(scope="module")
def skewed(spark):
    """One user holds most rows, with many equal times."""
    rng = random.Random(5)
    rows = [(1 if i % 3 else rng.randint(2, 40), rng.randint(0, 60), i, float(rng.randint(0, 500))) for i in range(3000)]
    return spark.createDataFrame(rows, "user long, t long, id long, value double").cache()


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_positions_match_row_number(skewed):
    w = Window.partitionBy("user").orderBy("t", "id")
    plain = skewed.withColumn("pos", F.row_number().over(w).cast("long"))
    for limit in (50, 400, 10**6):
        assert rows(scale.positions(skewed, ["user"], ["t", "id"], limit)) == rows(plain)


def test_blocks_are_bounded_and_ordered(skewed):
    blocks, cut = scale.ordered_blocks(skewed, ["user"], ["t", "id"], 100)
    assert cut
    sizes = blocks.groupBy("user", "_blk").count()
    assert sizes.agg(F.max("count")).first()[0] < 600
    spans = blocks.filter("user = 1").groupBy("_blk").agg(
        F.min(F.struct("t", "id")).alias("a"), F.max(F.struct("t", "id")).alias("b")
    ).orderBy("_blk").collect()
    assert len(spans) > 5
    assert all(tuple(x.b) < tuple(y.a) for x, y in zip(spans, spans[1:]))


def test_null_key_is_a_key(spark):
    df = spark.createDataFrame([(None, i) for i in range(50)] + [(1, 7)], "k int, i long")
    placed = scale.positions(df, ["k"], ["i"], 10)
    assert placed.filter("k is null and pos = i + 1").count() == 50


def test_rows_of_equal_order_are_parted(spark):
    df = spark.range(2000).selectExpr("1 AS k", "7 AS t", "id", "1 AS one")
    blocks, cut = scale.ordered_blocks(df, ["k"], ["t"], 100)
    assert cut and blocks.groupBy("_blk").count().agg(F.max("count")).first()[0] < 600
    assert sorted(r.pos for r in scale.positions(df, ["k"], ["t"], 100).collect()) == list(range(1, 2001))
    assert sorted(r.s for r in scale.running_sums(df, ["k"], ["t"], {"s": F.col("one")}, 100).collect()) == list(range(1, 2001))


def test_running_sums_over_blocks(skewed):
    w = Window.partitionBy("user").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.withColumn("s", F.sum("value").over(w))
    cut = scale.running_sums(skewed, ["user"], ["t", "id"], {"s": F.col("value")}, 70)
    assert rows(cut) == rows(plain)


def test_sequence_windows_over_blocks(skewed):
    args = (skewed, ["user"], ["t", "id"], "value", 9)
    assert rows(timeseries.sequence_windows(*args, max_rows=40)) == rows(timeseries.sequence_windows(*args))


def test_running_counts_over_days(spark):
    df = spark.range(500).select(
        F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, cast(id % 100 as int))").alias("ts"), F.col("id").alias("event_id")
    )
    labels = {"seen": F.lit(True), "even": F.col("event_id") % 2 == 0}
    out = timeseries.running_counts(df, "ts", ["ts", "event_id"], labels, max_rows=30).orderBy("ts", "event_id").collect()
    assert [r["seen"] for r in out] == list(range(1, 501))
    even = 0
    for r in out:
        even += r["event_id"] % 2 == 0
        assert r["even"] == even


def test_quantiles_of_groups_and_columns(skewed):
    probs = [0.0, 0.1, 0.25, 0.5, 0.99, 1.0]
    whole = {r["feature"]: r["quantiles"] for r in profile.quantiles(skewed, ["value", "t"], probs).collect()}
    want = skewed.agg(*[F.percentile(c, F.array(*map(F.lit, probs))).alias(c) for c in ("value", "t")]).first()
    assert whole == {"value": pytest.approx(want["value"]), "t": pytest.approx(want["t"])}
    by_user = profile.quantiles(skewed, ["value"], [0.5], ["user"], max_rows=60)
    check = {r[0]: r[1] for r in skewed.groupBy("user").agg(F.percentile("value", F.lit(0.5))).collect()}
    assert {r["user"]: r["quantiles"][0] for r in by_user.collect()} == pytest.approx(check)


def test_top_k_keeps_all_of_the_best(skewed):
    order = [F.desc("value"), F.asc("id")]
    w = Window.partitionBy("user").orderBy(*order)
    plain = skewed.withColumn("rank", F.row_number().over(w)).filter("rank <= 5")
    assert rows(scale.top_k(skewed, ["user"], order, 5)) == rows(plain)


def test_small_sides_are_checked(spark):
    assert len(scale.collect_small(spark.range(10), 10)) == 10
    with pytest.raises(scale.TooLarge):
        scale.collect_small(spark.range(11), 10)


def test_column_quantiles_by_digits(spark):
    rng = random.Random(2)
    values = [rng.choice([rng.gauss(0, 1), rng.randint(0, 3), 2.0, -0.0, 1e300 * rng.random(), -1e-300 * rng.random()]) for _ in range(5000)]
    df = spark.createDataFrame([(float(v), None, 7) for v in values] + [(None, None, None)] * 10, "a double, b double, c int").repartition(5)
    probs = [0.0, 0.013, 0.25, 0.5, 0.501, 0.75, 0.999, 1.0]
    got = {r["feature"]: r["quantiles"] for r in profile.quantiles(df, ["a", "b", "c"], probs).collect()}
    want = df.agg(F.percentile("a", F.array(*[F.lit(p) for p in probs]))).first()[0]
    assert got["a"] == pytest.approx(want, rel=1e-12, abs=1e-320) and not any(got["b"] or []) and got["c"] == [7.0] * 8
    odd = spark.createDataFrame([(1.0,), (float("inf"),), (float("-inf"),)], "a double")
    assert profile.quantiles(odd, ["a"], [0.0, 0.5, 1.0]).first()["quantiles"] == [float("-inf"), 1.0, float("inf")]


def test_unfold_drops_nothing_but_nulls(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, []), (3, None)], "id int, xs array<int>")
    assert rows(scale.unfold(df, F.col("xs"), "x", ["id"])) == [(1, 1), (1, 2)]
