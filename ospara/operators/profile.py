"""Statistics reports over numeric columns."""

from __future__ import annotations

import itertools
import struct
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ospara.functions import stats
from ospara.scale import MAX_BLOCK_ROWS, running_sums, top_k, unfold
from ospara.session import materialize

#: Bits of a value that one scan counts; four scans see all of a double.
DIGIT_BITS = 16


def long_form(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Columns folded to (feature, value) rows."""
    doubles = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot(list(keep), list(columns), "feature", "value")


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    group: Sequence[str] = (),
    max_rows: int = MAX_BLOCK_ROWS,
) -> DataFrame:
    """Exact linear quantiles: (group.., feature, quantiles array).

    Whole columns are counted digit by digit of their ordered bits, four scans
    for all columns and probabilities; groups sum value counts along the order
    in blocks. Neither holds all values of a column in one task.
    """
    if not group:
        return _column_quantiles(df, columns, probabilities)
    return _group_quantiles(df, columns, probabilities, group, max_rows)


def _ordered_bits(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles; equal values, also the zeros, are equal."""
    bits = np.where(np.isnan(x), np.nan, x + 0.0).view(np.int64)
    return np.where(bits < 0, ~bits, bits | np.int64(-(2**63))).view(np.uint64)


def _value(bits: int) -> float:
    raw = bits ^ (1 << 63) if bits >> 63 else bits ^ ((1 << 64) - 1)
    return struct.unpack("<d", struct.pack("<Q", raw))[0]


def _column_quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Quantiles of whole columns.

    Each scan counts the next 16 bits of the values that begin like the values
    sought: a count per digit leaves a task, and the digit at each rank comes
    to the driver. Both neighbours of a rank are sought.
    """
    data = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    places = [(i, p, up) for i in range(len(columns)) for p in probabilities for up in (0, 1)]
    spark = df.sparkSession
    #: (column, bits so far) to its number, and for each place that number and the rank below it.
    begun: dict[tuple[int, int], int] = {(i, 0): i for i in range(len(columns))}
    at: dict[int, tuple[int, int]] = {n: (i, 0) for n, (i, _, _) in enumerate(places)}
    sizes = np.zeros(len(columns))
    ranks: dict[int, int] = {}
    for scan in range(64 // DIGIT_BITS):
        counts = _digit_counts(data, begun, scan)
        whole = counts.withColumn("cum", F.sum("n").over(Window.partitionBy("head").orderBy("digit")))
        if scan == 0:
            rows = [(n, i, float(p), up) for n, (i, p, up) in enumerate(places)]
            asked = spark.createDataFrame(rows, "place int, head int, p double, up int")
            exact = F.col("p") * (F.col("total") - 1)
            whole = whole.withColumn("total", F.sum("n").over(Window.partitionBy("head")))
            rank = F.when(F.col("up") == 1, F.ceil(exact)).otherwise(F.floor(exact))
            wanted = whole.join(F.broadcast(asked), "head").withColumn("rank", rank)
        elif not ranks:
            break
        else:
            asked = spark.createDataFrame([(n, begun[at[n]], r) for n, r in ranks.items()], "place int, head int, rank long")
            wanted = whole.join(F.broadcast(asked), "head").withColumn("total", F.lit(0).cast("long"))
        for r in wanted.filter("cum > rank AND cum - n <= rank").select("place", "digit", "total", "rank", "cum", "n").collect():
            column, head = at[r["place"]]
            if scan == 0:
                sizes[column] = r["total"]
            at[r["place"]] = (column, head << DIGIT_BITS | r["digit"])
            ranks[r["place"]] = r["rank"] - (r["cum"] - r["n"])
        begun = {key: n for n, key in enumerate(dict.fromkeys(at[n] for n in ranks))}
    found = []
    for i, c in enumerate(columns):
        own = [n for n, place in enumerate(places) if place[0] == i]
        if not sizes[i]:
            found.append((c, None))
            continue
        values = []
        for low, high in zip(own[::2], own[1::2]):
            a, b = _value(at[low][1]), _value(at[high][1])
            share = places[low][1] * (sizes[i] - 1) % 1
            values.append(float(a if a == b or not share else a + (b - a) * share))
        found.append((c, values))
    return spark.createDataFrame(found, "feature string, quantiles array<double>")


def _digit_counts(data: DataFrame, begun: dict[tuple[int, int], int], scan: int) -> DataFrame:
    """(head, digit, n): how many values begin with each head, by their next digit."""
    shift = 64 - DIGIT_BITS * (scan + 1)
    sought: dict[int, list[tuple[int, int]]] = {}
    for (column, head), n in sorted(begun.items()):
        sought.setdefault(column, []).append((head, n))

    def count(batches):
        found: dict[int, int] = {}
        for batch in batches:
            for column, heads in sought.items():
                values = batch.column(column).drop_null().to_numpy(zero_copy_only=False)
                bits = _ordered_bits(values) >> np.uint64(shift)
                upper = bits >> np.uint64(DIGIT_BITS) if scan else np.zeros(len(bits), np.uint64)
                own = np.array([h for h, _ in heads], np.uint64)
                at = np.minimum(np.searchsorted(own, upper), len(own) - 1)
                hit = own[at] == upper
                numbers = np.array([n for _, n in heads], np.int64)[at[hit]]
                keys = numbers << DIGIT_BITS | (bits[hit] & np.uint64((1 << DIGIT_BITS) - 1)).astype(np.int64)
                for key, times in zip(*(x.tolist() for x in np.unique(keys, return_counts=True))):
                    found[key] = found.get(key, 0) + times
        keys = np.fromiter(found, np.int64, len(found))
        yield pa.RecordBatch.from_arrays(
            [pa.array((keys >> DIGIT_BITS).astype(np.int32)), pa.array((keys & ((1 << DIGIT_BITS) - 1)).astype(np.int32)),
             pa.array(np.fromiter(found.values(), np.int64, len(found)))], names=["head", "digit", "n"])

    parts = data.mapInArrow(count, "head int, digit int, n long")
    return parts.groupBy("head", "digit").agg(F.sum("n").alias("n"))


def _group_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], group: Sequence[str], max_rows: int
) -> DataFrame:
    key = [*group, "feature"]
    counts = materialize(
        long_form(df, columns, group).filter("value is not null")
        .groupBy(*key, "value").agg(F.count(F.lit(1)).alias("_n")),
        "value-counts",
    )
    ranked = running_sums(counts, key, ["value"], {"_cum": F.col("_n")}, max_rows)
    totals = counts.groupBy(*key).agg(F.sum("_n").alias("_total"))
    match = [f"t.{k} <=> r.{k}" for k in key]
    joined = ranked.alias("r").join(totals.alias("t"), F.expr(" and ".join(match)))
    joined = joined.select(*[F.col(f"r.{k}").alias(k) for k in key], "value", "_cum", "_total")

    def at_rank(rank: Column) -> Column:
        return F.min(F.when(F.col("_cum") > rank, F.col("value")))

    points = []
    for p in probabilities:
        target = F.lit(p) * (F.col("_total") - 1)
        points += [at_rank(F.floor(target)), at_rank(F.ceil(target))]
    picked = joined.groupBy(*key, "_total").agg(*[c.alias(f"_p{i}") for i, c in enumerate(points)])
    values = []
    for i, p in enumerate(probabilities):
        target = F.lit(p) * (F.col("_total") - 1)
        low, high = F.col(f"_p{2 * i}"), F.col(f"_p{2 * i + 1}")
        values.append(low + (high - low) * (target - F.floor(target)))
    return picked.select(*key, F.array(*values).alias("quantiles"))


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column; ties go to the smaller value."""
    counts = long_form(df, columns).filter("value is not null").groupBy("feature", "value").count()
    return counts.groupBy("feature").agg(F.min_by("value", F.struct(-F.col("count"), "value")).alias("mode"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, quartiles and max per column, all exact."""
    parts = []
    for c in columns:
        v = F.col(c).cast("double")
        parts.append(
            F.struct(
                F.lit(c).alias("feature"), F.count(v).alias("n"), F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
            ).alias(c)
        )
    basic = df.agg(*parts).select(F.inline(F.array(*columns)))
    q = quantiles(df, columns, [0.25, 0.5, 0.75]).select(
        "feature", F.col("quantiles")[0].alias("q25"), F.col("quantiles")[1].alias("q50"),
        F.col("quantiles")[2].alias("q75"),
    )
    return basic.join(q, "feature")


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """n, corrected skewness and kurtosis, K-squared and p per column."""
    parts = []
    for c in columns:
        v = F.col(c).cast("double")
        parts.append(
            F.struct(
                F.lit(c).alias("feature"), F.count(v).cast("double").alias("n"), F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"), F.skewness(v).alias("g1"), F.kurtosis(v).alias("g2"),
            ).alias(c)
        )
    n, g1, g2 = F.col("n"), F.col("g1"), F.col("g2")
    return (
        df.agg(*parts)
        .select(F.inline(F.array(*columns)))
        .withColumn("skew", stats.sample_skewness(g1, n))
        .withColumn("kurt", stats.sample_kurtosis(g2, n))
        .withColumn("k2", stats.k_squared(g1, g2, n))
        .withColumn("p_value", stats.chi2_two_p(F.col("k2")))
    )


def shape_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    m = moments(df, columns)
    return m.select(
        "feature", "skew", "kurt", "k2", "p_value",
        F.when(F.col("skew") > 0, "right-skewed").otherwise("left-skewed").alias("skew_label"),
        F.when(F.col("kurt") > 0, "heavy-tailed").otherwise("light-tailed").alias("tail_label"),
        F.when(F.col("p_value") > 0.05, "likely normal").otherwise("non-normal").alias("normality"),
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, from one aggregate."""
    pairs = list(itertools.combinations(columns, 2))
    wide = df.agg(
        *[
            F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.corr(a, b).alias("corr")).alias(f"_c{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return wide.select(F.inline(F.array(*[f"_c{i}" for i in range(len(pairs))])))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    half = correlations(df, columns)
    both = F.array(
        F.struct(F.col("left"), F.col("right"), F.col("corr")),
        F.struct(F.col("right").alias("left"), F.col("left").alias("right"), F.col("corr")),
    )
    diagonal = [F.struct(F.lit(c).alias("left"), F.lit(c).alias("right"), F.lit(1.0).alias("corr")) for c in columns]
    ones = df.limit(1).select(F.inline(F.array(*diagonal)))
    return half.select(F.inline(both)).unionByName(ones)


def correlation_strength(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    c = F.abs("corr")
    return correlations(df, columns).filter(c > 0.1).select(
        "left", "right", "corr",
        F.when(c > 0.7, "strong").when(c > 0.3, "moderate").otherwise("weak").alias("strength"),
        F.when(F.col("corr") > 0, "positive").otherwise("negative").alias("direction"),
    )


def preprocessing_advice(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    parts = []
    for c in columns:
        v = F.col(c).cast("double")
        n = F.count(v).cast("double")
        parts.append(
            F.struct(
                F.lit(c).alias("feature"),
                stats.sample_skewness(F.skewness(v), n).alias("skew"),
                F.stddev_samp(v).alias("std"),
                (F.count_if(v.isNull()) * 100.0 / F.count(F.lit(1))).alias("missing_pct"),
            ).alias(c)
        )
    rows = df.agg(*parts).select(F.array(*columns).alias("_all"))
    spread = F.array_max(F.transform("_all", lambda s: s["std"])) / F.array_min(F.transform("_all", lambda s: s["std"]))
    pct = F.col("missing_pct")
    return (
        rows.withColumn("rescale", spread > 10)
        .select("rescale", F.inline("_all"))
        .select(
            "feature", "skew", "missing_pct", "rescale",
            F.when(F.abs("skew") > 1, "log transform").otherwise("none").alias("skew_advice"),
            F.when(pct == 0, "none").when(pct < 5, "median").when(pct < 15, "knn or iterative")
            .otherwise("engineer or drop").alias("missing_advice"),
        )
    )


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width density; the last bin includes the maximum."""
    low, high = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin int, left double, n long, density double")
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    slot = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)).cast("int")
    counted = df.filter(F.col(column).isNotNull()).groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counted.select(
        "bin", (F.lit(low) + F.col("bin") * width).alias("left"), "n", (F.col("n") / (total * width)).alias("density")
    )


def qq_points(df: DataFrame, column: str, points: int = 100) -> DataFrame:
    """Sample quantiles beside normal quantiles at ``points`` plotting positions."""
    steps = [(i - 0.5) / points for i in range(1, points + 1)]
    sample = quantiles(df, [column], steps)
    return sample.select(F.posexplode("quantiles").alias("i", "sample")).select(
        F.col("i").alias("point"), "sample",
        stats.inverse_normal((F.col("i") + 0.5) / points).alias("theoretical"),
    )


def top_means(df: DataFrame, columns: Sequence[str], n: int = 3) -> DataFrame:
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).unpivot([], list(columns), "feature", "mean")
    return means.orderBy(F.abs("mean").desc(), "feature").limit(n)


def cluster_terms(df: DataFrame, key: str, cluster: str, text: str, n: int = 10) -> DataFrame:
    """Terms of a cluster by share of its words times ln((docs + 1) / (df + 1)).

    Words are counted per (cluster, document, term) first, so common terms and
    large clusters reach the shuffle as partial counts.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))
    per_doc = (
        unfold(df, words, "term", [key, cluster])
        .groupBy(cluster, key, "term").agg(F.count(F.lit(1)).alias("_n"))
    )
    counts = materialize(
        per_doc.groupBy(cluster, "term").agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_d")), "term-counts"
    )
    total = df.count()
    spread = counts.groupBy("term").agg(F.sum("_d").alias("_df"))
    sizes = counts.groupBy(cluster).agg(F.sum("_n").alias("_size"))
    idf = F.log((F.lit(total) + 1.0) / (F.col("_df") + 1.0))
    weighted = counts.join(spread, "term").join(sizes, cluster).select(
        cluster, "term", (F.round(F.col("_n") * idf / F.col("_size"), 8)).alias("weight")
    )
    return top_k(weighted, [cluster], [F.desc("weight"), F.asc("term")], n)
