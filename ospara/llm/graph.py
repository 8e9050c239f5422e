"""Connected components of links between named nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ospara.session import fresh_path


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """A step in the shared folder, read back, and its path."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark, path: str) -> None:
    """Delete a step that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(node, root) of every node that has a link; the root is the smallest node in reach.

    Alternating star contractions over columns ``u`` and ``v``. Each round
    replaces the edges by stars around local minima, is written to the shared
    folder and then replaces the round before. Partial minima precede each
    shuffle. Without links the result is empty.
    """
    spark = edges.sparkSession
    pair = [F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")]
    current, path = written(edges.filter("u <> v").select(*pair).distinct(), "links")
    before = None
    for _ in range(max_rounds):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.inline(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))))
        following, next_path = written(small.filter("u <> v").distinct(), "links")
        state = following.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first()
        discard(spark, path)
        current, path = following, next_path
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    stars = current.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.unionByName(roots)
