"""Readers: tables, files, JSON payloads, directories and generated data."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from typing import Any

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, IDF, Normalizer, RegexTokenizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ospara.session import materialize
from ospara.sources import generator

# Content type by file extension.
CONTENT_TYPES = {
    "txt": "text", "md": "text", "csv": "csv", "json": "json", "html": "html", "htm": "html", "parquet": "parquet",
}

#: Longest Parquet file that may be a footer without rows.
FOOTER_BYTES = 1 << 20


def parquet(spark: SparkSession, source: str, **options: Any) -> DataFrame:
    return spark.read.options(**options).parquet(source)


def table(spark: SparkSession, source: str, **_: Any) -> DataFrame:
    return spark.table(source)


def csv(spark: SparkSession, source: str, schema=None, header: bool = True, **options: Any) -> DataFrame:
    """Header row; types inferred unless a schema is given (saves one pass).

    Files are split over tasks. ``multiLine=True`` reads values with line breaks,
    at the price of one task per file.
    """
    reader = spark.read.options(header=header, **{"escape": '"', **options})
    return reader.schema(schema).csv(source) if schema else reader.option("inferSchema", True).csv(source)


def json(spark: SparkSession, source: Any, column: str | None = None, schema=None, **options: Any) -> DataFrame:
    """JSON lines of a path, or the payload column of a DataFrame."""
    if isinstance(source, DataFrame):
        return json_payload(source, column, schema)
    reader = spark.read.options(**options)
    return (reader.schema(schema) if schema else reader).json(source)


def json_payload(df: DataFrame, column: str, schema: str | None = None) -> DataFrame:
    """Fields of a payload column beside the other columns.

    Without a schema one aggregate finds the union of all keys with the types
    of their values: texts stay texts, whole numbers are BIGINT, others DOUBLE,
    booleans BOOLEAN, mixed values VARIANT. Rows that are no JSON give NULLs.
    """
    others = [c for c in df.columns if c != column]
    if not schema:
        found = df.agg(F.schema_of_variant_agg(F.try_parse_json(column))).first()[0] or "VOID"
        if not found.startswith("OBJECT<") or found == "OBJECT<>":
            return df.select(*others)
        typed = re.sub(r"DECIMAL\(\d+,\d+\)|FLOAT", "DOUBLE", found.replace("OBJECT<", "STRUCT<"))
        schema = typed.replace(": VOID", ": STRING")
    return df.select(*others, F.from_json(column, schema).alias("_p")).select(*others, "_p.*")


def sql(spark: SparkSession, source: str | None = None, **_: Any) -> DataFrame:
    return spark.sql(source or "SELECT * FROM data")


def jdbc(spark: SparkSession, source: str, query: str | None = None, table: str = "data", **options: Any) -> DataFrame:
    """A database query; give partition options to read it in parallel."""
    reader = spark.read.format("jdbc").option("url", source).options(**options)
    return (reader.option("query", query) if query else reader.option("dbtable", table)).load()


def row_chunks(df: DataFrame, key: Column, source: str, source_type: str) -> DataFrame:
    """Each row as one text chunk: its JSON and metadata about its origin."""
    metadata = F.create_map(
        F.lit("source"), F.lit(source), F.lit("type"), F.lit(source_type), F.lit("columns"), F.lit(",".join(df.columns))
    )
    return df.select(
        F.to_json(F.struct(*df.columns)).alias("content"), metadata.alias("metadata"),
        F.lit(source_type).alias("source_type"), key.cast("string").alias("chunk_id"),
    )


def text_files(spark: SparkSession, source: str, **options: Any) -> DataFrame:
    """One document per text file."""
    return spark.read.options(**options).text(source, wholetext=True).select(F.col("value").alias("content"), F.col("_metadata.file_path").alias("chunk_id"))


def csv_documents(spark: SparkSession, source: str, **options: Any) -> DataFrame:
    """One document per CSV row."""
    return csv(spark, source, **options).select(F.to_json(F.struct("*")).alias("content"))


def directory(spark: SparkSession, source: str, known_only: bool = True, **options: Any) -> DataFrame:
    """Files below a folder with their content type; unknown types are left out or have none.

    Only paths and sizes are listed here; contents are read by a later select
    of ``content``.
    """
    files = spark.read.format("binaryFile").options(recursiveFileLookup=True, **options).load(source)
    extension = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    kinds = F.create_map(*[F.lit(x) for kv in CONTENT_TYPES.items() for x in kv])
    found = files.withColumn("content_type", F.try_element_at(kinds, extension))
    return found.filter("content_type IS NOT NULL") if known_only else found


def without_rows(spark: SparkSession, paths: Sequence[str]) -> set[str]:
    """Those of the files that gave no row which can be read and hold none.

    A Parquet file says so in its footer; longer files than ``FOOTER_BYTES`` hold more than a footer.
    """
    if not paths:
        return set()

    @F.arrow_udf("boolean")
    def no_rows(content: pa.Array) -> pa.Array:
        found = []
        for file in content:
            try:
                found.append(file.is_valid and pq.read_metadata(pa.BufferReader(file.as_buffer())).num_rows == 0)
            except (pa.ArrowException, OSError):
                found.append(False)
        return pa.array(found, pa.bool_())

    escaped = [re.sub(r"([\\{}\[\]*?])", r"\\\1", p) for p in paths]
    files = spark.read.format("binaryFile").option("ignoreCorruptFiles", True).load(escaped).filter(F.col("length") <= FOOTER_BYTES)
    marked = F.when(F.substring("content", -4, 4) == F.lit(b"PAR1"), F.col("content"))
    table = F.lower("path").endswith(".parquet")
    return {r[0] for r in files.select("path", (~table | no_rows(marked)).alias("empty")).filter("empty").select("path").collect()}


def name_pattern(kind: str) -> str:
    """Glob of the file names of a content type, in either case."""
    either = ["".join(f"[{c}{c.upper()}]" for c in e) for e, k in CONTENT_TYPES.items() if k == kind]
    return "*.{" + ",".join(either) + "}"


def schema(spark: SparkSession, source: Mapping, **options: Any) -> DataFrame:
    return generator.generate(spark, source, **options)


def text_embeddings(df: DataFrame, text: str, dims: int = 64, prefix: str = "emb",
                    encoder: Callable[[Column], Column] | None = None) -> DataFrame:
    """Unit vectors of texts as columns emb_0 .. emb_n.

    Hashed and weighted words by default; ``encoder`` may be any column
    function, such as a pandas UDF around a model, that gives an array.
    """
    if encoder is not None:
        array = df.withColumn("_e", encoder(F.col(text)))
    else:
        from pyspark.ml.functions import vector_to_array

        words = RegexTokenizer(inputCol=text, outputCol="_t", pattern=r"\W+").transform(df)
        # Written, as the weights take one pass over the counts and the vectors another.
        counted = materialize(HashingTF(inputCol="_t", outputCol="_f", numFeatures=dims).transform(words).drop("_t"), "word-counts")
        stages = Pipeline(stages=[IDF(inputCol="_f", outputCol="_i"), Normalizer(inputCol="_i", outputCol="_n", p=2.0)])
        array = stages.fit(counted).transform(counted).withColumn("_e", vector_to_array("_n")).drop("_f", "_i", "_n")
    return array.select(*df.columns, *[F.col("_e")[i].alias(f"{prefix}_{i}") for i in range(dims)])
