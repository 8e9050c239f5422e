"""Named loaders behind one entry point, open to extension.

A loader is ``(spark, source, **options) -> DataFrame``. A plugin is an object
with ``can_handle(kind, source)`` and ``ingest(spark, source, **options)``;
plugins are asked before the built-in loaders.
"""

from __future__ import annotations

import functools
import importlib
import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any, Protocol

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ospara.operators.filters import select_features
from ospara.sources import readers

log = logging.getLogger(__name__)
Loader = Callable[..., DataFrame]


class Plugin(Protocol):
    def can_handle(self, kind: str, source: Any) -> bool: ...

    def ingest(self, spark: SparkSession, source: Any, **options: Any) -> DataFrame: ...


@dataclass
class DataSource:
    """What to load: kind, location and reader options."""

    name: str
    kind: str
    location: Any
    options: dict[str, Any] = field(default_factory=dict)


_LOADERS: dict[str, Loader] = {
    "parquet": readers.parquet,
    "csv": readers.csv,
    "json": readers.json,
    "sql": readers.sql,
    "jdbc": readers.jdbc,
    "text": readers.text_files,
    "directory": readers.directory,
    "schema": readers.schema,
    "table": readers.table,
}
_PLUGINS: list[Plugin] = []


def register_loader(name: str, loader: Loader) -> None:
    _LOADERS[name] = loader


def register_plugin(plugin: Plugin) -> None:
    _PLUGINS.append(plugin)


def unregister_plugin(plugin: Plugin) -> None:
    _PLUGINS.remove(plugin)


def load_plugin(path: str) -> Plugin:
    """Import and register a plugin class named "module.Class"."""
    module, _, name = path.rpartition(".")
    plugin = getattr(importlib.import_module(module), name)()
    register_plugin(plugin)
    return plugin


def ingest(
    spark: SparkSession, kind: str, source: Any, columns: Sequence[str] | None = None, **options: Any
) -> DataFrame:
    for plugin in _PLUGINS:
        if plugin.can_handle(kind, source):
            df = plugin.ingest(spark, source, **options)
            break
    else:
        if kind not in _LOADERS:
            raise ValueError(f"unknown source type: {kind}")
        df = _LOADERS[kind](spark, source, **options)
    return select_features(df, columns) if columns else df


#: Loader of each content type of files.
FILE_LOADERS = {"text": "text", "html": "text", "csv": "csv", "json": "json", "parquet": "parquet"}


def ingest_directory(spark: SparkSession, source: str, **options: Any) -> DataFrame:
    """(path, content_type, content, error): all files below a folder, each type read once by its loader.

    A text or HTML file is one row; files of records give their rows as JSON,
    and share one schema per type. What could not be read is a row, too, with
    the reason in ``error``: files of an unknown type, files that should have given a row
    and did not, and malformed JSON records. Files without a byte hold nothing and give none, as do
    tables that were read and have no rows. Plugins and registered loaders are asked for
    their type as in ``ingest``.
    """
    listed = readers.directory(spark, source, known_only=False).select(
        F.col("_metadata.file_path").alias("path"), "content_type", F.col("path").alias("place"))
    none = F.lit(None).cast("string")
    parts, loaded = [], set()
    for kind in sorted(r[0] for r in listed.select("content_type").distinct().collect() if r[0]):
        reading = {"recursiveFileLookup": True, "pathGlobFilter": readers.name_pattern(kind), "ignoreCorruptFiles": True, **options}
        if kind == "parquet":
            reading["mergeSchema"] = True  # else one broken file may stand for all
        try:
            rows = ingest(spark, FILE_LOADERS[kind], source, **reading)
        except PySparkException as e:
            log.warning("no %s file below %s could be read: %s", kind, source, e)
            continue
        if rows.columns == ["content", "chunk_id"]:
            parts.append(rows.select(F.col("chunk_id").alias("path"), F.lit(kind).alias("content_type"), "content", none.alias("error")))
            continue
        loaded.add(kind)
        broken = F.col("_corrupt_record") if "_corrupt_record" in rows.columns else none
        content = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != "_corrupt_record"]))
        parts.append(rows.select(
            F.col("_metadata.file_path").alias("path"), F.lit(kind).alias("content_type"), F.coalesce(broken, content).alias("content"),
            F.when(broken.isNotNull(), F.lit("malformed record")).alias("error")))
    shape = "path string, content_type string, content string, error string"
    read = functools.reduce(DataFrame.unionByName, parts, spark.createDataFrame([], shape))
    # The driver's file index holds the paths of all files; those without a row are fewer.
    silent = listed.join(read.select("path").distinct(), "path", "left_anti").collect()
    empty = readers.without_rows(spark, [r.place for r in silent if r.content_type in loaded])
    left = [(r.path, r.content_type, None, "unreadable" if r.content_type else "unknown type")
            for r in silent if r.place not in empty]
    return read.unionByName(spark.createDataFrame(left, shape))


def ingest_many(spark: SparkSession, sources: Sequence[DataSource]) -> DataFrame:
    """All sources stacked in order; one that cannot be opened is skipped."""
    parts = []
    for s in sources:
        try:
            parts.append(ingest(spark, s.kind, s.location, **s.options))
        except (PySparkException, ValueError, OSError) as e:
            log.warning("source %s skipped: %s", s.name, e)
    if not parts:
        raise ValueError("no source could be read")
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
