"""Registry of queries bound to the driver's tables, each with its check SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ospara.scale import spread

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """Lazy access to the parquet tables of one scale folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    @property
    def texts(self) -> DataFrame:
        """Documents for work that is heavy per row, on all cores."""
        return spread(self.documents, "doc_id")

    @property
    def lines(self) -> DataFrame:
        """Line items for iterative fits, on all cores."""
        return spread(self.lineitem, "l_orderkey", "l_partkey")

    def views(self, *names: str) -> SparkSession:
        for name in names or TABLES:
            getattr(self, name).createOrReplaceTempView(name)
        return self.spark


@dataclass(frozen=True)
class Plan:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


REGISTRY: dict[str, Plan] = {}


def plan(name: str, sql: str | None = None):
    def add(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} exists")
        REGISTRY[name] = Plan(name, build, sql.strip() if sql else None)
        return build

    return add


def rnd(value, digits: int):
    """Round and turn a negative zero into zero, so that hashes agree."""
    return F.round(value, digits) + F.lit(0.0)


def micros(column) -> "F.Column":
    """Microseconds since the epoch of a time-zone-free timestamp."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {column})")
