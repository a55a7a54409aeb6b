"""Registry of named plans: a Spark job and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from dunlin.session import path_bytes

#: Bytes of Parquet files whose rows share a partition of :meth:`Tables.spread`.
SPREAD_BYTES = 8 << 20


@dataclass(frozen=True)
class Plan:
    name: str
    build: Callable[["Tables"], DataFrame]
    sql: str | None


PLANS: dict[str, Plan] = {}


class Tables:
    """Attribute access to the Parquet tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def spread(self, name: str, key: str | None = None) -> DataFrame:
        """A table for costly per-row work, or for work that holds a partition in memory.

        There is a partition for every :data:`SPREAD_BYTES` of its files and for every core
        at least. If the files make fewer, the rows are dealt out; otherwise they are left
        where they are. With a ``key`` the rows are always dealt out by it, so
        aggregates by the key or by more need no other shuffle.
        """
        table = getattr(self, name)
        wanted = max(self.spark.sparkContext.defaultParallelism, -(-path_bytes(self.spark, self.path(name)) // SPREAD_BYTES))
        if key is not None:
            return table.repartition(wanted, key)
        return table.repartition(wanted) if table.rdd.getNumPartitions() < wanted else table

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._read:  # one listing and footer read per table
            self._read[name] = self.spark.read.parquet(self.path(name))
        return self._read[name]


def plan(name: str, sql: str | None = None):
    """Register the decorated builder under ``name`` with its oracle text."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in PLANS:
            raise ValueError(f"plan {name} is registered twice")
        PLANS[name] = Plan(name, build, sql)
        return build

    return register
