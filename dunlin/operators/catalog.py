"""Views, cached tables, managed tables, statistics and schema inspection."""

from __future__ import annotations

import json
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.storagelevel import StorageLevel


def query_view(df: DataFrame, view: str, text: str) -> DataFrame:
    """Register ``df`` under a name and run SQL text over it."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(text)


def list_views(spark: SparkSession) -> set[str]:
    """Names of the temporary views and tables in the current database."""
    return {t.name for t in spark.catalog.listTables()}


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep ``df`` for several uses and release it afterwards."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


@contextmanager
def scratch_database(spark: SparkSession, name: str, location: str):
    """A database whose managed tables live in ``location``; dropped on leaving."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def create_table(spark: SparkSession, table: str, schema: StructType, fmt: str = "parquet") -> None:
    """Create a managed table if it does not exist."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {fmt}")


def table_statistics(spark: SparkSession, table: str, columns: list[str]) -> DataFrame:
    """Collect table and column statistics and return them as rows.

    One row per column: row count of the table, distinct estimate, nulls,
    smallest and largest value as text.
    """
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
    text = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Statistics'").first()["data_type"]
    total = int(text.split(",")[1].split()[0])
    rows = []
    for column in columns:
        info = {r["info_name"]: r["info_value"]
                for r in spark.sql(f"DESCRIBE EXTENDED {table} {column}").collect()}
        rows.append((column, total, int(info["num_nulls"]), info["min"], info["max"]))
    return spark.createDataFrame(rows, "column string, rows long, nulls long, min string, max string")


def schema_rows(df: DataFrame) -> DataFrame:
    """The schema as rows: position, name, type and nullability."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "pos int, name string, type string, nullable boolean")


def dimensions(df: DataFrame) -> DataFrame:
    """Row and column count."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"))


def schema_to_json(schema: StructType) -> str:
    """Schema as JSON text."""
    return schema.json()


def schema_from_json(text: str) -> StructType:
    """Schema from its JSON text."""
    return StructType.fromJson(json.loads(text))
