"""Readers: declared or inferred text tables, JSON, XML, JDBC and wide records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

#: Generated rows of one task.
ROWS_PER_TASK = 250_000


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    null_token: str | None = None,
    infer: bool = False,
    **options: str,
) -> DataFrame:
    """Delimited text with a declared schema, an inferred one, or all strings."""
    reader = spark.read.option("sep", sep).option("header", header)
    if null_token is not None:
        reader = reader.option("nullValue", null_token)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.options(**options).csv(path)


def read_lines(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Raw lines; they are dealt out only if the files make fewer ``partitions``."""
    lines = spark.read.text(path)
    few = partitions and lines.rdd.getNumPartitions() < partitions
    return lines.repartition(partitions) if few else lines


def typed_fields(
    lines: DataFrame,
    fields: Mapping[str, str],
    pattern: str = ",",
    header: str | None = None,
    column: str = "value",
) -> DataFrame:
    """Split lines once and cast the parts; bad or absent parts become null.

    ``header`` is the header line's text, which is dropped wherever it occurs.
    """
    rows = lines.where(F.col(column) != header) if header is not None else lines
    parts = rows.select(F.split(column, pattern, -1).alias("parts"))
    return parts.select(*[
        F.trim(F.get("parts", F.lit(i))).try_cast(kind).alias(name)
        for i, (name, kind) in enumerate(fields.items())])


def read_whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: ``path`` and ``content``."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def read_with_origin(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """Lines of many files from one scan, each with the path it came from."""
    return (spark.read.option("recursiveFileLookup", recursive).text(path)
            .select(F.col("_metadata.file_path").alias("path"), "value"))


def read_json(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    mode: str = "PERMISSIVE",
    corrupt_column: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """JSON lines or documents under one of the three bad-record modes.

    ``corrupt_column`` is added to a declared schema when it is missing there.
    """
    reader = spark.read.option("mode", mode).option("multiLine", multi_line)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    if schema is not None:
        declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if corrupt_column and corrupt_column not in declared.names:
            declared = StructType(declared.fields + [StructField(corrupt_column, DataType.fromDDL("string"))])
        reader = reader.schema(declared)
    return reader.json(path)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: StructType | str | None = None) -> DataFrame:
    """XML records delimited by ``row_tag``."""
    reader = spark.read.format("xml").option("rowTag", row_tag).option("mode", "PERMISSIVE")
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """A database table, read by parallel range queries when bounds are given.

    Credentials belong in ``options`` supplied by the caller.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column:
        low, high = bounds
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", str(low))
                  .option("upperBound", str(high)).option("numPartitions", str(partitions)))
    return reader.load()


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """A table from literal rows."""
    return spark.createDataFrame(list(rows), schema)


def generated_rows(spark: SparkSession, n: int, seed: int, partitions: int | None = None) -> DataFrame:
    """``id`` 0..n-1 with a uniform and a normal column, made on the executors.

    By default a task makes at most :data:`ROWS_PER_TASK` rows, so what a task holds does not grow with ``n``.
    """
    ids = spark.range(0, n, 1, partitions or max(spark.sparkContext.defaultParallelism, -(-n // ROWS_PER_TASK)))
    return ids.select("id", F.rand(seed).alias("uniform"), F.randn(seed + 1).alias("normal"))


def read_wide(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Lines of one label and many numbers as ``(label, features array)``.

    Keeping the numbers in one array avoids hundreds of column expressions.
    """
    numbers = F.transform(F.split("value", sep), lambda x: F.trim(x).try_cast("double"))
    return spark.read.text(path).select(numbers.alias("n")).select(
        F.get("n", F.lit(0)).alias("label"), F.slice("n", 2, F.greatest(F.size("n") - 1, F.lit(0))).alias("features"))


def name_features(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    """Spread the features array over named double columns."""
    return wide.select("label", *[F.get("features", F.lit(i)).alias(n) for i, n in enumerate(names)])


def standardize_array(df: DataFrame, column: str, mean: float | Column, std: float | Column) -> DataFrame:
    """``(x - mean) / std`` for every element of an array column."""
    mean, std = (F.lit(v) if isinstance(v, (int, float)) else v for v in (mean, std))
    # A subquery may not stand inside the lambda, so both values become columns first.
    ready = df.withColumns({"__mean": mean, "__std": std})
    scaled = F.transform(column, lambda x: (x.cast("double") - F.col("__mean")) / F.col("__std"))
    return ready.withColumn(column, scaled).drop("__mean", "__std")


def array_moments(df: DataFrame, column: str) -> DataFrame:
    """Mean and population deviation over all elements of all arrays, one row."""
    values = F.transform(column, lambda x: x.cast("double"))
    per_row = df.select(
        F.size(column).alias("n"),
        F.aggregate(values, F.lit(0.0), lambda a, x: a + x).alias("s"),
        F.aggregate(values, F.lit(0.0), lambda a, x: a + x * x).alias("q"))
    n, s, q = F.sum("n"), F.sum("s"), F.sum("q")
    return per_row.agg((s / n).alias("mean"), F.sqrt(q / n - (s / n) * (s / n)).alias("std"))
