"""Writers and physical layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
    compression: str | None = None,
    max_records_per_file: int | None = None,
    rebalance: bool = False,
    **options: str,
) -> None:
    """Write in any built-in format, optionally partitioned by columns.

    ``max_records_per_file`` bounds file size without a shuffle, so one large
    partition value does not end in one huge file.  ``rebalance`` brings rows of
    one value together first, so that not every task opens a file per value;
    adaptive execution cuts large values into several tasks.
    """
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if compression:
        writer = writer.option("compression", compression)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    """Append to (or replace) a database table, one connection per partition."""
    df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table).options(**options).save()


def insert_into(df: DataFrame, table: str, overwrite: bool = True) -> None:
    """Insert by column position into an existing table."""
    df.write.insertInto(table, overwrite=overwrite)
