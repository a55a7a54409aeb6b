"""Running totals and ranks over a whole table without a task that sees all of it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dunlin.session import broadcast_if_bounded, materialize


def running_totals(df: DataFrame, order: Sequence[str], weight: str, name: str = "upto") -> DataFrame:
    """Add ``name``: the sum of ``weight`` over this row and all rows before it in ``order``.

    Rows are dealt by ranges of ``order`` and written with the number of their range. Each range is
    summed on its own and shifted by the total of the ranges before it, one row per range, so no
    window holds more than a range. Rows equal in ``order`` share a range and are taken in any
    order; sum them first where one value may fill much of the table.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(df.repartitionByRange(parts, *order).withColumn("#range", F.spark_partition_id()), "ranges")
    totals = dealt.groupBy("#range").agg(F.sum(weight).alias("#sum"))
    # One row per range: as many as there are partitions, however large the table is.
    before = F.coalesce(F.sum("#sum").over(Window.orderBy("#range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = F.broadcast(totals.select("#range", before.alias("#before")))
    inside = F.sum(weight).over(Window.partitionBy("#range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return dealt.withColumn("#inside", inside).join(shifts, "#range").select(
        *df.columns, (F.col("#before") + F.col("#inside")).alias(name))


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """``label``, ``code`` and ``n`` of every distinct value: codes from 0 by falling frequency, ties by the value; nulls have none."""
    counts = df.select(F.col(column).alias("label")).where("label IS NOT NULL").groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    ordered = running_totals(counts.select("label", "n", (-F.col("n")).alias("rarity"), F.lit(1).alias("one")), ["rarity", "label"], "one")
    return ordered.select("label", (F.col("upto") - 1).cast("double").alias("code"), "n")


def code_labels(df: DataFrame, columns: Sequence[str], suffix: str = "Cat") -> DataFrame:
    """Add the code of each column's value (:func:`label_codes`); null values have none.

    Unlike a fitted indexer no task or driver holds all labels: the table of codes is shipped
    only if its measured bytes are few, and joined by shuffle otherwise.
    """
    out = df
    for column in columns:
        codes = materialize(label_codes(df, column).select(F.col("label").alias("#label"), F.col("code").alias(column + suffix)), "codes")
        out = out.join(broadcast_if_bounded(codes), F.col(column) == F.col("#label"), "left").drop("#label")
    return out
