"""Series aligned on a business-day calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dunlin.functions.dates import from_parts
from dunlin.sources.readers import read_with_origin, typed_fields


def business_days(start: str, end: str) -> Column:
    """Array of the Mondays to Fridays from ``start`` to ``end``, both included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return F.filter(days, lambda d: F.weekday(d) < 5)


def business_day_index(spark: SparkSession, start: str, end: str) -> DataFrame:
    """The calendar as rows ``(pos, day)``."""
    return spark.range(1).select(F.posexplode(business_days(start, end)).alias("pos", "day"))


def align(df: DataFrame, key: str, ts: str, value: str, start: str, end: str) -> DataFrame:
    """One row per key and business day, with the day's mean value or null.

    Observations shrink to one per key and day, so what is held per key is
    bounded by the calendar and no key-by-day grid has to be joined.
    """
    daily = (df.groupBy(key, F.to_date(ts).alias("day")).agg(F.avg(value).alias("v")))
    inside = F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    entry = F.when(inside, F.struct("day", "v"))
    per_key = daily.groupBy(key).agg(F.map_from_entries(F.collect_list(entry)).alias("seen"))
    return (per_key.select(key, "seen", F.posexplode(business_days(start, end)).alias("pos", "day"))
            .select(key, "pos", "day", F.try_element_at("seen", F.col("day")).alias("value")))


def fill_linear(
    series: DataFrame, key: str, pos: str = "pos", value: str = "value", span: int | None = None
) -> DataFrame:
    """Fill inner gaps on the line between both neighbours; edges stay null.

    ``span`` cuts long series into stretches of that many positions.  Each
    stretch is one window; what it needs from the outside, the nearest known
    points before and after, comes from a summary of one row per stretch.
    """
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(pos).alias("i"), F.col(value).alias("v")))
    if span is None:
        rows = series.withColumns({"__part": F.lit(0), "__known": known})
        before, after = F.lit(None), F.lit(None)
    else:
        rows = series.withColumns({"__part": F.floor(F.col(pos) / F.lit(span)), "__known": known})
        ends = (rows.groupBy(key, "__part")
                .agg(F.max_by("__known", F.when(F.col(value).isNotNull(), F.col(pos))).alias("__late"),
                     F.min_by("__known", F.when(F.col(value).isNotNull(), F.col(pos))).alias("__early")))
        order = Window.partitionBy(key).orderBy("__part")
        ends = ends.select(
            F.col(key).alias("__key"), F.col("__part").alias("__p"),
            F.last("__late", True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("__before"),
            F.first("__early", True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("__after"))
        rows = rows.join(ends, F.col(key).eqNullSafe(F.col("__key")) & F.col("__part").eqNullSafe(F.col("__p")))
        before, after = F.col("__before"), F.col("__after")
    stretch = Window.partitionBy(key, "__part").orderBy(pos)
    back = stretch.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = stretch.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    marked = rows.withColumns({
        "__a": F.coalesce(F.last("__known", ignorenulls=True).over(back), before),
        "__b": F.coalesce(F.first("__known", ignorenulls=True).over(ahead), after)})
    slope = F.try_divide(F.col("__b.v") - F.col("__a.v"), F.col("__b.i") - F.col("__a.i"))
    line = F.col("__a.v") + slope * (F.col(pos) - F.col("__a.i"))
    return marked.withColumn(value, F.coalesce(F.col(value), line)).select(*series.columns)


def series_stats(series: DataFrame, key: str, value: str = "value", digits: int = 4) -> DataFrame:
    """Count, mean, population deviation, maximum and minimum of each series."""
    return series.groupBy(key).agg(
        F.count(value).alias("n"), F.round(F.avg(value), digits).alias("mean"),
        F.round(F.stddev_pop(value), digits).alias("stdev"),
        F.round(F.max(value), digits).alias("max"), F.round(F.min(value), digits).alias("min"))


def load_series(spark: SparkSession, path: str, header: str, ticker_pattern: str) -> DataFrame:
    """Long series ``(ticker, ts, value)`` from one delimited file per ticker.

    Lines hold ``year,month,day,value``.  All files come from a single scan;
    the ticker is the first group of ``ticker_pattern`` in the file's path.
    """
    lines = read_with_origin(spark, path)
    tagged = lines.where(F.col("value") != header).select(
        F.concat_ws(",", F.regexp_extract("path", ticker_pattern, 1), "value").alias("value"))
    fields = {"ticker": "string", "year": "int", "month": "int", "day": "int", "value": "double"}
    return typed_fields(tagged, fields).select("ticker", from_parts(F.col("year"), F.col("month"), F.col("day")).alias("ts"), "value")
