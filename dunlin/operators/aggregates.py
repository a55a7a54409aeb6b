"""Statistics, pivots, bins and quantiles as map-side combined aggregations."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Mapping, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dunlin.operators.ranks import running_totals
from dunlin.session import materialize, ship_code


def share_of_total(df: DataFrame, keys: Sequence[str], digits: int = 4) -> DataFrame:
    """Rows and percent of all rows per group.

    The total comes from the grouped counts through a scalar subquery, so the
    rows themselves are never gathered behind an unpartitioned window.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.round(100.0 * F.col("n") / total, digits))


def count_of_counts(df: DataFrame, keys: Sequence[str], size: str = "size", groups: str = "groups") -> DataFrame:
    """How many groups have each size."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(size))
            .groupBy(size).agg(F.count(F.lit(1)).alias(groups)))


def describe(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum, one typed row per column."""
    parts = []
    for i, name in enumerate(columns):
        c = F.col(f"`{name}`").cast("double")
        parts += [F.count(c).alias(f"n{i}"), F.avg(c).alias(f"m{i}"), F.stddev_samp(c).alias(f"s{i}"),
                  F.min(c).alias(f"a{i}"), F.max(c).alias(f"b{i}")]
    rows = F.array(*[F.struct(
        F.lit(name).alias("column"), F.col(f"n{i}").alias("n"), F.round(f"m{i}", digits).alias("mean"),
        F.round(f"s{i}", digits).alias("stddev"), F.col(f"a{i}").alias("min"), F.col(f"b{i}").alias("max"))
        for i, name in enumerate(columns)])
    return df.agg(*parts).select(F.inline(rows))


def moments(column: str, digits: int = 6) -> list[Column]:
    """Population skewness and excess kurtosis."""
    return [F.round(F.skewness(column), digits).alias("skewness"), F.round(F.kurtosis(column), digits).alias("kurtosis")]


def correlations(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every pair of columns from a single pass.

    A constant column gives null instead of a division error.
    """
    pairs = list(combinations(columns, 2))

    def guarded(a: str, b: str) -> Column:
        x = F.when(F.col(b).isNotNull(), F.col(a))
        y = F.when(F.col(a).isNotNull(), F.col(b))
        spread = F.stddev_pop(x) * F.stddev_pop(y)
        return F.try_divide(F.covar_pop(a, b), F.nullif(spread, F.lit(0.0)))

    row = df.agg(*[guarded(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    items = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(f"r{i}", digits).alias("corr"))
                      for i, (a, b) in enumerate(pairs)])
    return row.select(F.inline(items))


def distinct_values(df: DataFrame, column: str, limit: int) -> list:
    """Distinct non-null values of a column; more than the stated limit is an error."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"{column} holds more than {limit} distinct values")
    return sorted(r[0] for r in found)


def _listed(df: DataFrame, column: str, values: Sequence | None, limit: int | None) -> list:
    if values is None and limit is None:
        raise ValueError("a wide table needs its values listed, or a limit on how many it may have")
    return list(values) if values is not None else distinct_values(df, column, limit)


def crosstab_long(df: DataFrame, row: str, column: str) -> DataFrame:
    """Contingency table as ``(row, column, n)``, for any number of values."""
    return df.groupBy(row, column).agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence | None = None, limit: int | None = None) -> DataFrame:
    """Contingency table with one count column per value of ``column``.

    The values are listed, or found in the data up to the stated ``limit``.
    """
    return df.groupBy(row).pivot(column, _listed(df, column, values, limit)).agg(F.count(F.lit(1))).na.fill(0)


def pivot(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    aggregates: Sequence[Column],
    values: Sequence | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Pivot over listed values, or over those found up to the stated ``limit``."""
    return df.groupBy(*keys).pivot(column, _listed(df, column, values, limit)).agg(*aggregates)


def column_group_sums(df: DataFrame, keys: Sequence[str], groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """Row-wise sums of named groups of columns, nulls taken as zero."""
    filled = df.na.fill(0)
    sums = []
    for name, members in groups.items():
        total = F.lit(0)
        for member in members:
            total = total + F.col(f"`{member}`")
        sums.append(total.alias(name))
    return filled.select(*keys, *sums)


def _summaries(batches: Iterable[pa.RecordBatch], kept: int) -> Iterator[pa.RecordBatch]:
    """Misra-Gries summary of the hashes in ``batches``: at most ``kept`` counts, each too low by ``error`` at most."""
    keys, counts, error, rows = np.empty(0, np.int64), np.empty(0, np.int64), 0, 0
    for batch in batches:
        rows += batch.num_rows
        fresh, times = np.unique(np.asarray(batch.column(0)), return_counts=True)
        keys, place = np.unique(np.concatenate([keys, fresh]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([counts, times])).astype(np.int64)
        if len(keys) > kept:
            # What all counts give up together was seen kept + 1 times as often.
            cut = int(np.partition(counts, -kept - 1)[-kept - 1])
            error, stay = error + cut, counts > cut
            keys, counts = keys[stay], counts[stay] - cut
    yield pa.RecordBatch.from_arrays([
        pa.array([None, *keys.tolist()], pa.int64()), pa.array([rows, *counts.tolist()], pa.int64()), pa.array([error] + [0] * len(keys), pa.int64())],
        ["key", "n", "error"])


def frequent_items(df: DataFrame, column: str, support: float) -> DataFrame:
    """Exactly the values (null too) that hold at least ``support`` of all rows, with their counts.

    Every task summarises its rows in ``2 / support`` counters, so what is shuffled does not
    grow with the number of distinct values. A frequent value cannot be missing from the merged summary;
    at most ``2 / support`` candidates are left, and a second pass counts only the rows that hold one.
    """
    if not 0 < support <= 1:
        raise ValueError("support is a share of the rows")
    ship_code(df.sparkSession)
    kept = math.ceil(2 / support)
    hashed = df.select(F.xxhash64(column).alias("key"))
    merged = materialize(hashed.mapInArrow(lambda batches: _summaries(batches, kept), "key long, n long, error long")
                         .groupBy("key").agg(F.sum("n").alias("n"), F.sum("error").alias("error")), "summary")
    whole = merged.where("key IS NULL").first()
    total, error = (whole["n"], whole["error"]) if whole else (0, 0)
    candidates = merged.where(F.col("key").isNotNull() & (F.col("n") >= F.lit(support * total - error))).select(F.col("key").alias("#key"))
    counted = df.select(column).join(F.broadcast(candidates), F.xxhash64(column) == F.col("#key"), "left_semi").groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= F.lit(support) * F.lit(total))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins with their centre and count, empty bins included."""
    values = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    span = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    width = (hi - lo) / F.lit(float(bins))
    # A single distinct value has no width and falls in the first bin.
    slot = F.coalesce(F.floor(F.try_divide(F.col("v") - lo, width)), F.lit(0))
    counts = (values.groupBy(F.least(slot, F.lit(bins - 1)).cast("long").alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return (every.join(counts, "bin", "left")
            .select("bin", (lo + width * (F.col("bin") + 0.5)).alias("centroid"),
                    F.coalesce("n", F.lit(0)).alias("n")))


def fixed_width_bins(df: DataFrame, keys: Sequence[str], widths: Mapping[str, float]) -> DataFrame:
    """Counts on a grid of fixed cell width; cells are named by their lower edge."""
    cells = [(F.floor(F.col(c) / F.lit(float(w))) * F.lit(float(w))).cast("double").alias(f"{c}_from") for c, w in widths.items()]
    return df.groupBy(*keys, *cells).agg(F.count(F.lit(1)).alias("n"))


def shares_within(df: DataFrame, outer: str, inner: str, digits: int = 4) -> DataFrame:
    """Share of each inner value inside its outer group, from grouped counts."""
    counts = df.groupBy(outer, inner).agg(F.count(F.lit(1)).alias("n"))
    whole = F.sum("n").over(Window.partitionBy(outer))
    return counts.select(outer, inner, "n", F.round(F.col("n") / whole, digits).alias("share"))


def approximate_five_numbers(df: DataFrame, keys: Sequence[str], column: str, accuracy: int = 10000) -> DataFrame:
    """Exact extremes and approximate quartiles per group, from a mergeable sketch.

    A quartile's rank is off by at most ``1 / accuracy`` of the group.
    """
    quarts = F.percentile_approx(column, [0.25, 0.5, 0.75], accuracy)
    return (df.groupBy(*keys)
            .agg(F.min(column).alias("min"), quarts.alias("q"), F.max(column).alias("max"))
            .select(*keys, "min", F.get("q", F.lit(0)).alias("q1"), F.get("q", F.lit(1)).alias("median"),
                    F.get("q", F.lit(2)).alias("q3"), "max"))


def slice_of(value: Column, bounds: Sequence[float]) -> Column:
    """Number of sorted bounds that do not exceed the value, by nested halving."""

    def halve(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value < F.lit(float(bounds[middle])), halve(low, middle)).otherwise(halve(middle + 1, high))

    return halve(0, len(bounds))


def value_slices(df: DataFrame, column: str, slices: int = 64) -> list[float]:
    """Bounds that cut a numeric column into about equal slices."""
    steps = [i / slices for i in range(1, slices)]
    found = df.agg(F.percentile_approx(F.col(column).cast("double"), steps).alias("q")).first()["q"]
    return sorted(set(found or []))


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float], accuracy: int = 10_000) -> DataFrame:
    """Exact quantiles ``(probability, value)`` in two passes and in the column's own type.

    A sketch brackets each quantile between two values.  One more pass counts
    the rows outside the brackets and, value by value, those inside, so a value
    that fills much of the table is one row; the counts inside are added up range by range.  A quantile is the smallest value
    whose rank is at least ``ceil(probability * n)``.
    """
    spark = df.sparkSession
    values = df.select(F.col(column).alias("value")).where(F.col("value").isNotNull())
    kind = values.schema["value"].dataType
    steps = sorted({min(1.0, max(0.0, p + d)) for p in probabilities for d in (-2 / accuracy, 2 / accuracy)})
    found = values.agg(F.percentile_approx("value", steps, accuracy).alias("q"), F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")).first()
    if not found["n"]:
        return spark.createDataFrame([], f"probability double, value {kind.simpleString()}")
    at = dict(zip(steps, found["q"]))
    # The sketch works in doubles; a long or decimal bracket may be rounded, so the counts below check it.
    ranks = {float(p): max(1, math.ceil(p * found["n"])) for p in probabilities}
    brackets = {p: (found["lo"] if p - 2 / accuracy <= 0 else at[max(0.0, p - 2 / accuracy)],
                    found["hi"] if p + 2 / accuracy >= 1 else at[min(1.0, p + 2 / accuracy)]) for p in ranks}
    while True:
        bounds = sorted({v for pair in brackets.values() for v in pair})
        lits = [F.lit(v).cast(kind) for v in bounds]
        # Odd slots are the bounds themselves, even ones what lies between.
        slot = sum(((F.col("value") >= v).cast("int") + (F.col("value") > v).cast("int") for v in lits), F.lit(0))
        inside = {s for low, high in brackets.values() for s in range(2 * bounds.index(low) + 1, 2 * bounds.index(high) + 2)}
        placed = values.withColumn("slot", slot)
        counts = materialize(placed.groupBy("slot", F.when(F.col("slot").isin(sorted(inside)), F.col("value")).alias("value")).agg(F.count(F.lit(1)).alias("n")), "quantiles")
        sizes = {r["slot"]: r["n"] for r in counts.groupBy("slot").agg(F.sum("n").alias("n")).collect()}
        wanted, missed = [], []
        for p, rank in ranks.items():
            before = 0
            for s in sorted(sizes):
                if before + sizes[s] >= rank:
                    break
                before += sizes[s]
            wanted.append((p, s, rank - before))
            if s not in inside:
                missed.append(p)
        if not missed:
            break
        brackets |= {p: (found["lo"], found["hi"]) for p in missed}
    # Ranks among the rows of the wanted slots alone, which are taken in one order.
    used = sorted({s for _, s, _ in wanted})
    shift = {s: sum(sizes[u] for u in used if u < s) for s in used}
    targets = spark.createDataFrame([(p, s, rank + shift[s]) for p, s, rank in wanted], "probability double, slot int, rank long")
    ordered = running_totals(counts.where(F.col("slot").isin(used)), ["slot", "value"], "n")
    return (ordered.join(F.broadcast(targets), "slot")
            .where((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("n") < F.col("rank")))
            .select("probability", "value"))
