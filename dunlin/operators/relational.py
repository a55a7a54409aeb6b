"""Projections, joins, top-k and set operations with the checks Spark leaves out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dunlin.session import broadcast_if_bounded


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns; an absent old name is an error, not a silent no-op."""
    missing = [old for old in names if old not in df.columns]
    if missing:
        raise ValueError(f"cannot rename absent columns {missing}")
    return df.withColumnsRenamed(dict(names))


def columns_at(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """Select columns by 1-based position."""
    return df.select(*[F.col(f"`{df.columns[p - 1]}`") for p in positions])


def join_on(
    left: DataFrame,
    right: DataFrame,
    pairs: Mapping[str, str],
    how: str = "inner",
) -> DataFrame:
    """Equi join on differently named keys, keeping only the left key columns."""
    condition = None
    for left_name, right_name in pairs.items():
        term = left[left_name] == right[right_name]
        condition = term if condition is None else condition & term
    joined = left.join(right, condition, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[right[name] for name in pairs.values()])


def join_on_expression(
    left: DataFrame,
    right: DataFrame,
    left_key: Column,
    right_key: Column,
    name: str,
    how: str = "inner",
) -> DataFrame:
    """Join on a derived key that is computed once per side and kept as ``name``."""
    return left.withColumn(name, left_key).join(right.withColumn(name, right_key), name, how)


def star_lookup(
    facts: DataFrame,
    lookups: Sequence[tuple[DataFrame, str, str]],
    how: str = "inner",
) -> DataFrame:
    """Attach several code tables ``(table, fact key, table key)`` to a fact table.

    Each code table is shipped to the executors only if its measured bytes are few.
    """
    out = facts
    for table, fact_key, table_key in lookups:
        out = join_on(out, broadcast_if_bounded(table), {fact_key: table_key}, how)
    return out


def cartesian(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every pair of rows; the result has as many rows as both counts multiplied."""
    return left.crossJoin(right)


def merge_tables(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str] | None = None,
    suffixes: tuple[str, str] = ("_x", "_y"),
    product: bool = False,
) -> DataFrame:
    """Merge by all shared columns or by named ones.

    Shared columns that are not keys get a suffix.  Tables without a shared
    column are only multiplied if ``product`` asks for it.
    """
    shared = [c for c in left.columns if c in right.columns]
    keys = shared if by is None else list(by)
    if not keys:
        if not product:
            raise ValueError("the tables share no column; ask for their product by name")
        return cartesian(left, right)
    clash = [c for c in shared if c not in keys]
    left = left.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    right = right.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    return left.join(right, keys)


def top_groups(df: DataFrame, keys: Sequence[str], k: int, name: str = "n") -> DataFrame:
    """The ``k`` most frequent groups; ties go to the smaller key."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.desc(name), *keys).limit(k)


def in_range(column: Column, low, high) -> Column:
    """Two-sided range test with both ends included."""
    return (column >= F.lit(low)) & (column <= F.lit(high))
