"""Value recoding and arithmetic over sets of columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dunlin.session import broadcast_if_bounded


def recode(column: Column, values: Mapping, default=None, strict: bool = False) -> Column:
    """Map values by an explicit table.

    Unknown values become ``default``; with ``strict`` they raise instead.
    """
    chain = None
    for old, new in values.items():
        chain = (F.when(column == F.lit(old), F.lit(new)) if chain is None
                 else chain.when(column == F.lit(old), F.lit(new)))
    if strict:
        message = F.concat(F.lit("no code for value "), column.cast("string"))
        return chain.when(column.isNull(), F.lit(None)).otherwise(F.raise_error(message))
    return chain.otherwise(F.lit(default))


def bin_by_bounds(column: Column, bounds: Sequence[float], names: Sequence) -> Column:
    """Name of the half-open bin ``[bound i, bound i+1)`` a value falls in."""
    chain = F.when(column < bounds[0], F.lit(names[0]))
    for bound, name in zip(bounds[1:], names[1:]):
        chain = chain.when(column < bound, F.lit(name))
    return chain.when(column.isNotNull(), F.lit(names[len(bounds)]))


def factor(df: DataFrame, column: str, levels: DataFrame, level: str, label: str, out: str) -> DataFrame:
    """Replace codes by the label found in a table of levels; unknown codes give null."""
    table = levels.select(F.col(level).alias("__level"), F.col(label).alias(out))
    return df.join(broadcast_if_bounded(table), F.col(column) == F.col("__level"), "left").drop("__level")


def sum_of(columns: Sequence[str]) -> Column:
    """Row-wise sum of the named columns."""
    return reduce(add, [F.col(c) for c in columns])
