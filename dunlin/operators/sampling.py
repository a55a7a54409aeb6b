"""Samples and splits: approximate ones in one pass, exact ones by hash cuts."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dunlin.operators.windows import cut_strata


def exact_stratified(
    df: DataFrame, stratum: str, fractions: Mapping, key: Sequence[str], seed: int = 0
) -> DataFrame:
    """Exactly ``ceil(fraction * size)`` rows of each listed stratum, none of others."""
    listed = df.where(F.col(stratum).isin(list(fractions))).withColumn("__f", _fraction(stratum, fractions))
    cut = cut_strata(listed, [stratum, "__f"], key,
                     [("kept", lambda size: F.ceil(F.col("__s1").cast("decimal(18,12)") * size))], seed, "__part")
    return cut.drop("__part", "__f")


def _fraction(stratum: str, fractions: Mapping) -> Column:
    chain = None
    for value, part in fractions.items():
        amount = F.lit(Decimal(str(part)).quantize(Decimal("0.000000000001")))
        test = F.col(stratum) == F.lit(value)
        chain = F.when(test, amount) if chain is None else chain.when(test, amount)
    return chain


#: Means above this are drawn as a sum of independent smaller ones; exp(-mean) stays well above zero.
POISSON_MEAN = 32.0


def _poisson_steps(mean: float) -> list[float]:
    """Cumulative Poisson probabilities up to where doubles reach one."""
    steps, term, total, k = [], math.exp(-mean), 0.0, 0
    while total + term > total:
        total += term
        steps.append(min(total, 1.0))
        k += 1
        term *= mean / k
    return steps


def keyed_with_replacement(df: DataFrame, stratum: str, means: Mapping, seed: int = 0) -> DataFrame:
    """Repeat each row a Poisson number of times whose mean depends on its stratum.

    All strata are drawn in one pass over the table; unlisted ones give no rows.
    """
    steps = draws = None
    for value, mean in means.items():
        parts = max(1, math.ceil(float(mean) / POISSON_MEAN))
        cdf = F.array(*[F.lit(s) for s in _poisson_steps(float(mean) / parts)])
        test = F.col(stratum) == F.lit(value)
        steps = F.when(test, cdf) if steps is None else steps.when(test, cdf)
        draws = F.when(test, parts) if draws is None else draws.when(test, parts)
    drawn = df.withColumns({"__u": F.rand(seed), "__cdf": steps, "__draws": draws}).where(F.col("__cdf").isNotNull())
    # One random number per row seeds its draws.
    spot = lambda i: F.shiftrightunsigned(F.xxhash64("__u", i), 11).cast("double") / float(1 << 53)
    once = lambda i: F.size(F.filter("__cdf", lambda c: c <= spot(i)))
    copies = F.aggregate(F.sequence(F.lit(1), F.col("__draws")), F.lit(0), lambda n, i: n + once(i))
    return (drawn.withColumn("__n", copies).where("__n > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
            .select(*df.columns))


def split_by_weight(df: DataFrame, weights: Sequence[float], key: Sequence[str], seed: int = 0) -> list[DataFrame]:
    """Disjoint random parts whose union is the whole table.

    A row's part is a hash of its key, so a retried task picks the same rows
    and nothing is sorted.
    """
    total = float(sum(weights))
    spot = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *key), 11).cast("double") / float(1 << 53)
    parts, low = [], 0.0
    for i, weight in enumerate(weights):
        high = low + weight / total
        test = spot >= low if i == len(weights) - 1 else (spot >= low) & (spot < high)
        parts.append(df.where(test))
        low = high
    return parts


def holdout(df: DataFrame, sample: DataFrame) -> DataFrame:
    """Rows not in the sample, as a set: repeated rows appear once."""
    return df.subtract(sample)
