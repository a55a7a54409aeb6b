"""Ranked selection per key in forms that survive a very large key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dunlin.session import broadcast_if_bounded, materialize

#: Hash buckets per stratum; only the bucket that holds a cut is ordered.
HASH_BITS = 12


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key under ``order``.

    Spark keeps one candidate per key and task before the shuffle (window
    group limit), so a hot key sends only one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")


def cut_strata(
    df: DataFrame,
    strata: Sequence[str],
    key: Sequence[str],
    quotas: Sequence[tuple[str, Callable[[Column], Column]]],
    seed: int = 0,
    out: str = "part",
) -> DataFrame:
    """Give rows of each stratum, in random order, to parts of exact size.

    ``quotas`` lists ``(part name, stratum size -> cumulative rank)`` in rising
    order; rows past the last rank are left out.  ``key`` must identify a row.
    The random order is a hash of key and seed, so it is the same in every
    run.  A histogram of the hash finds the bucket each cut falls in, ranking
    that bucket alone finds the row at the cut, and one last pass over the table
    keeps what is not after it: no stratum is sorted as a whole.
    """
    mixed = F.xxhash64(F.lit(seed), *key)
    rows = df.withColumns({"__h": mixed, "__b": F.shiftrightunsigned(mixed, 64 - HASH_BITS).cast("int")})
    groups = [F.coalesce(F.col(s).cast("string"), F.lit("\0")).alias(f"__s{i}") for i, s in enumerate(strata)]
    names = [f"__s{i}" for i in range(len(strata))]
    rows = rows.select("*", *groups)

    by_stratum = Window.partitionBy(*names)
    hist = (rows.groupBy(*names, "__b").agg(F.count(F.lit(1)).alias("n"))
            .withColumns({"upto": F.sum("n").over(by_stratum.orderBy("__b")), "size": F.sum("n").over(by_stratum)}))
    cuts = []
    for i, (_, quota) in enumerate(quotas):
        rank = F.least(quota(F.col("size")), F.col("size"))
        here = (F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank)
        cuts += [F.max(F.when(here, F.col("__b"))).alias(f"__c{i}"),
                 F.max(F.when(here, rank - F.col("upto") + F.col("n"))).alias(f"__r{i}")]
    edges = materialize(hist.groupBy(*names).agg(*cuts), "edges")  # one row per stratum

    # Rank the contested buckets alone and keep the row at each cut.
    joined = rows.select(*names, "__b", "__h", *key).join(broadcast_if_bounded(edges), names)
    contested = F.lit(False)
    for i in range(len(quotas)):
        contested = contested | F.coalesce(F.col("__b") == F.col(f"__c{i}"), F.lit(False))
    rank = F.row_number().over(Window.partitionBy(*names, "__b").orderBy("__h", *key))
    ranked = joined.where(contested).withColumn("__n", rank)
    # The bucket is the unsigned head of the hash, so it comes first in the order.
    place = F.struct("__b", "__h", *key)
    last = [F.max(F.when((F.col("__b") == F.col(f"__c{i}")) & (F.col("__n") == F.col(f"__r{i}")), place)).alias(f"__cut{i}")
            for i in range(len(quotas))]
    stored = materialize(ranked.groupBy(*names).agg(*last), "cuts")

    # One pass: a row is in the first part whose cut is not before it.
    label = None
    for i, (name, _) in enumerate(quotas):
        inside = F.coalesce(place <= F.col(f"__cut{i}"), F.lit(False))
        label = F.when(inside, name) if label is None else label.when(inside, name)
    return (rows.join(broadcast_if_bounded(stored), names).withColumn(out, label).where(F.col(out).isNotNull())
            .select(*df.columns, out))


def random_per_stratum(df: DataFrame, strata: Sequence[str], key: Sequence[str], k: int, seed: int = 0) -> DataFrame:
    """``min(k, size)`` random rows of every stratum."""
    return cut_strata(df, strata, key, [("kept", lambda size: F.lit(k))], seed, "__part").drop("__part")


def train_test_per_stratum(
    df: DataFrame, strata: Sequence[str], key: Sequence[str], train: int, total: int, seed: int = 0
) -> DataFrame:
    """Disjoint train and test rows per stratum, marked in column ``part``."""
    return cut_strata(df, strata, key,
                      [("train", lambda size: F.lit(train)), ("test", lambda size: F.lit(total))], seed)
