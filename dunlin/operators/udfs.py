"""Python functions over Arrow batches, with groups kept to a bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType

from dunlin.session import materialize, ship_code

#: Rows up to which a group is always left whole.
LARGE_GROUP = 10_000


def register_scalar(spark: SparkSession, name: str, function: Callable[[pd.Series], pd.Series], kind: DataType | str):
    """Make a batch function callable by name from SQL text."""
    ship_code(spark)
    return spark.udf.register(name, F.pandas_udf(function, kind))


def _text_fields(schema: StructType | str) -> list[str]:
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return [f.name for f in declared.fields if isinstance(f.dataType, StringType)]


def _plain_text(frame: pd.DataFrame, names: Sequence[str]) -> pd.DataFrame:
    """Text columns as objects with ``None``; pandas turns an all-null one into numbers."""
    return frame.assign(**{n: frame[n].astype(object).where(frame[n].notna(), None) for n in names})


def grouped_apply(
    df: DataFrame,
    keys: Sequence[str],
    function: Callable[[pd.DataFrame], pd.DataFrame],
    schema: StructType | str,
    merge: Callable[[pd.DataFrame], pd.DataFrame],
) -> DataFrame:
    """Apply ``function`` to pieces of each group and ``merge`` to the results.

    One call streams a group in Arrow batches: ``function`` sees each batch, ``merge`` what the
    batches so far gave and the next result, so a worker holds one batch and one result. A group with
    more rows than an average partition is dealt to several calls whose results are merged once more; there
    are no more such groups than partitions, which bounds the list of them that is broadcast.
    ``merge`` must accept its own output, and its result must not depend on how the pieces were cut; so that
    all groups take the same way, it is also called on single results. Both return the key columns. Use
    :func:`whole_groups` for a function that has to see its group at once.
    """
    ship_code(df.sparkSession)
    text, by = _text_fields(schema), list(keys)
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        result = None
        for frame in frames:
            if len(frame):
                part = function(frame.drop(columns="#piece"))
                result = merge(part if result is None else pd.concat([result, part], ignore_index=True))
        if result is not None:
            yield _plain_text(result, text)

    def final(frame: pd.DataFrame) -> pd.DataFrame:
        return _plain_text(merge(frame), text)

    sizes = materialize(df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")), "sizes")
    limit = max(LARGE_GROUP, (sizes.agg(F.sum("n")).first()[0] or 0) // partitions)
    large = sizes.where(F.col("n") > limit).select(*(F.col(k).alias(f"#{k}") for k in by), F.ceil(F.col("n") / limit).cast("int").alias("#pieces"))
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"#{k}")) for k in by))
    dealt = df.join(F.broadcast(large), same, "left").withColumn("#piece", F.pmod(F.monotonically_increasing_id(), F.coalesce("#pieces", F.lit(1))))
    # Calls cost far more than bytes, so adaptive execution must not merge partitions by their bytes.
    pieces = dealt.select(*df.columns, "#piece").repartition(partitions, *by, "#piece")
    parts = pieces.groupBy(*by, "#piece").applyInPandas(stream, schema)
    return parts.repartition(partitions, *by).groupBy(*by).applyInPandas(final, schema)


def whole_groups(
    df: DataFrame, keys: Sequence[str], function: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType | str
) -> DataFrame:
    """Apply ``function`` to each whole group; a worker has to hold its largest group."""
    ship_code(df.sparkSession)
    text = _text_fields(schema)
    return df.groupBy(*keys).applyInPandas(lambda frame: _plain_text(function(frame), text), schema)


def mergeable_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    partial: Callable[[pd.DataFrame], pd.DataFrame],
    partial_schema: StructType | str,
    merge: Sequence[Column],
) -> DataFrame:
    """User-defined aggregate in two steps: Python per batch, built-ins across.

    ``partial`` reduces an Arrow batch to one row per key; ``merge`` lists the
    built-in aggregates that combine those rows.
    """

    ship_code(df.sparkSession)
    text = _text_fields(partial_schema)

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield _plain_text(partial(frame), text)

    return df.mapInPandas(batches, partial_schema).groupBy(*keys).agg(*merge)


def not_in_set(column: Column, values: Sequence) -> Column:
    """True when the value is not one of a short literal list."""
    return ~column.isin(list(values))
