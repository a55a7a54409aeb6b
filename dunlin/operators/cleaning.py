"""Missing values, ragged records and compound columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dunlin.functions import strings as S


def _text(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`").cast("string")


def drop_rows_with_token(df: DataFrame, token: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows in which any of the columns equals the missing-value token."""
    names = columns or df.columns
    hit = reduce(lambda a, b: a | b,
                 [F.coalesce(_text(df, n) == token, F.lit(False)) for n in names])
    return df.filter(~hit)


def drop_empty(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows whose named text columns are neither null nor empty."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(n) != "" for n in columns]))


def empty_to_default(df: DataFrame, default: str = "0", names_for_na: Sequence[str] = ()) -> DataFrame:
    """Replace empty text by ``default``, then ``default`` by ``NA`` in some columns."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    filled = df.withColumns({n: F.when(F.col(n) == "", default).otherwise(F.col(n)) for n in text})
    return filled.na.replace({default: "NA"}, subset=list(names_for_na)) if names_for_na else filled


def replace_values(df: DataFrame, mapping: Mapping, columns: Sequence[str]) -> DataFrame:
    """Replace whole values in the named columns."""
    return df.na.replace(dict(mapping), subset=list(columns))


def missing_profile(df: DataFrame, token: str = "?") -> DataFrame:
    """Per column: number of missing cells and their share in percent.

    A cell is missing when it is null or equals ``token``.  All columns are
    profiled in one pass that ends in a single row, which is then unfolded.
    """
    marks = [F.count_if(F.col(f"`{n}`").isNull() | (_text(df, n) == token)).alias(f"c{i}")
             for i, n in enumerate(df.columns)]
    row = df.agg(F.count(F.lit(1)).alias("total"), *marks)
    pairs = F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"c{i}").alias("missing"))
                      for i, n in enumerate(df.columns)])
    return (row.select("total", F.inline(pairs))
            .select("column", "missing",
                    F.round(100.0 * F.col("missing") / F.nullif(F.col("total"), F.lit(0)), 4).alias("pct")))


def separator_profile(df: DataFrame, column: str, separator: str) -> DataFrame:
    """Number of records and the largest separator count."""
    n = S.count_matches(F.col(column), separator)
    return df.agg(F.count(F.lit(1)).alias("records"), F.max(n).alias("max_separators"))


def fixed_length_records(df: DataFrame, column: str, names: Sequence[str], separator: str = ",") -> DataFrame:
    """Ragged delimited lines to one column per name.

    Missing fields are inserted before the last one, so the trailing field
    keeps its place.
    """
    padded = S.pad_after_last(F.col(column), separator, len(names) - 1)
    parts = df.select(F.split(padded, f"\\Q{separator}\\E").alias("parts"))
    return parts.select(*[F.get("parts", F.lit(i)).alias(n) for i, n in enumerate(names)])


def split_compound(df: DataFrame, column: str, pattern: str, names: Mapping[str, tuple[int, str]]) -> DataFrame:
    """Add typed columns ``name: (part index, type)`` taken from a compound column."""
    return df.withColumns({
        name: S.split_part_at(F.col(column), pattern, index).try_cast(kind)
        for name, (index, kind) in names.items()})
