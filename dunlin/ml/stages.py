"""Transformers for text cleaning that can be saved and loaded in a model."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dunlin.operators import text as E


class ColumnStage(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Apply one Column function to a column."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def apply(self, column: Column) -> Column:
        raise NotImplementedError

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), self.apply(F.col(self.getInputCol())))


class TagCleaner(ColumnStage):
    """Blank out tables and tags."""

    def apply(self, column: Column) -> Column:
        return E.drop_tables_and_tags(column)


class LetterPeriodCleaner(ColumnStage):
    """Remove URLs, file names, digits and punctuation except periods."""

    def apply(self, column: Column) -> Column:
        return E.keep_letters_and_periods(column)


class LetterCleaner(ColumnStage):
    """Keep letters only."""

    def apply(self, column: Column) -> Column:
        return F.regexp_replace(column, E.NOT_LETTER, " ")


class WhitespaceCleaner(ColumnStage):
    """Collapse white space."""

    def apply(self, column: Column) -> Column:
        return E.collapse_whitespace(column)


def text_cleaning_stages(column: str, out: str = "cleaned") -> list[Transformer]:
    """The four cleaners in order."""
    return [TagCleaner(inputCol=column, outputCol="__tags"),
            LetterPeriodCleaner(inputCol="__tags", outputCol="__periods"),
            LetterCleaner(inputCol="__periods", outputCol="__letters"),
            WhitespaceCleaner(inputCol="__letters", outputCol=out)]
