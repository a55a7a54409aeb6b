"""Feature stages and checks on them, built on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    Bucketizer,
    CountVectorizerModel,
    HashingTF,
    IndexToString,
    NGram,
    OneHotEncoder,
    RegexTokenizer,
    StopWordsRemover,
    StringIndexer,
    UnivariateFeatureSelector,
    VectorAssembler,
    VectorIndexer,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def index_strings(df: DataFrame, columns: Sequence[str], suffix: str = "Cat"):
    """One fitted indexer for all columns: codes by falling frequency, ties by name."""
    return StringIndexer(inputCols=list(columns), outputCols=[c + suffix for c in columns]).fit(df)


def labels_back(df: DataFrame, column: str, labels: Sequence[str], out: str) -> DataFrame:
    """Index numbers to their original labels."""
    return IndexToString(inputCol=column, outputCol=out, labels=list(labels)).transform(df)


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """Numeric columns to one vector; rows with a null are kept out by the caller."""
    return VectorAssembler(inputCols=list(columns), outputCol=out).transform(df)


def index_vector(df: DataFrame, column: str, out: str, max_categories: int):
    """Fitted indexer of the vector slots that hold few distinct values."""
    return VectorIndexer(inputCol=column, outputCol=out, maxCategories=max_categories).fit(df)


def one_hot(df: DataFrame, column: str, out: str, drop_last: bool = True) -> DataFrame:
    """One slot per code; the last code is all zeros when dropped."""
    return OneHotEncoder(inputCols=[column], outputCols=[out], dropLast=drop_last).fit(df).transform(df)


def bucketize(df: DataFrame, column: str, out: str, bounds: Sequence[float]) -> DataFrame:
    """Bin number between the bounds, open at both ends."""
    splits = [float("-inf"), *map(float, bounds), float("inf")]
    return Bucketizer(splits=splits, inputCol=column, outputCol=out).transform(df)


def best_categorical(df: DataFrame, features: str, label: str, out: str, k: int = 1):
    """Fitted chi-squared selector of the ``k`` slots most related to the label."""
    selector = UnivariateFeatureSelector(featuresCol=features, labelCol=label, outputCol=out, selectionMode="numTopFeatures")
    return selector.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(k).fit(df)


def token_stages(
    text: str,
    pattern: str = "[a-zA-Z']+",
    gaps: bool = False,
    stop_words: Sequence[str] | None = None,
    ngrams: Sequence[int] = (2, 3),
    slots: int = 1 << 14,
) -> list:
    """Tokens, stop-word removal, n-grams and hashed counts, joined in ``features``."""
    stages = [RegexTokenizer(inputCol=text, outputCol="tokens", pattern=pattern, gaps=gaps)]
    remover = StopWordsRemover(inputCol="tokens", outputCol="kept", caseSensitive=False)
    if stop_words is not None:
        remover.setStopWords(list(stop_words))
    stages.append(remover)
    names = ["kept"]
    for n in ngrams:
        stages.append(NGram(n=n, inputCol="kept", outputCol=f"grams{n}"))
        names.append(f"grams{n}")
    for name in names:
        stages.append(HashingTF(inputCol=name, outputCol=f"{name}_tf", numFeatures=slots))
    stages.append(VectorAssembler(inputCols=[f"{n}_tf" for n in names], outputCol="features"))
    return stages


def balance_labels(df: DataFrame, label: str, key: Sequence[str], seed: int = 0) -> DataFrame:
    """Sample every label down to about the size of the rarest one, for any number of labels.

    A row stays if the hash of its ``key`` falls below its label's share, so a
    retried task keeps the same rows.  Label sizes are joined, not collected.
    """
    sizes = df.groupBy(F.col(label).alias("__label")).agg(F.count(F.lit(1)).alias("__n"))
    least = sizes.agg(F.min("__n")).scalar()
    spot = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *key), 11).cast("double") / float(1 << 53)
    shares = sizes.select("__label", (least / F.col("__n")).alias("__share"))
    return df.join(shares, df[label].eqNullSafe(shares["__label"])).where(spot < F.col("__share")).drop("__label", "__share")


def topic_vectors(df: DataFrame, tokens: str, out: str = "features", vocabulary: int = 10_000) -> tuple[DataFrame, dict[str, int]]:
    """Word counts over the ``vocabulary`` most frequent words, and those words with their numbers.

    The size of the vocabulary is the feature: rarer words say little about
    topics and are left out of the vectors. Of equally frequent words the smaller come first.
    ``df`` is read twice, so store it if its tokens are costly.
    """
    counts = df.select(F.explode(tokens).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    top = {r["word"]: r["n"] for r in counts.orderBy(F.desc("n"), "word").limit(vocabulary).collect()}
    return CountVectorizerModel.from_vocabulary(list(top), tokens, out).transform(df), top


def stage_names(model: PipelineModel) -> list[str]:
    """Class names of the fitted stages, in order."""
    return [type(s).__name__ for s in model.stages]
