"""Model fitting helpers on top of Spark ML estimators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Estimator
from pyspark.ml.clustering import LDAModel
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dunlin.operators.aggregates import slice_of, value_slices


def cross_validate(
    estimator: Estimator,
    evaluator: Evaluator,
    grid: Mapping,
    train: DataFrame,
    keys: Sequence[str],
    folds: int = 2,
    parallelism: int = 2,
    seed: int = 0,
) -> CrossValidatorModel:
    """Grid search by k-fold cross validation, fitted on training rows only.

    The fold of a row is a hash of its ``keys`` and the seed, so it stays the same however the
    rows are ordered, dealt out or read again; rows with equal keys share a fold.
    """
    train = train.withColumn("#fold", fold_of(keys, folds, seed))
    builder = ParamGridBuilder()
    for param, values in grid.items():
        builder = builder.addGrid(param, list(values))
    return CrossValidator(estimator=estimator, evaluator=evaluator, estimatorParamMaps=builder.build(),
                          numFolds=folds, parallelism=parallelism, seed=seed, foldCol="#fold").fit(train)


def fold_of(keys: Sequence[str], folds: int, seed: int = 0) -> Column:
    """Number of the fold, 0 to ``folds - 1``, by a hash of the keys."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(folds)).cast("int")


def fit_family(
    settings: Sequence, fit: Callable, rows: Callable[[object, object], tuple], spark, schema: str
) -> DataFrame:
    """Fit one distributed model per setting and tabulate a row for each."""
    return spark.createDataFrame([rows(s, fit(s)) for s in settings], schema)


def distance_to_centre(assigned: DataFrame, centres: Sequence, features: str = "features", prediction: str = "prediction") -> DataFrame:
    """Add ``distance``, the Euclidean distance of a row to its cluster centre."""
    table = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centres])
    own = F.get(table, F.col(prediction))
    squares = F.zip_with(vector_to_array(features), own, lambda a, b: (a - b) * (a - b))
    return assigned.withColumn("distance", F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x)))


def flag_outliers(df: DataFrame, column: str, share: float, accuracy: int = 10000) -> DataFrame:
    """Mark about the given share of rows with the largest values."""
    cut = df.agg(F.percentile_approx(column, 1.0 - share, accuracy)).scalar()
    return df.withColumn("outlier", F.col(column) > cut)


def topic_terms(model: LDAModel, vocabulary: Sequence[str], terms: int) -> DataFrame:
    """``(topic, rank, term, weight)`` from the topics joined with the vocabulary."""
    topics = model.describeTopics(terms)
    spark = topics.sparkSession
    words = spark.createDataFrame(list(enumerate(vocabulary)), "i int, term string")
    both = topics.select("topic", F.inline(F.arrays_zip("termIndices", "termWeights")))
    rank = F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("weight"), "i"))
    return (both.toDF("topic", "i", "weight").join(words, "i")
            .select("topic", rank.alias("rank"), "term", "weight"))


def log_perplexity(likelihood: float, vocabulary: Mapping[str, int]) -> float:
    """Negative log likelihood per counted word, as ``LDAModel.logPerplexity`` has it; ``vocabulary`` gives each word's number."""
    return -likelihood / sum(vocabulary.values())


def class_rank(scores: Column, label: Column) -> Column:
    """1-based rank of the true class among the scores."""
    own = F.get(scores, label)
    return F.size(F.filter(scores, lambda s: s > own)) + 1


def top_k_accuracy(df: DataFrame, scores: str, label: str, ks: Sequence[int], digits: int = 6) -> DataFrame:
    """Share of rows whose true class is among the k highest scores, and the mean loss.

    ``scores`` is an array of raw scores; the loss is the cross entropy of
    their softmax.
    """
    rank = class_rank(F.col(scores), F.col(label))
    peak = F.array_max(scores)
    total = F.aggregate(scores, F.lit(0.0), lambda a, x: a + F.exp(x.cast("double") - peak))
    loss = F.log(total) + peak - F.get(F.col(scores), F.col(label))
    ranked = df.select(rank.alias("rank"), loss.alias("loss"))
    return ranked.agg(
        *[F.round(F.avg((F.col("rank") <= k).cast("int")), digits).alias(f"top{k}") for k in ks],
        F.round(F.avg("loss"), digits).alias("loss"), F.count(F.lit(1)).alias("n"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per pair of true and predicted class."""
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, label: str, prediction: str, digits: int = 6) -> DataFrame:
    """Accuracy and error as a plain average."""
    hit = F.avg((F.col(label) == F.col(prediction)).cast("double"))
    return df.agg(F.round(hit, digits).alias("accuracy"), F.round(1 - hit, digits).alias("error"))


def area_under_roc(df: DataFrame, score: str, label: str, digits: int = 6, slices: int = 64) -> DataFrame:
    """Exact area under the ROC curve, equal scores counting one half.

    Rows shrink to one per distinct score.  Positives and negatives below each
    score come from running sums inside slices of the score range plus the
    totals of the slices before, so nothing is sorted in one task.
    """
    bounds = value_slices(df, score, slices)
    marked = df.where(F.col(score).isNotNull()).select(
        F.col(score).alias("s"), (F.col(label) > 0).cast("long").alias("pos"),
        (F.col(label) <= 0).cast("long").alias("neg"), slice_of(F.col(score).cast("double"), bounds).alias("slice"))
    per_score = marked.groupBy("slice", "s").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    totals = marked.groupBy("slice").agg(F.sum("neg").alias("neg"))
    before = totals.select("slice", (F.sum("neg").over(Window.orderBy("slice")) - F.col("neg")).alias("offset"))
    inside = F.sum("neg").over(Window.partitionBy("slice").orderBy("s")) - F.col("neg")
    placed = per_score.withColumn("below", inside).join(F.broadcast(before), "slice")
    wins = F.sum(F.col("pos") * (F.col("offset") + F.col("below") + F.col("neg") / 2.0))
    return placed.agg(F.round(wins / F.sum("pos") / F.sum("neg"), digits).alias("auc"))


def class_margins(vector: str, weights: Sequence[Sequence[float]], offsets: Sequence[float], is_array: bool = False) -> Column:
    """One score per class: the product of its weights with the vector, plus its offset."""
    values = F.col(vector) if is_array else vector_to_array(vector)
    products = []
    for row, offset in zip(weights, offsets):
        pairs = F.zip_with(values, F.array(*[F.lit(float(w)) for w in row]), lambda x, w: x.cast("double") * w)
        products.append(F.aggregate(pairs, F.lit(float(offset)), lambda a, x: a + x))
    return F.array(*products)


def softmax(margins: Column) -> Column:
    """Scores as chances that sum to one."""
    powers = F.transform(margins, lambda m: F.exp(m - F.array_max(margins)))
    return F.transform(powers, lambda p: p / F.aggregate(powers, F.lit(0.0), lambda a, x: a + x))


def cluster_summary(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Per cluster its size, most frequent label (ties: the smallest) and the rows with another label."""
    counts = df.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(cluster).agg(
        F.sum("n").alias("n"), F.max_by(label, F.struct(F.col("n"), -F.col(label))).alias("majority"),
        (F.sum("n") - F.max("n")).alias("mismatch"))
