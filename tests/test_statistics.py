import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import LDA
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from dunlin.ml import features as L
from dunlin.ml.features import index_strings
from dunlin.ml.models import area_under_roc, cross_validate, fold_of, log_perplexity
from dunlin.operators import aggregates as A
from dunlin.operators import relational as R
from dunlin.operators import sampling as Z
from dunlin.operators import timeseries as Y
from dunlin.operators import windows as W
from dunlin.operators.ranks import code_labels, label_codes, running_totals
from tests.conftest import values


def test_share_and_counts(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert values(A.share_of_total(df, ["k"])) == sorted([("a", 2, 50.0), ("b", 1, 25.0), (None, 1, 25.0)], key=repr)
    assert values(A.count_of_counts(df, ["k"])) == [(1, 2), (2, 1)]
    assert A.share_of_total(df.limit(0), ["k"]).count() == 0


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in (0, 0, 1, 9, 10)], "x double")
    assert [r["n"] for r in A.histogram(df, "x", 5).orderBy("bin").collect()] == [3, 0, 0, 0, 2]
    flat = spark.createDataFrame([(4.0,), (4.0,)], "x double")
    assert [r["n"] for r in A.histogram(flat, "x", 3).orderBy("bin").collect()] == [2, 0, 0]


def test_correlation_of_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.0, 5.0)], "a double, b double, c double")
    got = {(r["a"], r["b"]): r["corr"] for r in A.correlations(df, ["a", "b", "c"]).collect()}
    assert got == {("a", "b"): 1.0, ("a", "c"): None, ("b", "c"): None}


def test_crosstab_guard(spark):
    df = spark.range(50).select(F.lit("x").alias("r"), F.col("id").alias("c"))
    with pytest.raises(ValueError):
        A.crosstab(df, "r", "c", limit=10)
    with pytest.raises(ValueError):
        A.crosstab(df, "r", "c")
    many = spark.range(3000).select(F.lit("x").alias("r"), F.col("id").alias("c"))
    assert A.crosstab_long(many, "r", "c").count() == 3000
    assert len(A.crosstab(many, "r", "c", limit=5000).columns) == 3001
    small = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("b", None)], "r string, c string")
    assert values(A.crosstab(small, "r", "c", limit=5)) == [("a", 1, 1), ("b", 1, 0)]


def test_exact_quantiles_with_hot_value(spark):
    rng = random.Random(1)
    data = [7.0] * 500 + [rng.random() * 100 for _ in range(1000)] + [None]
    df = spark.createDataFrame([(x,) for x in data], "x double").repartition(4)
    ordered = sorted(x for x in data if x is not None)
    probabilities = [0.0, 0.001, 0.25, 0.5, 0.77, 1.0]
    want = {p: ordered[max(1, -int(-p * len(ordered) // 1)) - 1] for p in probabilities}
    got = {r["probability"]: r["value"] for r in A.exact_quantiles(df, "x", probabilities, accuracy=16).collect()}
    assert got == want


def test_exact_quantiles_keep_the_type(spark):
    base = 1 << 60
    longs = spark.range(2001).select((F.col("id") + base).alias("x"))
    assert [r["value"] for r in A.exact_quantiles(longs, "x", [0.5, 0.9], 50).orderBy("probability").collect()] == [base + 1000, base + 1800]
    exact = spark.range(1001).select((F.col("id").cast("decimal(30,10)") + F.lit("12345678901234567.0000000001").cast("decimal(30,10)")).alias("x"))
    got = A.exact_quantiles(exact, "x", [0.25]).first()["value"]
    assert str(got) == "12345678901234817.0000000001"
    assert A.exact_quantiles(longs.limit(0), "x", [0.5]).count() == 0


def test_area_under_roc(spark):
    rng = random.Random(2)
    data = [(rng.choice([1.0, 1.0, 2.0, rng.random()]), rng.randint(0, 1)) for _ in range(400)]
    wins = total = 0.0
    for s, y in data:
        for s2, y2 in data:
            if y == 1 and y2 == 0:
                total += 1
                wins += 1.0 if s > s2 else 0.5 if s == s2 else 0.0
    df = spark.createDataFrame(data, "s double, y int")
    assert area_under_roc(df, "s", "y", slices=8).first()["auc"] == round(wins / total, 6)


def test_first_per_key_limits_before_shuffle(spark):
    df = spark.createDataFrame([(1, 5), (1, 9), (2, 3), (None, 4)], "k int, v int")
    got = W.first_per_key(df, ["k"], [F.desc("v")])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert values(got) == sorted([(1, 9), (2, 3), (None, 4)], key=repr)


def test_cut_strata_exact_for_hot_stratum(spark):
    rows = [(i, "hot" if i % 3 else None) for i in range(3000)] + [(5000, "rare")]
    df = spark.createDataFrame(rows, "id long, s string").repartition(4)
    parts = W.train_test_per_stratum(df, ["s"], ["id"], 1500, 1800, seed=4)
    got = Counter((r["s"], r["part"]) for r in parts.collect())
    assert got == {("hot", "train"): 1500, ("hot", "test"): 300, (None, "train"): 1000, ("rare", "train"): 1}
    again = W.train_test_per_stratum(df.repartition(3), ["s"], ["id"], 1500, 1800, seed=4)
    assert values(parts) == values(again)
    assert W.random_per_stratum(df, ["s"], ["id"], 0).count() == 0


def test_exact_stratified_and_splits(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") < 333, "a").otherwise("b").alias("s"))
    got = Z.exact_stratified(df, "s", {"a": 0.1, "zz": 0.5}, ["id"])
    assert values(got.groupBy("s").count()) == [("a", 34)] and got.columns == ["id", "s"]
    parts = Z.split_by_weight(df, [0.5, 0.3, 0.2], ["id"], seed=3)
    assert sum(p.count() for p in parts) == 1000
    union = parts[0].union(parts[1]).union(parts[2])
    assert union.distinct().count() == 1000


def test_keyed_with_replacement_mean(spark):
    df = spark.range(20000).select("id", F.lit("a").alias("s"))
    n = Z.keyed_with_replacement(df, "s", {"a": 1.5}, seed=1).count()
    assert abs(n - 30000) < 900
    assert Z.keyed_with_replacement(df, "s", {"b": 1.5}, seed=1).count() == 0
    # A mean at which exp(-mean) is no longer a normal double.
    counts = [r["count"] for r in Z.keyed_with_replacement(spark.range(300).select("id", F.lit("a").alias("s")), "s", {"a": 800}, seed=2).groupBy("id").count().collect()]
    mean = sum(counts) / len(counts)
    spread = sum((c - mean) ** 2 for c in counts) / len(counts)
    assert len(counts) == 300 and abs(mean - 800) < 8 and 500 < spread < 1200


def test_labels_are_balanced_beyond_a_thousand(spark):
    from dunlin.ml.features import balance_labels
    df = spark.range(40_000).select("id", F.least(F.col("id") % 3000, F.lit(1500)).alias("label"))
    sizes = [r["count"] for r in balance_labels(df, "label", ["id"], 1).groupBy("label").count().collect()]
    assert len(sizes) == 1501 and max(sizes) < 40


def test_strata_are_cut_in_one_last_pass(spark, tmp_path):
    spark.range(5000).select("id", (F.col("id") % 7).alias("s")).write.parquet(f"{tmp_path}/t")
    out = W.random_per_stratum(spark.read.parquet(f"{tmp_path}/t"), ["s"], ["id"], 10)
    assert out.count() == 70
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # The table itself and the stored cuts.
    assert plan.count("Relation") == 2 and "Window" not in plan


def brute_fill(points):
    known = [(i, v) for i, v in points if v is not None]
    out = []
    for i, v in points:
        before = [p for p in known if p[0] <= i]
        after = [p for p in known if p[0] >= i]
        if v is not None:
            out.append(v)
        elif before and after:
            (i0, v0), (i1, v1) = before[-1], after[0]
            out.append(v0 + (v1 - v0) / (i1 - i0) * (i - i0))
        else:
            out.append(None)
    return out


def test_linear_fill_in_stretches(spark):
    rng = random.Random(3)
    series = {k: [(i, rng.random() if rng.random() < 0.2 else None) for i in range(100)] for k in ("a", "b")}
    series["empty"] = [(i, None) for i in range(10)]
    rows = [(k, i, v) for k, points in series.items() for i, v in points]
    df = spark.createDataFrame(rows, "k string, pos int, value double")
    for span in (None, 7, 1000):
        got = {}
        for r in Y.fill_linear(df, "k", span=span).orderBy("k", "pos").collect():
            got.setdefault(r["k"], []).append(r["value"])
        for k, points in series.items():
            assert got[k] == pytest.approx(brute_fill(points))


def test_business_days(spark):
    days = [str(r["day"]) for r in Y.business_day_index(spark, "2024-01-05", "2024-01-09").orderBy("pos").collect()]
    assert days == ["2024-01-05", "2024-01-08", "2024-01-09"]
    obs = spark.createDataFrame([("a", "2024-01-06 10:00:00", 5.0), ("a", "2024-01-08 01:00:00", 1.0),
                                 ("a", "2024-01-08 02:00:00", 3.0)], "k string, ts string, v double")
    aligned = Y.align(obs.withColumn("ts", F.to_timestamp("ts")), "k", "ts", "v", "2024-01-05", "2024-01-09")
    assert [r["value"] for r in aligned.orderBy("pos").collect()] == [None, 2.0, None]


def test_merge_and_rename(spark):
    a = spark.createDataFrame([(1, "x")], "k int, name string")
    b = spark.createDataFrame([(1, "y"), (2, "z")], "k int, name string")
    assert R.merge_tables(a, b).count() == 0
    assert R.merge_tables(a, b, by=["k"]).columns == ["k", "name_x", "name_y"]
    assert R.merge_tables(a, b.toDF("q", "r"), product=True).count() == 2
    with pytest.raises(ValueError):
        R.merge_tables(a, b.toDF("q", "r"))
    with pytest.raises(ValueError):
        R.rename_columns(a, {"absent": "b"})


def test_running_totals_have_no_window_of_all_rows(spark):
    """A third of the rows are one value; ranges are summed on their own and the whole is in order."""
    draw = random.Random(5)
    weights = [draw.randrange(1, 5) for _ in range(3000)]
    df = spark.createDataFrame([(i, i % 7, w) for i, w in enumerate(weights)], "v long, x int, w long").repartition(5)
    rows = running_totals(df, ["v"], "w").orderBy("v").collect()
    total = 0
    for row, w in zip(rows, weights, strict=True):
        total += w
        assert row.upto == total
    plan = running_totals(df, ["v"], "w")._jdf.queryExecution().executedPlan().toString()
    for window in [line for line in plan.splitlines() if "Window [" in line]:
        # The one window without a partition is over the totals of the ranges.
        assert "#range" in window
    assert running_totals(df.limit(0), ["v"], "w").count() == 0


def test_label_codes_equal_the_fitted_indexer(spark):
    draw = random.Random(2)
    labels = ["hot"] * 2000 + [f"v{draw.randrange(800)}" for _ in range(3000)] + [None, ""]
    df = spark.createDataFrame([(v,) for v in labels], "v string")
    fitted = index_strings(df.where("v IS NOT NULL"), ["v"]).labels
    assert [r.label for r in label_codes(df, "v").orderBy("code").collect()] == fitted
    coded = code_labels(df, ["v"])
    assert coded.count() == len(labels) and coded.where("v IS NULL").first().vCat is None and coded.where("v = 'hot'").first().vCat == 0.0


def test_frequent_items_shuffle_only_their_candidates(spark):
    """Half of the rows are all different; what is shuffled stays within the counters of each task."""
    draw = random.Random(7)
    items = ["a"] * 4000 + ["b"] * 2500 + [None] * 2000 + [f"x{i}" for i in range(9000)] + ["c"] * 1700
    draw.shuffle(items)
    df = spark.createDataFrame([(v,) for v in items], "v string").repartition(6)
    counts = Counter(items)
    for support in (0.05, 0.1, 0.2, 1.0):
        want = sorted(((v, n) for v, n in counts.items() if n >= support * len(items)), key=repr)
        assert values(A.frequent_items(df, "v", support)) == want
    hashes = [pa.RecordBatch.from_arrays([pa.array([draw.choice([1, 2, draw.randrange(10**9)]) for _ in range(500)], pa.int64())], ["k"]) for _ in range(20)]
    summary = next(iter(A._summaries(hashes, 20))).to_pydict()
    exact = Counter(v for b in hashes for v in b.column(0).to_pylist())
    assert len(summary["key"]) <= 21 and summary["n"][0] == 10_000 and summary["error"][0] <= 10_000 // 21
    found = dict(zip(summary["key"][1:], summary["n"][1:]))
    assert all(n - summary["error"][0] <= found.get(v, 0) <= n for v, n in exact.items())
    doubles = spark.createDataFrame([(float("nan"),)] * 6 + [(0.0,), (-0.0,), (1.0,)], "v double")
    assert [(str(r.v), r.n) for r in A.frequent_items(doubles, "v", 0.5).collect()] == [("nan", 6)]
    assert A.frequent_items(df.limit(0), "v", 0.5).count() == 0
    with pytest.raises(ValueError):
        A.frequent_items(df, "v", 0)


def test_exact_quantiles_inside_one_wide_bracket(spark):
    """A coarse sketch leaves brackets that hold a large part of the table, with one hot value in them."""
    values_ = [i * 0.5 for i in range(4000)] + [777.25] * 3000
    df = spark.createDataFrame([(v,) for v in values_], "x double").repartition(7)
    ordered = sorted(values_)
    for p in (0.1, 0.33, 0.5, 0.9):
        assert A.exact_quantiles(df, "x", [p], accuracy=4).first()["value"] == ordered[-(-int(p * 100) * len(ordered) // 100) - 1]


def test_folds_do_not_depend_on_the_order_of_rows(spark):
    draw = random.Random(3)
    rows = [(i, draw.random(), draw.random()) for i in range(600)]
    df = L.assemble(spark.createDataFrame([(i, a, b, float(a + b > 1)) for i, a, b in rows], "id long, a double, b double, label double"), ["a", "b"])
    sizes = df.groupBy(fold_of(["id"], 3).alias("f")).count()
    assert values(sizes) == values(df.repartition(7, "a").orderBy("b").groupBy(fold_of(["id"], 3).alias("f")).count()) and sizes.count() == 3
    lr = LogisticRegression(maxIter=8, featuresCol="features")
    grid = {lr.regParam: [0.001, 0.5, 2.0]}
    metric = MulticlassClassificationEvaluator(metricName="accuracy")
    first, again = (cross_validate(lr, metric, grid, d, ["id"], folds=3) for d in (df, df.repartition(5, "b")))
    assert first.avgMetrics == pytest.approx(again.avgMetrics, abs=1e-9)
    assert first.bestModel.getRegParam() == again.bestModel.getRegParam()


def test_topic_vectors_count_words_once(spark):
    docs = spark.createDataFrame([(1, ["b", "a", "b"]), (2, ["c", "a", "b"]), (3, []), (4, ["d"])], "id int, kept array<string>")
    vectors, vocabulary = L.topic_vectors(docs, "kept", vocabulary=3)
    # Ties go to the smaller word; the perplexity is that of the model without a second pass.
    assert list(vocabulary.items()) == [("b", 3), ("a", 2), ("c", 1)]
    model = LDA(k=2, maxIter=2, seed=1).fit(vectors)
    assert log_perplexity(model.logLikelihood(vectors), vocabulary) == pytest.approx(model.logPerplexity(vectors))
