"""Plans for feature stages, models and evaluation."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import feature as ft
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.clustering import LDA, GaussianMixture, KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.stat import KolmogorovSmirnovTest
from pyspark.sql import functions as F

from dunlin.ml import features as L
from dunlin.ml import models as N
from dunlin.operators.ranks import code_labels
from dunlin.operators.sampling import split_by_weight
from dunlin.plans.registry import Tables, plan
from dunlin.session import discard, materialize, scratch_path


def rows(name: str = "n"):
    return F.count(F.lit(1)).alias(name)


# ------------------------------------------------------------- feature stages


@plan("L01_string_indexer", """
    SELECT p_type, p_brand, a::DOUBLE AS "p_typeCat", b::DOUBLE AS "p_brandCat", n FROM (SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY 1, 2)
    JOIN (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS a FROM part GROUP BY 1) USING (p_type)
    JOIN (SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS b FROM part GROUP BY 1) USING (p_brand)""")
def _(t: Tables):
    coded = code_labels(t.part.select("p_type", "p_brand"), ["p_type", "p_brand"])
    return coded.groupBy("p_type", "p_brand", "p_typeCat", "p_brandCat").agg(rows())


@plan("L02_index_to_string", "SELECT o_orderstatus, o_orderstatus AS back, count(*) AS n FROM orders GROUP BY 1")
def _(t: Tables):
    orders = t.orders.select("o_orderstatus")
    model = L.index_strings(orders, ["o_orderstatus"])
    back = L.labels_back(model.transform(orders), "o_orderstatusCat", model.labels, "back")
    return back.groupBy("o_orderstatus", "back").agg(rows())


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@plan("L03_vector_assembler", """
    SELECT round(sum(l_quantity), 2) AS s0, round(sum(l_extendedprice), 2) AS s1, round(sum(l_discount), 2) AS s2, round(sum(l_tax), 2) AS s3 FROM lineitem""")
def _(t: Tables):
    vectors = L.assemble(t.lineitem.select(*_NUM), _NUM).select(vector_to_array("features").alias("f"))
    return vectors.agg(*[F.round(F.sum(F.get("f", F.lit(i))), 2).alias(f"s{i}") for i in range(4)])


@plan("L04_vector_indexer", """
    SELECT slot, k AS categories FROM (SELECT 0 AS slot, count(DISTINCT l_linenumber)::INTEGER AS k FROM lineitem
      UNION ALL SELECT 1, count(DISTINCT l_quantity)::INTEGER FROM lineitem UNION ALL SELECT 2, count(DISTINCT l_discount)::INTEGER FROM lineitem) WHERE k <= 12""")
def _(t: Tables):
    vectors = L.assemble(t.lineitem.select("l_linenumber", "l_quantity", "l_discount"), ["l_linenumber", "l_quantity", "l_discount"])
    maps = L.index_vector(vectors, "features", "indexed", 12).categoryMaps
    return t.spark.createDataFrame([(k, len(v)) for k, v in maps.items()], "slot int, categories int")


@plan("L05_one_hot", """
    SELECT c_mktsegment, CASE WHEN i = (SELECT count(DISTINCT c_mktsegment) FROM customer) - 1 THEN 0 ELSE i + 1 END::BIGINT AS slot, n FROM
      (SELECT c_mktsegment, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS i, count(*) AS n FROM customer GROUP BY 1)""")
def _(t: Tables):
    customers = t.customer.select("c_mktsegment")
    coded = L.one_hot(L.index_strings(customers, ["c_mktsegment"]).transform(customers), "c_mktsegmentCat", "hot")
    slot = F.array_position(vector_to_array("hot"), F.lit(1.0))
    return coded.groupBy("c_mktsegment", slot.alias("slot")).agg(rows())


@plan("L06_bucketizer", """
    SELECT CASE WHEN l_quantity < 10 THEN 0 WHEN l_quantity < 20 THEN 1 WHEN l_quantity < 40 THEN 2 ELSE 3 END::DOUBLE AS bucket, count(*) AS n FROM lineitem GROUP BY 1""")
def _(t: Tables):
    return L.bucketize(t.lineitem.select("l_quantity"), "l_quantity", "bucket", [10, 20, 40]).groupBy("bucket").agg(rows())


@plan("L07_vector_slicer", "SELECT round(sum(l_tax), 2) AS tax, round(sum(l_quantity), 2) AS qty FROM lineitem")
def _(t: Tables):
    vectors = L.assemble(t.lineitem.select(*_NUM), _NUM)
    sliced = ft.VectorSlicer(inputCol="features", outputCol="s", names=["l_tax", "l_quantity"]).transform(vectors)
    return sliced.select(vector_to_array("s").alias("s")).agg(
        F.round(F.sum(F.get("s", F.lit(0))), 2).alias("tax"), F.round(F.sum(F.get("s", F.lit(1))), 2).alias("qty"))


_CHI = " UNION ALL ".join(f"""SELECT {i} AS slot, (SELECT sum((coalesce(o.n, 0) - r.n * c.n / t.n) * (coalesce(o.n, 0) - r.n * c.n / t.n) / (r.n * c.n / t.n))
    FROM (SELECT {f} AS f, count(*)::DOUBLE AS n FROM x GROUP BY 1) r CROSS JOIN (SELECT label, count(*)::DOUBLE AS n FROM x GROUP BY 1) c CROSS JOIN (SELECT count(*)::DOUBLE AS n FROM x) t
    LEFT JOIN (SELECT {f} AS f, label, count(*)::DOUBLE AS n FROM x GROUP BY 1, 2) o ON o.f = r.f AND o.label = c.label) AS chi""" for i, f in enumerate(["a", "b", "c"]))


@plan("L08_chi_squared_selector", f"""WITH x AS (SELECT l_linenumber AS a, floor(l_quantity / 10) AS b, floor(l_tax * 100 + 0.5) AS c,
      CASE WHEN l_extendedprice > 50000 THEN 1 ELSE 0 END AS label FROM lineitem)
    SELECT slot FROM ({_CHI}) ORDER BY chi DESC LIMIT 1""")
def _(t: Tables):
    rows_ = t.lineitem.select(F.col("l_linenumber").alias("a"), F.floor(F.col("l_quantity") / 10).alias("b"),
                              F.floor(F.col("l_tax") * 100 + 0.5).alias("c"),
                              F.when(F.col("l_extendedprice") > 50000, 1.0).otherwise(0.0).alias("label"))
    model = L.best_categorical(L.assemble(rows_, ["a", "b", "c"]), "features", "label", "best", 1)
    return t.spark.createDataFrame([(int(i),) for i in model.selectedFeatures], "slot int")


@plan("L09_pca", "SELECT count(*) AS n, true AS falling, true AS unit_axes FROM embeddings")
def _(t: Tables):
    vectors = t.embeddings.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    model = ft.PCA(k=3, inputCol="features", outputCol="p").fit(vectors)
    variance, axes = model.explainedVariance.toArray(), model.pc.toArray()
    falling = bool(all(a >= b for a, b in zip(variance, variance[1:])))
    unit = bool(abs(axes.T @ axes - [[1, 0, 0], [0, 1, 0], [0, 0, 1]]).max() < 1e-8)
    return model.transform(vectors).where(F.size(vector_to_array("p")) == 3).agg(
        rows(), F.lit(falling).alias("falling"), F.lit(unit).alias("unit_axes"))


@plan("L10_scalers", """
    SELECT count(*) AS n, true AS unit_norms, CAST(sum(CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END) AS BIGINT) AS high, 0.0::DOUBLE AS mean, 1.0::DOUBLE AS std FROM lineitem""")
def _(t: Tables):
    vectors = L.assemble(t.lineitem.select("l_quantity", "l_extendedprice"), ["l_quantity", "l_extendedprice"])
    scaled = ft.StandardScaler(inputCol="features", outputCol="z", withMean=True, withStd=True).fit(vectors).transform(vectors)
    both = ft.Binarizer(inputCol="l_quantity", outputCol="bin", threshold=25.0).transform(
        ft.Normalizer(inputCol="features", outputCol="u").transform(scaled))
    spread = both.select("bin", vector_to_array("u").alias("u"), F.get(vector_to_array("z"), F.lit(1)).alias("z"))
    norm = F.sqrt(F.aggregate("u", F.lit(0.0), lambda a, x: a + x * x))
    return spread.agg(rows(), (F.max(F.abs(norm - 1)) < 1e-9).alias("unit_norms"), F.sum("bin").cast("long").alias("high"),
                      F.abs(F.round(F.avg("z"), 6)).alias("mean"), F.round(F.stddev_samp("z"), 6).alias("std"))


_TOK = "regexp_extract_all(lower(text), '[a-z'']+')"
_STOPS = ["the", "and", "of", "la", "le", "de", "der", "die"]
_KEPT = f"list_filter({_TOK}, lambda w: w NOT IN ({', '.join(repr(w) for w in _STOPS)}))"


def _tokens(t: Tables):
    return ft.RegexTokenizer(inputCol="text", outputCol="tokens", pattern="[a-zA-Z']+", gaps=False).transform(
        t.spread("documents").select("doc_id", "text")).drop("text")


def _kept(t: Tables):
    return ft.StopWordsRemover(inputCol="tokens", outputCol="kept", stopWords=_STOPS).transform(_tokens(t))


@plan("L11_regex_tokenizer", f"SELECT doc_id, CAST(len(t) AS INTEGER) AS n, t[1] AS first, t[-1] AS last FROM (SELECT doc_id, {_TOK} AS t FROM documents)")
def _(t: Tables):
    tokens = F.col("tokens")
    return _tokens(t).select("doc_id", F.size(tokens).alias("n"), F.get(tokens, F.lit(0)).alias("first"),
                             F.try_element_at(tokens, F.lit(-1)).alias("last"))


@plan("L11_gap_tokenizer", "SELECT doc_id, CAST(len(list_filter(string_split_regex(lower(text), '[^a-z0-9_]'), lambda w: w <> '')) AS INTEGER) AS n FROM documents")
def _(t: Tables):
    model = ft.RegexTokenizer(inputCol="text", outputCol="tokens", pattern=r"\W")
    return model.transform(t.spread("documents").select("doc_id", "text")).select("doc_id", F.size("tokens").alias("n"))


@plan("L12_stop_words_remover", f"SELECT doc_id, CAST(len({_KEPT}) AS INTEGER) AS n FROM documents")
def _(t: Tables):
    return _kept(t).select("doc_id", F.size("kept").alias("n"))


@plan("L13_ngram", f"""
    SELECT doc_id, greatest(len(k) - 1, 0)::INTEGER AS n2, greatest(len(k) - 2, 0)::INTEGER AS n3,
      CASE WHEN len(k) > 1 THEN concat(k[1], ' ', k[2]) END AS first2, CASE WHEN len(k) > 2 THEN concat(k[-3], ' ', k[-2], ' ', k[-1]) END AS last3
    FROM (SELECT doc_id, {_KEPT} AS k FROM documents)""")
def _(t: Tables):
    grams = _kept(t)
    for n in (2, 3):
        grams = ft.NGram(n=n, inputCol="kept", outputCol=f"g{n}").transform(grams)
    return grams.select("doc_id", F.size("g2").alias("n2"), F.size("g3").alias("n3"),
                        F.get("g2", F.lit(0)).alias("first2"), F.try_element_at("g3", F.lit(-1)).alias("last3"))


@plan("L14_hashing_tf", f"SELECT doc_id, CAST(len({_TOK}) AS DOUBLE) AS total FROM documents")
def _(t: Tables):
    hashed = ft.HashingTF(inputCol="tokens", outputCol="tf", numFeatures=4096).transform(_tokens(t))
    total = F.aggregate(vector_to_array("tf"), F.lit(0.0), lambda a, x: a + x)
    return hashed.select("doc_id", total.alias("total"))


@plan("L15_count_vectorizer", f"SELECT w AS term, count(*)::DOUBLE AS n FROM (SELECT unnest({_TOK}) AS w FROM documents) GROUP BY 1 ORDER BY n DESC, w LIMIT 15")
def _(t: Tables):
    tokens = _tokens(t)
    model = ft.CountVectorizer(inputCol="tokens", outputCol="tf", vocabSize=15).fit(tokens)
    terms = t.spark.createDataFrame(list(enumerate(model.vocabulary)), "i int, term string")
    totals = model.transform(tokens).select(F.posexplode(vector_to_array("tf")).alias("i", "x")).groupBy("i").agg(F.sum("x").alias("n"))
    return totals.join(terms, "i").select("term", "n")


# --------------------------------------------------------------------- models


def _lines(t: Tables):
    """Line items with a label their features explain."""
    label = (F.col("l_extendedprice") * (1 - F.col("l_discount")) > 50000).cast("double")
    data = t.spread("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", *_NUM, "l_shipdate", label.alias("label"))
    vectors = L.assemble(data, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return split_by_weight(vectors, [0.8, 0.2], ["l_orderkey", "l_partkey", "l_linenumber"], seed=11)


def _beats_majority(predicted):
    """One row: is the accuracy above the share of the larger class?"""
    share = F.avg("label")
    return predicted.agg(
        (F.avg((F.col("label") == F.col("prediction")).cast("double")) > F.greatest(share, 1 - share)).alias("beats_majority"))


_BEATS = "SELECT true AS beats_majority"


@plan("N01_random_forest", _BEATS)
def _(t: Tables):
    train, test = _lines(t)
    return _beats_majority(RandomForestClassifier(numTrees=10, maxDepth=5, seed=1).fit(train).transform(test))


@plan("N01_forest_importances", "SELECT 4::BIGINT AS slots, 1.0::DOUBLE AS total, true AS trees_printed")
def _(t: Tables):
    train, _ = _lines(t)
    model = RandomForestClassifier(numTrees=5, maxDepth=4, seed=1).fit(train)
    weights = t.spark.createDataFrame([(i, float(w)) for i, w in enumerate(model.featureImportances.toArray())], "i int, w double")
    return weights.agg(rows("slots"), F.round(F.sum("w"), 6).alias("total"), F.lit("Tree" in model.toDebugString).alias("trees_printed"))


@plan("N02_decision_tree", _BEATS)
def _(t: Tables):
    train, test = _lines(t)
    return _beats_majority(DecisionTreeClassifier(maxDepth=5).fit(train).transform(test))


@plan("N02_boosted_trees", _BEATS)
def _(t: Tables):
    train, test = _lines(t)
    return _beats_majority(GBTClassifier(maxIter=5, maxDepth=3, seed=1).fit(train).transform(test))


@plan("N03_logistic_regression", _BEATS)
def _(t: Tables):
    train, test = _lines(t)
    return _beats_majority(LogisticRegression(maxIter=10, regParam=0.01, elasticNetParam=0.8).fit(train).transform(test))


def _vectors(t: Tables):
    return t.embeddings.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
                               F.col("label").cast("double").alias("label"))


@plan("N03_multinomial_logistic", "SELECT count(*) AS n, true AS recomputed, true AS highest_wins FROM embeddings")
def _(t: Tables):
    data = _vectors(t)
    model = LogisticRegression(family="multinomial", maxIter=10).fit(data)
    # The scores again, from the stored weights.
    margins = N.class_margins("features", model.coefficientMatrix.toArray().tolist(), model.interceptVector.toArray().tolist())
    out = model.transform(data).withColumn("own", N.softmax(margins)).withColumn("given", vector_to_array("probability"))
    gap = F.array_max(F.zip_with("own", "given", lambda a, b: F.abs(a - b)))
    best = F.element_at("own", (F.col("prediction") + 1).cast("int")) >= F.array_max("own") - 1e-9
    return out.agg(rows(), (F.max(gap) < 1e-6).alias("recomputed"), F.bool_and(best).alias("highest_wins"))


@plan("N04_naive_bayes", """
    SELECT quality, round(ln((count(*) + 1) / ((SELECT count(*) FROM documents JOIN labels USING (doc_id)) + count(*) OVER () * 1.0)), 6) AS log_prior,
           true AS terms_sum_to_one FROM documents JOIN labels USING (doc_id) GROUP BY quality""")
def _(t: Tables):
    data = t.spread("documents").select("doc_id", "text").join(t.labels, "doc_id").select("text", F.col("quality").cast("double").alias("label"))
    model = Pipeline(stages=L.token_stages("text") + [NaiveBayes(modelType="multinomial", smoothing=1.0)]).fit(data).stages[-1]
    # Priors are the smoothed label shares; term chances of a class sum to one.
    sums = np.exp(model.theta.toArray()).sum(axis=1)
    found = [(k, float(p), bool(abs(s - 1) < 1e-6)) for k, (p, s) in enumerate(zip(model.pi.toArray(), sums))]
    return t.spark.createDataFrame(found, "quality int, log_prior double, terms_sum_to_one boolean").withColumn("log_prior", F.round("log_prior", 6))


@plan("N05_glm_gaussian", """
    SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept FROM lineitem""")
def _(t: Tables):
    data = L.assemble(t.spread("lineitem").select("l_quantity", F.col("l_extendedprice").alias("label")), ["l_quantity"])
    model = GeneralizedLinearRegression(family="gaussian", regParam=0.0, maxIter=25, tol=1e-6).fit(data)
    return t.spark.createDataFrame([(model.coefficients[0].item(), float(model.intercept))], "slope double, intercept double").select(
        F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"))


@plan("X07_models_over_parameter_list", "SELECT unnest(['gaussian', 'poisson']) AS family, true AS converged")
def _(t: Tables):
    data = L.assemble(t.spread("lineitem").select("l_tax", "l_discount", F.col("l_quantity").alias("label")), ["l_tax", "l_discount"]).cache()
    try:
        return N.fit_family(
            ["gaussian", "poisson"], lambda f: GeneralizedLinearRegression(family=f, maxIter=50, regParam=0.1).fit(data),
            lambda f, m: (f, m.summary.numIterations < m.getMaxIter()), t.spark, "family string, converged boolean")
    finally:
        data.unpersist()


@plan("N06_kmeans", "SELECT count(*) AS n, true AS cost_agrees, 5::BIGINT AS clusters FROM embeddings")
def _(t: Tables):
    data = _vectors(t)
    model = KMeans(k=5, seed=1, maxIter=15).fit(data)
    placed = N.distance_to_centre(model.transform(data), [c.tolist() for c in model.clusterCenters()])
    # The stored cost belongs to the centres before the last update, which can only lower it.
    cost, stored = F.sum(F.col("distance") * F.col("distance")), model.summary.trainingCost
    return placed.agg(rows(), ((cost <= stored * (1 + 1e-9)) & (cost > 0.9 * stored)).alias("cost_agrees"),
                      F.countDistinct("prediction").alias("clusters"))


@plan("N06_kmeans_label_mismatch", "SELECT count(*) AS n, true AS nearest_chosen, true AS mismatch_agrees FROM embeddings")
def _(t: Tables):
    data = _vectors(t)
    model = KMeans(k=5, seed=1, maxIter=15).fit(data)
    centres = [c.tolist() for c in model.clusterCenters()]
    placed = N.distance_to_centre(model.transform(data), centres)
    # Half the squared length less the product orders centres as the distance does.
    offsets = [-sum(x * x for x in c) / 2 for c in centres]
    score = N.class_margins("features", centres, offsets)
    chosen = F.element_at("score", F.col("prediction") + 1) >= F.array_max("score") - 1e-6
    summary = N.cluster_summary(placed, "prediction", "label")
    mismatch = summary.agg(F.sum("mismatch")).scalar()
    sizes = summary.agg(F.sum("n")).scalar()
    major = placed.groupBy("prediction", "label").agg(rows("m")).groupBy("prediction").agg(F.max("m").alias("m")).agg(F.sum("m")).scalar()
    return placed.withColumn("score", score).agg(rows(), F.bool_and(chosen).alias("nearest_chosen")).withColumn(
        "mismatch_agrees", (mismatch == F.col("n") - major) & (sizes == F.col("n")))


@plan("N07_outliers", "SELECT count(*) AS n, true AS share_ok FROM embeddings")
def _(t: Tables):
    data = _vectors(t)
    model = KMeans(k=2, seed=1, maxIter=20).fit(data)
    placed = N.distance_to_centre(model.transform(data), [c.tolist() for c in model.clusterCenters()])
    return N.flag_outliers(placed, "distance", 0.02).agg(
        rows(), F.avg(F.col("outlier").cast("int")).between(0.005, 0.035).alias("share_ok"))


@plan("N08_gaussian_mixture", "SELECT count(*) AS n, true AS weights_recur, true AS likeliest_chosen FROM lineitem")
def _(t: Tables):
    train = L.assemble(t.spread("lineitem").select("l_quantity", "l_discount", "l_tax"), ["l_quantity", "l_discount", "l_tax"])
    model = GaussianMixture(k=2, seed=3, maxIter=10).fit(train)
    # A component's weight is the mean of its posteriors, up to the last step of the fit.
    out = model.transform(train).withColumn("p", vector_to_array("probability"))
    recur = F.lit(True)
    for k, weight in enumerate(model.weights):
        recur = recur & (F.abs(F.avg(F.get("p", F.lit(k))) - weight) < 0.02)
    likeliest = F.get("p", F.col("prediction")) >= F.array_max("p")
    return out.agg(rows(), recur.alias("weights_recur"), F.bool_and(likeliest).alias("likeliest_chosen"))


def _topics(t: Tables):
    kept = materialize(_kept(t).select("doc_id", "kept"), "kept")
    counted, vocabulary = L.topic_vectors(kept, "kept")
    vectors = materialize(counted.select("doc_id", "features"), "lda")
    discard(kept)
    return LDA(k=4, maxIter=5, seed=7).fit(vectors), vocabulary, vectors


@plan("N09_lda_topics", "SELECT 12::BIGINT AS terms, 4::BIGINT AS topics, true AS fit_ok")
def _(t: Tables):
    model, vocabulary, vectors = _topics(t)
    # The perplexity is worked out from the likelihood: each is a pass of inference over all documents.
    likelihood = model.logLikelihood(vectors)
    fit_ok = likelihood < 0 < N.log_perplexity(likelihood, vocabulary)
    return N.topic_terms(model, list(vocabulary), 3).agg(rows("terms"), F.countDistinct("topic").alias("topics"), F.lit(fit_ok).alias("fit_ok"))


@plan("N09_lda_document_mix", "SELECT count(*) AS n, true AS sums_to_one FROM documents")
def _(t: Tables):
    model, _, vectors = _topics(t)
    total = F.aggregate(vector_to_array("topicDistribution"), F.lit(0.0), lambda a, x: a + x)
    # A document without any kept word has an all-zero mix.
    return model.transform(vectors).agg(rows(), (F.max(F.least(F.abs(total - 1), F.abs(total))) < 1e-6).alias("sums_to_one"))


@plan("N10_kolmogorov_smirnov", """
    WITH s AS (SELECT (c_acctbal - 4500.0) / 3000.0 AS z, row_number() OVER (ORDER BY c_acctbal) AS i, count(*) OVER () AS n FROM customer),
         x AS (SELECT *, abs(z) / sqrt(2.0) AS a, 1.0 / (1.0 + 0.3275911 * abs(z) / sqrt(2.0)) AS k FROM s),
         e AS (SELECT *, 1 - (((((1.061405429 * k - 1.453152027) * k) + 1.421413741) * k - 0.284496736) * k + 0.254829592) * k * exp(-a * a) AS erf FROM x),
         c AS (SELECT i, n, 0.5 * (1 + sign(z) * erf) AS p FROM e)
    SELECT round(max(greatest(p - (i - 1)::DOUBLE / n, i::DOUBLE / n - p)), 4) AS statistic FROM c""")
def _(t: Tables):
    row = KolmogorovSmirnovTest.test(t.customer.select("c_acctbal"), "c_acctbal", "norm", 4500.0, 3000.0)
    return row.select(F.round("statistic", 4).alias("statistic"))


@plan("N11_multilayer_net", "SELECT count(*) AS n, true AS recomputed, true AS highest_wins FROM embeddings")
def _(t: Tables):
    data = _vectors(t)
    k = int(t.embeddings.agg(F.max("label")).first()[0]) + 1
    net = MultilayerPerceptronClassifier(layers=[64, 16, k], maxIter=20, blockSize=12, seed=4).fit(data)
    # The chances again, layer by layer from the stored weights; each layer's offsets follow its weights.
    flat, at, layers = net.weights.toArray(), 0, []
    for size, out in ((64, 16), (16, k)):
        layers.append((flat[at:at + size * out].reshape(size, out).T.tolist(), flat[at + size * out:at + size * out + out].tolist()))
        at += (size + 1) * out
    hidden = F.transform(N.class_margins("features", *layers[0]), lambda x: 1 / (1 + F.exp(-x)))
    scored = net.transform(data).withColumn("hidden", hidden)
    scored = scored.withColumn("own", N.softmax(N.class_margins("hidden", *layers[1], is_array=True))).withColumn("given", vector_to_array("probability"))
    gap = F.array_max(F.zip_with("own", "given", lambda a, b: F.abs(a - b)))
    best = F.element_at("own", (F.col("prediction") + 1).cast("int")) >= F.array_max("own") - 1e-9
    return scored.agg(rows(), (F.max(gap) < 1e-6).alias("recomputed"), F.bool_and(best).alias("highest_wins"))


@plan("N12_top_k_accuracy", """
    WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
         c AS (SELECT label AS k, i, avg(x) AS m FROM x GROUP BY 1, 2),
         s AS (SELECT vec_id, label, k, sum(x * m) AS score FROM x JOIN c USING (i) GROUP BY 1, 2, 3),
         r AS (SELECT vec_id, score AS own FROM s WHERE k = label),
         a AS (SELECT vec_id, count(*) FILTER (score > own + 1e-12) + 1 AS rank, ln(sum(exp(score))) - any_value(own) AS loss FROM s JOIN r USING (vec_id) GROUP BY 1)
    SELECT round(avg((rank <= 1)::INTEGER), 6) AS top1, round(avg((rank <= 5)::INTEGER), 6) AS top5, round(avg(loss), 6) AS loss, count(*) AS n FROM a""")
def _(t: Tables):
    # One score per class: the product with the class's mean vector, all elements of both.
    each = t.embeddings.select("label", F.posexplode("embedding").alias("i", "x"))
    means = each.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    centres = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("c")).orderBy("label").collect()  # one row per class
    scored = t.embeddings.select("label", N.class_margins("embedding", [[p["m"] for p in r["c"]] for r in centres], [0.0] * len(centres), is_array=True).alias("scores"))
    return N.top_k_accuracy(scored, "scores", "label", [1, 5])


_SCORED = "SELECT l_quantity AS score, CASE WHEN l_extendedprice > 50000 THEN 1 ELSE 0 END AS label, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS prediction FROM lineitem"


def _scored(t: Tables):
    return t.lineitem.select(F.col("l_quantity").alias("score"), F.when(F.col("l_extendedprice") > 50000, 1).otherwise(0).alias("label"),
                             F.when(F.col("l_quantity") > 25, 1).otherwise(0).alias("prediction"))


@plan("N13_accuracy_error", f"SELECT round(avg((label = prediction)::INTEGER), 6) AS accuracy, round(1 - avg((label = prediction)::INTEGER), 6) AS error FROM ({_SCORED})")
def _(t: Tables):
    return N.accuracy(_scored(t), "label", "prediction")


@plan("N13_area_under_roc", f"""
    WITH g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM ({_SCORED}) GROUP BY 1),
         c AS (SELECT pos, neg, sum(neg) OVER (ORDER BY score) - neg AS below FROM g)
    SELECT round((sum(pos * (below + neg / 2.0::DOUBLE)) / sum(pos) / sum(neg))::DOUBLE, 6) AS auc, true AS evaluator_agrees FROM c""")
def _(t: Tables):
    scored = _scored(t)
    raw = scored.select(F.col("score").alias("rawPrediction"), F.col("label").cast("double").alias("label"))
    curve = BinaryClassificationEvaluator(numBins=0).evaluate(raw)
    return N.area_under_roc(scored, "score", "label").withColumn("evaluator_agrees", F.abs(F.col("auc") - curve) < 1e-5)


@plan("N14_confusion", f"SELECT label, prediction, count(*) AS n FROM ({_SCORED}) GROUP BY 1, 2")
def _(t: Tables):
    return N.confusion(_scored(t), "label", "prediction")


@plan("N15_stages_fit_transform", "SELECT count(*) AS n, 'StringIndexerModel,VectorIndexerModel,DecisionTreeClassificationModel,IndexToString' AS stages, 0::BIGINT AS unknown FROM customer")
def _(t: Tables):
    data = L.assemble(t.customer.select("c_nationkey", "c_acctbal", "c_mktsegment"), ["c_nationkey", "c_acctbal"])
    indexer = ft.StringIndexer(inputCol="c_mktsegment", outputCol="indexedLabel").fit(data)
    model = Pipeline(stages=[
        indexer, ft.VectorIndexer(inputCol="features", outputCol="indexedFeatures", maxCategories=30),
        DecisionTreeClassifier(labelCol="indexedLabel", featuresCol="indexedFeatures", maxDepth=3),
        ft.IndexToString(inputCol="prediction", outputCol="predictedLabel", labels=indexer.labels)]).fit(data)
    return model.transform(data).agg(rows(), F.lit(",".join(L.stage_names(model))).alias("stages"),
                                     F.count_if(~F.col("predictedLabel").isin(list(indexer.labels))).alias("unknown"))


@plan("N16_cross_validation", "SELECT true AS beats_majority, 2 AS candidates")
def _(t: Tables):
    train, test = _lines(t)
    lr = LogisticRegression(maxIter=5)
    tuned = N.cross_validate(lr, MulticlassClassificationEvaluator(metricName="accuracy"), {lr.regParam: [0.01, 0.3]}, train, ["l_orderkey", "l_linenumber"])
    return _beats_majority(tuned.transform(test)).withColumn("candidates", F.lit(len(tuned.avgMetrics)))


@plan("N17_save_load_score", "SELECT count(*) AS n, 0::BIGINT AS different, true AS weights_stored FROM embeddings")
def _(t: Tables):
    data, path = _vectors(t), scratch_path(t.spark, "n17")
    model = Pipeline(stages=[LogisticRegression(maxIter=3)]).fit(data)
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    stored = t.spark.read.parquet(f"{path}/stages/*/data")
    stored.write.mode("overwrite").json(f"{path}-json")
    kept = t.spark.read.json(f"{path}-json").columns
    a = model.transform(data).select("vec_id", F.col("prediction").alias("a"))
    b = loaded.transform(data).select("vec_id", F.col("prediction").alias("b"))
    return a.join(b, "vec_id").agg(rows(), F.count_if(F.col("a") != F.col("b")).alias("different"),
                                   F.lit("coefficientMatrix" in kept).alias("weights_stored"))


@plan("N18_label_balance", "SELECT true AS balanced, count(DISTINCT o_orderpriority) AS labels FROM orders")
def _(t: Tables):
    skewed = t.orders.select("o_orderkey", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority"))
                             .otherwise("other").alias("label"), "o_orderpriority")
    sizes = L.balance_labels(skewed, "label", ["o_orderkey"], 5).groupBy("label").agg(rows())
    n = skewed.agg(F.countDistinct("o_orderpriority")).scalar()
    return sizes.agg((F.max("n") < 1.2 * F.min("n")).alias("balanced"), n.alias("labels"))
