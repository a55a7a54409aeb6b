import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dunlin.llm import toxicity
from dunlin.llm.toxicity import drop_toxic, fit_ordinal, fit_toxicity, grade_of, score_toxicity
from tests.llm.common import ODD, docs_of, prose


def labelled(spark, n=400, seed=0):
    draw = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words = prose(1000 * seed + i, 40, 300).split()
        grade = draw.choice([0, 0, 0, 1, 2])
        for _ in range(grade * 2):
            words[draw.randrange(len(words))] = draw.choice(["mild", "rude"]) if grade == 1 else draw.choice(["vile", "awful"])
        texts.append(" ".join(words))
        labels.append((i, 0 if grade == 1 else 1, int(grade == 2)))
    return docs_of(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_grades_on_held_out_rows(spark):
    docs, labels = labelled(spark)
    model = fit_toxicity(docs, labels)
    assert (np.diff(model.cuts) > 0).all()
    new, truth = labelled(spark, seed=1)
    grades = {r.doc_id: r.g for r in truth.select("doc_id", grade_of().alias("g")).collect()}
    rows = score_toxicity(new, model).collect()
    hit = np.mean([r.toxic == (grades[r.doc_id] == 2) for r in rows])
    exact = np.mean([r.severity == grades[r.doc_id] for r in rows])
    most = max(np.bincount(list(grades.values()))) / len(rows)
    assert hit > 0.97 and exact > most + 0.2
    mean = [np.mean([r.expected_severity for r in rows if grades[r.doc_id] == g]) for g in range(3)]
    assert mean[0] < mean[1] < mean[2]


def test_real_labels_held_out(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = fit_toxicity(docs, labels.where("doc_id % 2 = 0"))
    rows = score_toxicity(docs.join(labels.where("doc_id % 2 = 1").select("doc_id", labels.toxic.alias("truth")), "doc_id"), model)
    truth = {r.doc_id: r.toxic for r in labels.where("doc_id % 2 = 1").collect()}
    got = [(r.toxic, truth[r.doc_id] == 1) for r in rows.collect()]
    caught = np.mean([a for a, b in got if b])
    false = np.mean([a for a, b in got if not b])
    # A few labelled rows hold no offensive word at all.
    assert caught > 0.85 and false < 0.005


def test_likelihood_is_at_its_peak():
    draw = np.random.default_rng(0)
    x = draw.integers(0, 2, (2000, 2)).astype(float)
    noise = draw.logistic(size=2000)
    grade = np.searchsorted([1.0, 3.0], x @ [2.0, -1.0] + noise)
    weights, cuts = fit_ordinal(x, grade, penalty=0.0)
    assert np.allclose(weights, [2.0, -1.0], atol=0.3) and np.allclose(cuts, [1.0, 3.0], atol=0.4)


def test_odd_rows(spark):
    docs, labels = labelled(spark)
    model = fit_toxicity(docs, labels)
    odd = docs_of(spark, [*ODD, "vile awful vile", "VILE, awful!"], [None, *range(1, len(ODD)), 3, 3])
    rows = score_toxicity(odd, model).collect()
    assert len(rows) == len(ODD) + 2 and sum(r.toxic for r in rows) == 2
    kept = drop_toxic(odd, model)
    assert kept.schema == odd.schema and kept.count() == len(ODD)
    assert score_toxicity(docs_of(spark, []), model).count() == 0 and drop_toxic(docs_of(spark, []), model).count() == 0


@pytest.mark.parametrize("rows", [[], [(1, 1, 0), (2, None, None), (None, 1, 1)]])
def test_without_toxic_labels_nothing_is_rejected(spark, rows):
    docs, _ = labelled(spark, 20)
    model = fit_toxicity(docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))
    assert not any(r.toxic for r in score_toxicity(docs, model).collect())


def test_sample_bound_and_repeats(spark):
    docs, labels = labelled(spark)
    one = fit_toxicity(docs, labels, rows=200)
    two = fit_toxicity(docs.repartition(7), labels.union(labels), rows=200)
    assert np.array_equal(one.slots, two.slots) and np.allclose(one.weights, two.weights)


def test_bound_counts_documents_and_one_row_of_each(spark, monkeypatch):
    docs, labels = labelled(spark)
    foreign = spark.range(10_000, 20_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    one, two = fit_toxicity(docs, labels, rows=200), fit_toxicity(docs, labels.union(foreign), rows=200)
    assert len(one.slots) and np.array_equal(one.slots, two.slots) and np.allclose(one.weights, two.weights)
    seen = []
    monkeypatch.setattr(toxicity, "fit_ordinal", lambda x, grade: seen.append(len(grade)) or fit_ordinal(x, grade))
    three = fit_toxicity(docs.union(docs).union(docs.withColumn("text", F.lit(None))), labels, rows=200)
    assert seen == [200] and len(three.slots)
