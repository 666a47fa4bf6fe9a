"""Hashed terms and the model as tables against pyspark.ml, and the certificate of a fit."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from forumlens.operators import hashed_terms, linear_model
from forumlens.operators.linear_model import Penalty

WORDS = ["a", "ab", "abc", "abcd", "abcde", "ö", "日本語", "naïve-é", "😀x", "", " ", "x" * 37, "ñandú", "Ωmega", "word"]


def test_buckets_equal_hashing_tf(spark):
    df = spark.createDataFrame([(i, [*WORDS[i:], *WORDS[: i // 2]]) for i in range(len(WORDS))] + [(99, []), (100, None)], "id int, words array<string>")
    for size in (1000, 1 << 18, 7):
        vectors = HashingTF(inputCol="words", outputCol="v", numFeatures=size).transform(df.filter("words is not null"))
        want = sorted((r["id"], int(i), int(x)) for r in vectors.collect() for i, x in zip(r["v"].indices, r["v"].values))
        got = sorted(tuple(r) for r in hashed_terms.hashed_terms(df, "id", F.col("words"), size).collect())
        assert got == want


def test_words_of_texts_are_not_hashed_by_the_expression(spark):
    """The expression is interpreted step by step; a table of texts has too many words for it."""
    df = spark.createDataFrame([(1, ["a", None, "a", "ö"])], "id int, words array<string>")
    found = hashed_terms.hashed_terms(df, "id", F.col("words"), 1 << 18)
    assert "conv(" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["tf"] for r in found.collect()) == [1, 2]


def test_collisions_are_counted(spark):
    vocabulary = spark.createDataFrame([(w, n + 1) for n, w in enumerate(WORDS)], "word string, total_count long")
    rows = hashed_terms.bucket_collisions(vocabulary, 3).collect()
    assert sum(r["words"] for r in rows) == len(WORDS)
    assert sum(r["total_count"] for r in rows) == sum(range(len(WORDS) + 1)) and len(rows) <= 3


@pytest.fixture(scope="module")
def data(spark):
    """Sparse features of 200 rows and three overlapping classes; one row has no terms, one feature is constant."""
    draw = np.random.default_rng(4)
    rows = []
    for i in range(200):
        label = i % 3
        vector = np.where(draw.random(12) < 0.4, draw.random(12) * 3, 0)
        vector[label] += draw.random() * 2
        vector[11] = 0
        rows.append((i, float(label), [float(x) for x in vector] if i else [0.0] * 12))
    from pyspark.ml.functions import array_to_vector

    df = spark.createDataFrame(rows, "id int, label double, v array<double>").withColumn("features", array_to_vector("v")).drop("v")
    df = df.repartition(3).cache()
    yield df
    df.unpersist()


def tables_of(spark, df, fitted, classes):
    model = linear_model.from_fitted(spark, fitted, [f"c{i}" for i in range(classes)])
    return model, linear_model.vector_terms(df, "id", "features"), df.select("id", F.col("label").cast("int").alias("class"))


@pytest.mark.parametrize("classes", [2, 3])
def test_probabilities_equal_transform(spark, data, classes):
    df = data.filter(F.col("label") < classes)
    fitted = LogisticRegression(maxIter=10, regParam=0.01, elasticNetParam=0.3).fit(df)
    model, terms, labels = tables_of(spark, df, fitted, classes)
    got = {r["id"]: r["probabilities"] for r in linear_model.probabilities(model, terms, labels).collect()}
    want = {r["id"]: r["p"] for r in fitted.transform(df).select("id", vector_to_array("probability").alias("p")).collect()}
    assert got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key], abs=1e-9)
    scored = linear_model.probabilities(model, terms, labels)
    ranked = linear_model.ranked_classes(model, scored, 2).filter("id = 4").orderBy("rank").collect()
    order = sorted(range(classes), key=lambda c: (-want[4][c], c))
    assert [r["name"] for r in ranked] == [f"c{c}" for c in order[:2]]
    assert linear_model.scored_classes(model, scored).count() == classes * len(want)


@pytest.mark.parametrize("classes, reg, alpha", [(2, 0.01, 0.0), (2, 0.05, 0.5), (3, 0.02, 0.3), (3, 0.1, 1.0), (3, 0.05, 0.0)])
def test_a_converged_fit_is_certified_and_a_cut_one_is_not(spark, data, classes, reg, alpha):
    df = data.filter(F.col("label") < classes)
    penalty = Penalty(reg, alpha)
    gaps, losses = [], []
    for rounds in (500, 1):
        fitted = LogisticRegression(maxIter=rounds, regParam=reg, elasticNetParam=alpha, tol=1e-12).fit(df)
        model, terms, labels = tables_of(spark, df, fitted, classes)
        found = linear_model.certificate(model, terms, labels, penalty).first()
        gaps.append(found["largest_gap"])
        losses.append(linear_model.penalised_loss(model, terms, labels, penalty).first()["loss"])
        assert losses[-1] == pytest.approx(fitted.summary.objectiveHistory[-1], abs=1e-6)
    assert gaps[0] < 1e-4 < 1e-3 < gaps[1] and losses[0] < losses[1]


def test_gradient_equals_differences_of_the_loss(spark, data):
    """Of the smooth part, by small steps of a scaled coefficient."""
    fitted = LogisticRegression(maxIter=3, regParam=0.1).fit(data)
    model, terms, labels = tables_of(spark, data, fitted, 3)
    penalty, step = Penalty(0.1, 0.0), 1e-5
    gradient = {(r["feature"], r["class"]): r["gradient"] for r in linear_model.loss_gradient(model, terms, labels, penalty).collect()}
    scales = dict(linear_model.feature_scales(terms, 200).collect())
    assert set(scales) == set(range(11))
    for feature, cls in ((2, 1), (5, 0)):
        losses = []
        for sign in (1, -1):
            moved = F.col("coefficient") + F.when((F.col("feature") == feature) & (F.col("class") == cls), sign * step / scales[feature]).otherwise(0.0)
            other = linear_model.LinearModel(model.coefficients.withColumn("coefficient", moved), model.intercepts)
            losses.append(linear_model.penalised_loss(other, terms, labels, penalty).first()["loss"])
        assert gradient[feature, cls] == pytest.approx((losses[0] - losses[1]) / (2 * step), abs=1e-5)
