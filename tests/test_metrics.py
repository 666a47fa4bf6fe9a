import math
import random

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator

from forumlens.operators import metrics


def predictions(spark, classes):
    chance = random.Random(classes)
    rows = [
        (float(label), float(label if chance.random() < 0.6 else chance.randrange(classes)))
        for label in (chance.randrange(classes) for _ in range(400))
    ]
    return spark.createDataFrame(rows, "label double, prediction double")


def test_relational_metrics_equal_the_evaluators(spark):
    for classes in (2, 5):
        df = predictions(spark, classes)
        got = metrics.summary(metrics.confusion_matrix(df)).first()
        score = lambda name: MulticlassClassificationEvaluator(metricName=name).evaluate(df)
        assert got["rows"] == 400
        assert math.isclose(got["accuracy"], score("accuracy"))
        assert math.isclose(got["weighted_f1"], score("f1"))
        if classes == 2:
            hard = BinaryClassificationEvaluator(rawPredictionCol="prediction").evaluate(df)
            assert math.isclose(got["balanced_accuracy"], hard)


def test_area_under_roc_equals_the_evaluator(spark):
    chance = random.Random(8)
    rows = [(float(label), float(chance.randrange(12) + 3 * label)) for label in (chance.randrange(2) for _ in range(500))]
    df = spark.createDataFrame(rows, "label double, score double")
    want = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert math.isclose(metrics.area_under_roc(df.repartition(5)).first()[0], want)
    assert metrics.area_under_roc(df.filter("label = 1")).first()[0] is None


def test_a_class_that_is_never_predicted_counts_as_zero(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (2.0, 3.0)], "label double, prediction double")
    got = metrics.summary(metrics.confusion_matrix(df)).first()
    assert math.isclose(got["weighted_f1"], MulticlassClassificationEvaluator(metricName="f1").evaluate(df))
    assert math.isclose(got["balanced_accuracy"], 1 / 3)
