"""Fits that share their passes against the fits and the cross validation of pyspark.ml."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from forumlens.operators import joint_fits, metrics
from forumlens.operators.joint_fits import Descent
from forumlens.plans import training
from forumlens.plans.ledger import Fit
from forumlens.plans.training import Grid, Settings
from forumlens.session import stored

FEATURES = 12
GRID = Grid(reg_param=(0.00001, 0.1), elastic_net_param=(0.0, 0.5), max_iter=(3, 8))
SETTINGS = Settings(num_features=FEATURES, train_percent=70, reg_param=0.1, elastic_net_param=0.0)


@pytest.fixture(scope="module")
def area(spark):
    return BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", metricName="areaUnderROC")


@pytest.fixture(scope="module")
def placed(spark):
    """Sparse and dense rows, some twice and some empty; a feature that is never there and one that is always the same."""
    random = np.random.default_rng(7)
    rows = []
    for i in range(150):
        x = np.where(random.random(FEATURES) < 0.4, random.integers(1, 4, FEATURES) * 0.7, 0.0)
        x[0], x[1] = 0.0, 0.3
        x = np.zeros(FEATURES) if i % 30 == 0 else x
        label = float(random.random() < 1 / (1 + np.exp(2 - x[2:7].sum())))
        vector = Vectors.dense(x) if i % 7 == 0 else Vectors.sparse(FEATURES, {k: float(x[k]) for k in np.flatnonzero(x)})
        rows += [(i, label, vector)] * (2 if i % 10 == 0 else 1)
    df = spark.createDataFrame(rows, ["id", "label", "features"])
    return stored(df.withColumn("fold", (F.col("id") % 3).cast("int")), "placed")


def test_joint_fits_equal_the_library(placed, monkeypatch):
    monkeypatch.setattr(joint_fits, "CELLS", 20 * FEATURES)  # many blocks
    read = joint_fits.row_blocks(placed, FEATURES).rdd
    moments = joint_fits.fold_moments(read, FEATURES)
    wanted = {Descent(reg, net, 1): [2, 25] for reg, net in ((0.0, 0.0), (0.00001, 0.0), (0.001, 0.5), (0.1, 0.1))}
    found = joint_fits.fitted(read, FEATURES, moments, wanted)
    assert len(found) == 8
    rows = placed.filter("fold <> 1").cache()
    for (descent, rounds), (weights, intercept) in found.items():
        model = LogisticRegression(maxIter=rounds, regParam=descent.reg_param, elasticNetParam=descent.elastic_net_param).fit(rows)
        assert weights == pytest.approx(model.coefficients.toArray(), rel=1e-6, abs=1e-8)
        assert intercept == pytest.approx(model.intercept, rel=1e-6, abs=1e-8)


def test_a_grid_by_area_shares_its_passes(placed, area, tmp_path, monkeypatch):
    """One fit of its own, for the best point; as many passes as the longest descent asks for, not as many as all together."""
    made, passes = [], []
    fit, loss = LogisticRegression.fit, joint_fits.loss_and_gradient
    monkeypatch.setattr(LogisticRegression, "fit", lambda self, df, *rest: made.append(1) or fit(self, df, *rest))
    monkeypatch.setattr(joint_fits, "loss_and_gradient", lambda *a: passes.append(len(a[4])) or loss(*a))
    monkeypatch.setattr(training, "fold", lambda column, folds, seed: (F.col(column) % folds).cast("int"))
    train = placed.drop("fold")
    result = training.cross_validate(train, SETTINGS, GRID, area, 3, ledger=str(tmp_path / "book"))
    assert len(made) == 1 and passes[0] == 12 and len(passes) < 40
    again = training.cross_validate(train, SETTINGS, GRID, area, 3, ledger=str(tmp_path / "book"))
    assert len(made) == 2 and sorted(again.grid.collect()) == sorted(result.grid.collect())
    monkeypatch.undo()

    regression = LogisticRegression()
    points = ParamGridBuilder().addGrid(regression.regParam, GRID.reg_param).addGrid(regression.elasticNetParam, GRID.elastic_net_param).addGrid(regression.maxIter, GRID.max_iter).build()
    validator = CrossValidator(estimator=regression, estimatorParamMaps=points, evaluator=area, numFolds=3, foldCol="fold", parallelism=4)
    expected = validator.fit(placed).avgMetrics
    found = {tuple(r)[:3]: r["avg_metric"] for r in result.grid.collect()}
    assert len(found) == len(points) == 8
    for point, metric in zip(points, expected):
        assert found[point[regression.regParam], point[regression.elasticNetParam], point[regression.maxIter]] == pytest.approx(metric, abs=1e-9)


def test_groups_of_descents_give_the_same(placed, monkeypatch):
    fits = [Fit(0, reg, 0.0, 5, fold) for reg in (0.01, 0.1) for fold in range(3)]
    whole = list(training.areas_together(placed, fits))
    monkeypatch.setattr(joint_fits, "COEFFICIENTS", 2 * (FEATURES + 1))
    groups = list(training.areas_together(placed, fits))
    assert len(whole) == 1 and [len(g) for g in groups] == [2, 2, 2]
    assert {k: v for g in groups for k, v in g.items()} == pytest.approx(whole[0])


def test_folds_that_lack_a_class_and_other_labels_are_left_to_single_fits(placed):
    fits = [Fit(0, 0.1, 0.0, 2, fold) for fold in range(4)]
    ones = placed.filter("fold <> 2 or label = 1")  # fold 2 has no 0, fold 3 no rows
    assert [sorted(f.fold for f in group) for group in training.areas_together(ones, fits)] == [[0, 1]]
    assert list(training.areas_together(placed.withColumn("label", F.col("label") + 1), fits)) == []
    assert not training.by_area(BinaryClassificationEvaluator(metricName="areaUnderPR"))


def test_area_by_group(spark):
    rows = [(k, float(i % 2), float((i * 7 + k) % 5)) for k in range(3) for i in range(20 + k)]
    scored = spark.createDataFrame(rows, "model int, label double, score double")
    found = {r["model"]: r["area_under_roc"] for r in metrics.area_under_roc(scored, "label", "score", "model").collect()}
    assert len(found) == 3
    for k, area in found.items():
        assert area == pytest.approx(metrics.area_under_roc(scored.filter(F.col("model") == k)).first()[0])
