"""Cross validation over a ledger: restarts, shared parts, means."""

import os

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from forumlens.operators.splitting import fold
from forumlens.plans import ledger as ledgers
from forumlens.plans import training
from forumlens.plans.training import Grid, Settings

SETTINGS = Settings(num_features=3, train_percent=70, reg_param=0.1, elastic_net_param=0.0)
GRID = Grid(reg_param=(0.01, 0.5), elastic_net_param=(0.0, 0.5), max_iter=(5,))


@pytest.fixture(scope="module")
def train(spark):
    value = F.array([(F.xxhash64(F.lit(k), "id") % 100 / 50 + F.when(F.col("label") == k % 2, 0.4).otherwise(0.0)) for k in range(3)])
    rows = spark.range(120).withColumn("label", (F.col("id") % 2).cast("double"))
    return rows.select("id", "label", array_to_vector(value).alias("features"))


def counted(monkeypatch, fail_after=None):
    """The fits that are made; after `fail_after` of them every one fails."""
    made = []
    fit = training.LogisticRegression.fit

    def watched(self, df, *rest):
        if fail_after is not None and len(made) >= fail_after:
            raise RuntimeError("lost")
        made.append(self.getRegParam())
        return fit(self, df, *rest)

    monkeypatch.setattr(training.LogisticRegression, "fit", watched)
    return made


def validate(train, path, **options):
    return training.cross_validate(train, SETTINGS, GRID, MulticlassClassificationEvaluator(metricName="f1"), 3, ledger=path, **options)


def test_a_stopped_run_goes_on_with_the_missing_fits(train, tmp_path, monkeypatch):
    path = str(tmp_path / "book")
    with monkeypatch.context() as patch:
        made = counted(patch, fail_after=7)
        with pytest.raises(RuntimeError, match="lost"):
            validate(train, path, parallelism=2)
        assert len(made) == 7 and len(os.listdir(f"{path}/fits")) == 7
    os.makedirs(f"{path}/fits/reg=0.5-net=0.5-iter=5-fold=2/_temporary/0", exist_ok=True)  # as a killed write leaves it
    with monkeypatch.context() as patch:
        made = counted(patch)
        result = validate(train, path)
        assert len(made) == 12 - 7 + 1  # and the best on all rows
    with monkeypatch.context() as patch:
        made = counted(patch)
        again = validate(train, path)
        assert len(made) == 1 and sorted(again.grid.collect()) == sorted(result.grid.collect())
    whole = validate(train, str(tmp_path / "other"))
    assert sorted(whole.grid.collect()) == sorted(result.grid.collect())


def test_means_equal_the_cross_validator(train, tmp_path):
    found = {tuple(r)[:3]: r["avg_metric"] for r in validate(train, str(tmp_path / "book")).grid.collect()}
    regression = training.estimator(SETTINGS)
    points = ParamGridBuilder().addGrid(regression.regParam, [0.01, 0.5]).addGrid(regression.elasticNetParam, [0.0, 0.5]).addGrid(regression.maxIter, [5]).build()
    validator = CrossValidator(estimator=regression, estimatorParamMaps=points, evaluator=MulticlassClassificationEvaluator(metricName="f1"), numFolds=3, foldCol="fold")
    fitted = validator.fit(train.withColumn("fold", fold("id", 3, SETTINGS.seed)))
    for point, metric in zip(points, fitted.avgMetrics):
        assert found[point[regression.regParam], point[regression.elasticNetParam], point[regression.maxIter]] == pytest.approx(metric, abs=1e-9)


def test_jobs_share_a_ledger(train, tmp_path, monkeypatch):
    path = str(tmp_path / "book")
    made = counted(monkeypatch)
    assert validate(train, path, part=(0, 2)) is None and len(made) == 6
    assert validate(train, path, part=(1, 2)).grid.count() == 4 and len(made) == 13


def test_a_ledger_of_other_data_is_refused(train, tmp_path):
    path = str(tmp_path / "book")
    training.open_ledger(train, SETTINGS, 3, path)
    training.open_ledger(train, SETTINGS, 3, path)
    for other, folds in ((train.limit(100), 3), (train, 4)):
        with pytest.raises(ValueError, match="belongs to other data"):
            training.open_ledger(other, SETTINGS, folds, path)


def test_means_over_given_ledgers(spark):
    rows = [(0, 0, 0.5), (0, 1, 0.75), (1, 0, 0.75), (1, 1, 0.5), (2, 0, 0.99)]
    fits = spark.createDataFrame(rows, "point int, fold int, metric double")
    means = {r["point"]: (r["folds"], r["avg_metric"] and round(r["avg_metric"], 9), r["best"]) for r in ledgers.grid_means(fits, "point", folds=2).collect()}
    assert means == {0: (2, 0.625, True), 1: (2, 0.625, False), 2: (1, None, False)}
    assert ledgers.grid_means(fits.limit(0), "point", folds=2).count() == 0


def test_fits_share_the_memory_of_the_executors(spark, train, tmp_path, monkeypatch):
    assert training.fits_at_once(train, 4) == 4 and training.storage_memory(spark) > 1 << 30
    ran = []
    monkeypatch.setattr(ledgers.Ledger, "run", lambda self, fits, make, parallelism, part: ran.append(parallelism))
    held = train.agg(F.sum(F.size(F.unwrap_udt("features")["values"]) * 12 + 32)).first()[0]
    for memory in (0, held, 2 * held, 100 * held):
        monkeypatch.setattr(training, "storage_memory", lambda spark, memory=memory: memory)
        assert validate(train, str(tmp_path / f"ledger{memory}"), parallelism=3) is None
    assert ran == [1, 1, 2, 3]
