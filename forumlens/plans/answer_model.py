"""Estimate from its text whether a question will be answered."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.operators.features import question_words
from forumlens.operators.metrics import confusion_matrix, summary
from forumlens.operators.relations import label_answered
from forumlens.operators.selection import balance_classes, class_sizes, falling_score
from forumlens.plans.training import (
    Grid,
    Prepared,
    Settings,
    Validated,
    cross_validate,
    estimator,
    prepare,
    with_run_facts,
)
from forumlens.session import stored

SETTINGS = Settings(num_features=1000, train_percent=70, reg_param=0.00001, elastic_net_param=0.0)
FULL_GRID = Grid(
    reg_param=(0.00001, 0.001, 0.01, 0.1), elastic_net_param=(0.0, 0.1, 0.3, 0.5), max_iter=(10, 20, 40)
)


def _scorer() -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", metricName="areaUnderROC")


@dataclass(frozen=True)
class AnswerModel:
    prepared: Prepared
    model: LogisticRegressionModel

    def predictions(self) -> DataFrame:
        return self.model.transform(self.prepared.test)

    def metrics(self, model: LogisticRegressionModel | None = None) -> DataFrame:
        """One row with the area under the curve of the score and the metrics of the hard prediction."""
        chosen = model or self.model
        scored = chosen.transform(self.prepared.test)
        report = summary(confusion_matrix(scored)).withColumn("area_under_roc", F.lit(_scorer().evaluate(scored)))
        return with_run_facts(report, self.prepared, chosen)

    def cross_validate(self, settings: Settings, grid: Grid = FULL_GRID, folds: int = 5, parallelism: int = 4, **ledger) -> Validated | None:
        """`ledger` and `part` as in `training.cross_validate`."""
        return cross_validate(self.prepared.train, settings, grid, _scorer(), folds, parallelism, **ledger)


def balanced_questions(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """id and label with as many answered questions as unanswered ones, the highest scores first.

    Labels are stored with id and score only; finding the cut reads that narrow table.
    """
    labelled = stored(label_answered(questions.select("id", "score"), answers), "labelled")
    return balance_classes(labelled, falling_score(), F.col("id").cast("bigint")).select("id", "label")


def training_rows(questions: DataFrame, answers: DataFrame, **cleaning) -> DataFrame:
    """One row per chosen question: id, words, label."""
    balanced = stored(balanced_questions(questions, answers), "balanced")
    texts = questions.select("id", "title", "body").join(balanced, "id", "left_semi")
    return question_words(texts, **cleaning).join(balanced, "id")


def train_answer_model(
    questions: DataFrame, answers: DataFrame, settings: Settings = SETTINGS, **cleaning
) -> AnswerModel:
    prepared = prepare(training_rows(questions, answers, **cleaning), settings, index_tags=False)
    class_sizes(prepared.train)
    return AnswerModel(prepared, estimator(settings).fit(prepared.train))
