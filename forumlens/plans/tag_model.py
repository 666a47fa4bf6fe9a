"""Rank the most likely tags of a question from its text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.operators.features import question_words
from forumlens.operators.metrics import confusion_matrix, summary
from forumlens.operators.relations import with_tags
from forumlens.operators.selection import frequent_tags, keep_tags, score_filter, top_tags
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

CLUSTER_SETTINGS = Settings(num_features=1000, train_percent=70, reg_param=0.1, elastic_net_param=0.3)
LOCAL_SETTINGS = Settings(num_features=10000, train_percent=80, reg_param=0.01, elastic_net_param=0.3)
FULL_GRID = Grid(reg_param=(0.01,), elastic_net_param=(0.0, 0.1, 0.2, 0.3, 0.4), max_iter=(10,))


@dataclass(frozen=True)
class TagModel:
    prepared: Prepared
    model: LogisticRegressionModel

    @property
    def tags(self) -> list[str]:
        return self.prepared.stages.stages[-1].labels

    def predictions(self) -> DataFrame:
        return self.model.transform(self.prepared.test)

    def metrics(self, model: LogisticRegressionModel | None = None) -> DataFrame:
        """One row; `model` is another model on the same features, such as a cross-validated one."""
        chosen = model or self.model
        report = summary(confusion_matrix(chosen.transform(self.prepared.test)))
        return with_run_facts(report, self.prepared, chosen)

    def cross_validate(self, settings: Settings, grid: Grid = FULL_GRID, folds: int = 5, parallelism: int = 4, **ledger) -> Validated | None:
        """`ledger` and `part` as in `training.cross_validate`."""
        scorer = MulticlassClassificationEvaluator(metricName="f1")
        return cross_validate(self.prepared.train, settings, grid, scorer, folds, parallelism, **ledger)

    def likely_tags(self, per_question: int = 3) -> DataFrame:
        """The most probable tags of every held-out question, best first, also where its own tags do
        not occur in training."""
        return self._ranked(self.prepared.held_out, per_question)

    def rank_tags(self, questions: DataFrame, per_question: int = 3, **cleaning) -> DataFrame:
        """The most probable tags of any questions (id, title, body), which need none of their own."""
        hashing_and_idf = PipelineModel(self.prepared.stages.stages[:-1])
        return self._ranked(hashing_and_idf.transform(question_words(questions, **cleaning)), per_question)

    def _ranked(self, features: DataFrame, per_question: int) -> DataFrame:
        """The probabilities of a question lie in one row and are ranked there; of a question with
        several rows, which have the same features, only ranks are shuffled."""
        candidates = F.transform(
            vector_to_array("probability"), lambda p, i: F.struct(p.alias("p"), (-i).alias("place"))
        )
        best = F.slice(F.sort_array(candidates, asc=False), 1, per_question)
        scored = self.model.transform(features).select("id", best.alias("best")).dropDuplicates(["id"])
        names = F.array(*(F.lit(tag) for tag in self.tags))
        return scored.select("id", F.posexplode("best").alias("pos", "hit")).select(
            "id",
            (F.col("pos") + 1).alias("rank"),
            F.get(names, -F.col("hit.place")).alias("tag"),
            F.col("hit.p").alias("probability"),
        )


def tagged_questions(
    questions: DataFrame,
    tags: DataFrame,
    score_threshold: int = 10,
    top_n: int = 10,
    at_least: int | None = None,
) -> DataFrame:
    """id and tag of questions with a score of at least `score_threshold`, for the `top_n` most
    frequent tags, or for those with `at_least` rows where that is given."""
    scored = score_filter(questions.select("id", "score"), score_threshold)
    tagged = stored(with_tags(scored, tags).select("id", "tag"), "all-tagged")
    wanted = top_tags(tagged, top_n) if at_least is None else frequent_tags(tagged, at_least)
    return keep_tags(tagged, stored(wanted, "wanted-tags"))


def training_rows(
    questions: DataFrame,
    tags: DataFrame,
    score_threshold: int = 10,
    top_n: int = 10,
    at_least: int | None = None,
    **cleaning,
) -> DataFrame:
    """One row per question and tag: id, words, tag. A text is cleaned once, not once per tag,
    and only texts that reach the score leave the scan. A tag row that stands twice trains once,
    so a question has no more rows than there are wanted tags."""
    kept = stored(tagged_questions(questions, tags, score_threshold, top_n, at_least).distinct(), "tagged")
    texts = score_filter(questions, score_threshold).select("id", "title", "body")
    wanted = texts.join(kept.select("id").distinct(), "id", "left_semi")
    return question_words(wanted, **cleaning).join(kept, "id")


def prepare_tags(questions: DataFrame, tags: DataFrame, settings: Settings = CLUSTER_SETTINGS, *selection, **cleaning) -> Prepared:
    """Features and labels of both sides; `selection` and `cleaning` as in `training_rows`."""
    return prepare(training_rows(questions, tags, *selection, **cleaning), settings, index_tags=True)


def train_tag_model(
    questions: DataFrame,
    tags: DataFrame,
    settings: Settings = CLUSTER_SETTINGS,
    score_threshold: int = 10,
    top_n: int = 10,
    at_least: int | None = None,
    **cleaning,
) -> TagModel:
    prepared = prepare_tags(questions, tags, settings, score_threshold, top_n, at_least, **cleaning)
    return TagModel(prepared, estimator(settings).fit(prepared.train))
