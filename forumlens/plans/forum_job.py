"""The whole job: forum CSV files to stored tables, then the analyses and both classifiers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from forumlens.plans import analyses, answer_model, tag_model
from forumlens.plans.training import Grid, Settings
from forumlens.session import lifetimes, scratch_removed
from forumlens.sources.forum_csv import load_table
from forumlens.sources.question_store import QuestionStore, write_store
from forumlens.sources.schemas import ANSWERS, QUESTIONS, TAGS
from forumlens.sources.writers import write_result


@dataclass(frozen=True)
class Forum:
    questions: DataFrame
    answers: DataFrame
    tags: DataFrame
    layout: QuestionStore | None = None


def store_forum(
    spark: SparkSession,
    questions_path: str,
    answers_path: str,
    tags_path: str,
    store: str,
    *,
    split_files: bool = True,
    buckets: int | None = None,
) -> Forum:
    """Convert the three CSV tables to Parquet below `store`, laid out by question id, rejects apart, and open the copies."""
    tables = {}
    for name, path, schema in (
        ("questions", questions_path, QUESTIONS),
        ("answers", answers_path, ANSWERS),
        ("tags", tags_path, TAGS),
    ):
        table = load_table(spark, path, schema, split_files=split_files)
        table.rejects.write.parquet(f"{store}/{name}_rejects")
        tables[name] = table.rows
    with lifetimes(spark):
        layout = write_store(*tables.values(), store, buckets)
    return opened(layout)


def opened(layout: QuestionStore) -> Forum:
    """A forum over a store that stands already (`question_store.open_store`)."""
    return Forum(layout.questions, layout.answers, layout.all_tags(), layout)


def run_tag_prediction(
    forum: Forum,
    output: str,
    settings: Settings = tag_model.CLUSTER_SETTINGS,
    grid: Grid | None = None,
    folds: int = 5,
    **options,
) -> tag_model.TagModel:
    """Train, then write the metrics and the likely tags, and with a grid the cross validation.

    The fits of the grid stand in a ledger beside the results: a run that is started again makes only those missing.
    """
    model = tag_model.train_tag_model(forum.questions, forum.tags, settings, **options)
    write_result(model.metrics(), output, "tag_metrics")
    write_result(model.likely_tags(), output, "likely_tags")
    _write_validation(model, output, "tag", settings, grid, folds)
    return model


def run_answer_prediction(
    forum: Forum,
    output: str,
    settings: Settings = answer_model.SETTINGS,
    grid: Grid | None = None,
    folds: int = 5,
    **options,
) -> answer_model.AnswerModel:
    """Train, then write the metrics, and with a grid the cross validation."""
    model = answer_model.train_answer_model(forum.questions, forum.answers, settings, **options)
    write_result(model.metrics(), output, "answer_metrics")
    _write_validation(model, output, "answer", settings, grid, folds)
    return model


def _write_validation(model, output: str, name: str, settings: Settings, grid: Grid | None, folds: int) -> None:
    if grid is None:
        return
    validated = model.cross_validate(settings, grid, folds, ledger=f"{output.rstrip('/')}/{name}_ledger")
    write_result(validated.grid, output, f"{name}_grid")
    write_result(model.metrics(validated.best), output, f"{name}_best_metrics")


def run(forum: Forum, output: str) -> None:
    """Analyses and both predictions, without cross validation. Its scratch tables are gone when it ends."""
    with scratch_removed(forum.questions.sparkSession):
        analyses.write_analyses(forum.questions, forum.answers, forum.tags, output, store=forum.layout)
        run_tag_prediction(forum, output)
        run_answer_prediction(forum, output)
