"""The descriptive analyses, one function each, and all of them together in three passes.

Every function takes DataFrames in the model's names: questions (id, creation_date, score),
answers (parent_id), tags (id, tag; many rows per question).

Tag rows are joined to a scanned or stored table, never to the result of another join on the
same key: the adaptive skew join can split a hot question only in a join of two shuffled inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.operators.relations import answered, label_answered, unanswered, with_tags
from forumlens.operators.selection import tag_counts
from forumlens.session import stored
from forumlens.sources.question_store import QuestionStore
from forumlens.sources.writers import write_result


def _by_count(counts: DataFrame, limit: int | None, value: str = "count") -> DataFrame:
    ordered = counts.orderBy(F.desc(value), F.asc("tag"))
    return ordered if limit is None else ordered.limit(limit)


def _per(questions: DataFrame, key: Column, name: str) -> DataFrame:
    return questions.groupBy(key.alias(name)).agg(F.count("*").alias("count")).orderBy(name)


def questions_per_year(questions: DataFrame) -> DataFrame:
    return _per(questions, F.year("creation_date"), "creation_year")


def questions_per_month(questions: DataFrame) -> DataFrame:
    """Calendar months, all years together."""
    return _per(questions, F.month("creation_date"), "creation_month")


def answered_questions_per_month(questions: DataFrame, answers: DataFrame) -> DataFrame:
    return questions_per_month(answered(questions.select("id", "creation_date"), answers))


def tag_frequency(questions: DataFrame, tags: DataFrame, limit: int | None = None) -> DataFrame:
    """Tag rows per tag; rows with a null tag form a group."""
    return _by_count(tag_counts(with_tags(questions.select("id"), tags)), limit)


def answered_tag_frequency(
    questions: DataFrame, answers: DataFrame, tags: DataFrame, limit: int | None = None
) -> DataFrame:
    ids = stored(answered(questions.select("id"), answers), "answered")
    return tag_frequency(ids, tags, limit)


def unanswered_tag_frequency(
    questions: DataFrame, answers: DataFrame, tags: DataFrame, limit: int | None = None
) -> DataFrame:
    ids = stored(unanswered(questions.select("id"), answers), "unanswered")
    return tag_frequency(ids, tags, limit)


def tag_score_sum(questions: DataFrame, tags: DataFrame, limit: int | None = None) -> DataFrame:
    scored = with_tags(questions.select("id", "score"), tags)
    return _by_count(scored.groupBy("tag").agg(F.sum("score").alias("score_sum")), limit, "score_sum")


def tags_per_question(questions: DataFrame, tags: DataFrame) -> DataFrame:
    """`questions` with the number of their non-null tags, for those that have tag rows.

    Tag rows are counted per id before the join, so a question with very many of them
    is one row by then.
    """
    counts = tags.groupBy("id").agg(F.count("tag").alias("tag_count"))
    return questions.join(counts, "id")


def _histogram(counts: DataFrame) -> DataFrame:
    return (
        counts.groupBy(F.col("tag_count").alias("tags_number"))
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("tags_number"))
    )


def answered_tag_count_histogram(questions: DataFrame, answers: DataFrame, tags: DataFrame) -> DataFrame:
    return _histogram(tags_per_question(answered(questions.select("id"), answers), tags))


def unanswered_tag_count_histogram(questions: DataFrame, answers: DataFrame, tags: DataFrame) -> DataFrame:
    return _histogram(tags_per_question(unanswered(questions.select("id"), answers), tags))


def question_score_tag_count(questions: DataFrame, tags: DataFrame) -> DataFrame:
    """One row per question with tags, by falling score. The id in the order splits equal scores
    over several tasks of the sort."""
    counts = tags_per_question(questions.select("id", "score"), tags)
    return counts.orderBy(F.desc("score"), F.asc("id"))


def mean_tags_per_question(questions: DataFrame, tags: DataFrame) -> DataFrame:
    return tags_per_question(questions.select("id"), tags).agg(F.avg("tag_count").alias("mean_tags"))


def analyse(questions: DataFrame, answers: DataFrame, tags: DataFrame) -> dict[str, DataFrame]:
    """All analyses by name, from three stored aggregates instead of one scan and join for each."""
    labelled = stored(label_answered(questions.select("id", "creation_date", "score"), answers), "labelled")
    return _reports(labelled, with_tags(labelled, tags), tags_per_question(labelled.select("id", "score", "label"), tags))


def analyse_store(store: QuestionStore) -> dict[str, DataFrame]:
    """The same from tables laid out by question id: no join shuffles."""
    labelled = store.labelled("creation_date", "score")
    return _reports(labelled, store.tagged(labelled), store.tag_counts(labelled.select("id", "score", "label")))


def _reports(labelled: DataFrame, tagged: DataFrame, tag_counts_by_id: DataFrame) -> dict[str, DataFrame]:
    calendar = stored(
        labelled.groupBy(F.year("creation_date").alias("year"), F.month("creation_date").alias("month")).agg(
            F.count("*").alias("asked"), F.sum("label").alias("answered")
        ),
        "calendar",
    )
    totals = stored(
        tagged.groupBy("tag").agg(
            F.count("*").alias("all"),
            F.sum("label").alias("answered"),
            F.sum(1 - F.col("label")).alias("unanswered"),
            F.sum("score").alias("score_sum"),
        ),
        "tag-totals",
    )
    counted = stored(tag_counts_by_id, "tag-counts")

    def months(key: str, name: str, measure: str) -> DataFrame:
        sums = calendar.groupBy(F.col(key).alias(name)).agg(F.sum(measure).alias("count"))
        return sums.filter("count > 0").orderBy(name)

    def tag_table(measure: str) -> DataFrame:
        return _by_count(totals.select("tag", F.col(measure).alias("count")).filter("count > 0"), None)

    return {
        "questions_per_year": months("year", "creation_year", "asked"),
        "questions_per_month": months("month", "creation_month", "asked"),
        "answered_questions_per_month": months("month", "creation_month", "answered"),
        "tag_frequency": tag_table("all"),
        "answered_tag_frequency": tag_table("answered"),
        "unanswered_tag_frequency": tag_table("unanswered"),
        "tag_score_sum": _by_count(totals.select("tag", "score_sum"), None, "score_sum"),
        "answered_tag_count_histogram": _histogram(counted.filter("label = 1")),
        "unanswered_tag_count_histogram": _histogram(counted.filter("label = 0")),
        "question_score_tag_count": counted.select("id", "score", "tag_count").orderBy(F.desc("score"), F.asc("id")),
        "mean_tags_per_question": counted.agg(F.avg("tag_count").alias("mean_tags")),
    }


def write_analyses(
    questions: DataFrame,
    answers: DataFrame,
    tags: DataFrame,
    base_path: str,
    *,
    file_format: str = "parquet",
    mode: str = "errorifexists",
    single_files: bool = False,
    store: QuestionStore | None = None,
) -> dict[str, str]:
    """Write every analysis and return its path. With `single_files` the reports, but not the table with
    one row per question, are one file each: only for as many tags as one task can sort. `store` holds the same
    tables laid out by question id, and is read in their place."""
    paths = {}
    reports = analyse(questions, answers, tags) if store is None else analyse_store(store)
    for name, df in reports.items():
        per_question = name == "question_score_tag_count"
        result = df.select("score", "tag_count") if per_question else df
        paths[name] = write_result(
            result, base_path, name, file_format=file_format, mode=mode, single_file=single_files and not per_question
        )
    return paths
