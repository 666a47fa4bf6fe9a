"""Answered and unanswered questions, and questions with their tags.

Answers are reduced to distinct parent ids before a join, so a question with very many
answers is one row by the time it is shuffled to its partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def answered_ids(answers: DataFrame) -> DataFrame:
    return answers.select(F.col("parent_id").alias("id")).filter("id is not null").distinct()


def answered(questions: DataFrame, answers: DataFrame) -> DataFrame:
    return questions.join(answered_ids(answers), "id", "left_semi")


def unanswered(questions: DataFrame, answers: DataFrame) -> DataFrame:
    return questions.join(answered_ids(answers), "id", "left_anti")


def label_answered(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """`label` is 1 for a question with an answer and 0 for one without."""
    parents = answered_ids(answers).withColumn("has_answer", F.lit(True))
    return (
        questions.join(parents, "id", "left")
        .withColumn("label", F.when(F.col("has_answer").isNotNull(), 1).otherwise(0))
        .drop("has_answer")
    )


def answered_union_unanswered(questions: DataFrame, answers: DataFrame) -> DataFrame:
    ones = answered(questions, answers).withColumn("label", F.lit(1))
    zeros = unanswered(questions, answers).withColumn("label", F.lit(0))
    return ones.unionByName(zeros)


def with_tags(questions: DataFrame, tags: DataFrame) -> DataFrame:
    """One row per question and tag row. Rows go on to a group by another key or to the caller,
    so the adaptive skew join is free to split the tag rows of a hot question."""
    return questions.join(tags, "id")
