"""Clean words of a question and their hashed TF-IDF vectors."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, IDF, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.functions.text import clean_words
from forumlens.operators.stemming import stem_words


def question_words(
    questions: DataFrame,
    *,
    html_replacement: str = "",
    stripped_stopwords: bool = False,
    stemmed: bool = True,
) -> DataFrame:
    """id and the cleaned words of title and body; html is removed from the body only."""
    options = {"html_replacement": html_replacement, "stripped_stopwords": stripped_stopwords}
    words = questions.select(
        "id",
        F.concat(
            clean_words(F.col("title"), html=False, **options),
            clean_words(F.col("body"), html=True, **options),
        ).alias("words"),
    )
    return stem_words(words, "id", "words") if stemmed else words


def clean_corpus(questions: DataFrame, **options) -> DataFrame:
    """Text form of `question_words`: id and the words with single spaces."""
    return question_words(questions, **options).select("id", F.array_join("words", " ").alias("text"))


def term_hashing(num_features: int = 1000) -> HashingTF:
    """words -> term_vector. Nothing is fitted, so it can run before the split."""
    return HashingTF(inputCol="words", outputCol="term_vector", numFeatures=num_features)


def fitted_stages(index_tags: bool = True) -> Pipeline:
    """term_vector -> features, and tag -> label where asked for. A tag unseen in training gets the number after the last."""
    stages = [IDF(inputCol="term_vector", outputCol="features", minDocFreq=0)]
    if index_tags:
        stages.append(
            StringIndexer(
                inputCol="tag", outputCol="label", stringOrderType="frequencyDesc", handleInvalid="keep"
            )
        )
    return Pipeline(stages=stages)
