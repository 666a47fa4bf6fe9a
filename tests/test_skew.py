"""One key holds a third of all rows or more."""

import pytest
from pyspark.sql import functions as F

from forumlens.plans import analyses, tag_model


@pytest.fixture
def big_table_settings(spark):
    """No broadcast, and skew limits that small test tables reach."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.fixture
def hot_forum(spark):
    """Question 7 has 20000 of 22000 tag rows and most of the answers."""
    questions = spark.range(2000).select(
        "id",
        F.lit("2009-01-01").cast("timestamp_ntz").alias("creation_date"),
        F.lit(10).alias("score"),
        F.lit(None).cast("string").alias("title"),
        F.concat(F.lit("word"), F.col("id") % 10).alias("body"),
    )
    tag = F.concat(F.lit("t"), F.xxhash64("id") % 50)
    hot = spark.range(20000, numPartitions=8).select(F.lit(7).cast("long").alias("id"), tag.alias("tag"))
    tags = questions.select("id", tag.alias("tag")).unionByName(hot)
    answers = spark.range(30000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 1000).alias("parent_id"))
    return questions, answers, tags


def run(df):
    rows = [tuple(row) for row in df.collect()]
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_hot_question_is_split_in_the_tag_joins(spark, big_table_settings, hot_forum):
    questions, answers, tags = hot_forum
    for df in (
        analyses.tag_frequency(questions, tags),
        analyses.tag_score_sum(questions, tags),
        analyses.answered_tag_frequency(questions, answers, tags),
    ):
        _, plan = run(df)
        assert "skew=true" in plan
    rows, _ = run(analyses.tag_frequency(questions, tags))
    assert sum(n for _, n in rows) == 22000
    answered = {r["parent_id"] for r in answers.distinct().collect()}
    want = dict(tags.filter(F.col("id").isin(answered)).groupBy("tag").count().collect())
    assert dict(run(analyses.answered_tag_frequency(questions, answers, tags))[0]) == want


def test_hot_question_is_one_row_where_tags_are_counted(big_table_settings, hot_forum):
    questions, answers, tags = hot_forum
    counts, plan = run(analyses.question_score_tag_count(questions, tags))
    assert (7, 10, 20001) in counts and len(counts) == 2000
    assert plan.index("partial_count(tag") > 0


def test_hot_question_trains_once_per_tag(spark, big_table_settings, hot_forum):
    questions, _, tags = hot_forum
    rows = tag_model.training_rows(questions, tags, top_n=5)
    per_question = rows.groupBy("id").count().agg(F.max("count")).first()[0]
    assert per_question <= 5
    assert rows.filter("id = 7").count() == 5
