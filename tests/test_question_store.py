"""Forum tables laid out by question id: same results, no shuffle below the joins, hot questions apart."""

import pytest
from pyspark.sql import functions as F

from forumlens.operators import relations
from forumlens.plans import analyses
from forumlens.session import scratch_path
from forumlens.sources import question_store


def shuffles(df):
    """Shuffles by hash that a run of the plan makes, and how the plan reads."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(params=[1 << 20, 2])
def laid_out(request, spark, forum):
    """With the usual limit no question is hot; with two rows questions 2 and 4 would be from three tags on."""
    return forum, question_store.write_store(*forum, scratch_path(spark, "store"), 3, request.param)


def test_all_reports_are_the_same(laid_out):
    forum, store = laid_out
    plain, stored = analyses.analyse(*forum), analyses.analyse_store(store)
    assert plain.keys() == stored.keys()
    for name in plain:
        assert rows(plain[name]) == rows(stored[name]), name


def test_joins_meet_bucket_by_bucket(spark, no_broadcast, laid_out):
    (questions, answers, tags), store = laid_out
    labelled = store.labelled("score")
    for df, same in (
        (store.answered_questions("score"), relations.answered(questions.select("id", "score"), answers)),
        (store.unanswered_questions("score"), relations.unanswered(questions.select("id", "score"), answers)),
        (labelled, relations.label_answered(questions.select("id", "score"), answers)),
        (store.tagged(labelled), relations.with_tags(relations.label_answered(questions.select("id", "score"), answers), tags)),
        (store.tag_counts(labelled), analyses.tags_per_question(relations.label_answered(questions.select("id", "score"), answers), tags)),
    ):
        assert rows(df) == rows(same.select(df.columns))
        if not store.has_hot:
            n, plan = shuffles(df)
            assert n == 0 and ("SortMergeJoin" in plan or "ShuffledHashJoin" in plan)


def test_hot_questions_are_dealt_apart(spark, no_broadcast):
    questions = spark.range(200).select("id", F.lit(None).cast("timestamp_ntz").alias("creation_date"), F.lit(1).alias("score"))
    tag = F.concat(F.lit("t"), F.xxhash64("id") % 50)
    hot = spark.range(20000, numPartitions=8).select(F.lit(7).cast("long").alias("id"), tag.alias("tag"))
    tags = questions.select("id", tag.alias("tag")).unionByName(hot)
    answers = spark.range(3000).select((F.col("id") % 2).alias("parent_id"))
    store = question_store.write_store(questions, answers, tags, scratch_path(spark, "store"), 4, 1000)
    assert [tuple(r) for r in store.hot_questions.collect()] == [(7,)]
    assert store.hot_tags.count() == 20001 and store.tags.count() == 199
    assert store.answered.count() == 2
    n, plan = shuffles(store.tagged(store.labelled()))
    assert n == 0 and "BroadcastHashJoin" in plan
    assert dict(store.tag_counts(store.questions.select("id")).select("id", "tag_count").collect())[7] == 20001


def test_a_store_opens_in_another_catalog(spark, forum):
    path = scratch_path(spark, "store")
    with pytest.raises(Exception, match="(?i)layout"):
        question_store.open_store(spark, path)
    question_store.write_store(*forum, path, 3, 2)
    question_store.close_store(spark, path)
    store = question_store.open_store(spark, path)
    assert store.buckets == 3 and store.questions.count() == 7
    assert rows(store.all_tags()) == rows(forum[2])
    assert shuffles(store.answered_questions())[0] == 0


def test_null_ids_and_empty_tables(spark, forum):
    questions, answers, tags = forum
    store = question_store.write_store(questions.limit(0), answers.limit(0), tags.limit(0), scratch_path(spark, "store"), 2)
    assert store.tagged(store.labelled("score")).count() == 0
    for name, df in analyses.analyse_store(store).items():
        assert df.count() == (1 if name == "mean_tags_per_question" else 0)
    more = answers.union(spark.createDataFrame([(None,)], "parent_id int"))
    store = question_store.write_store(questions, more, tags, scratch_path(spark, "store"), 2)
    assert rows(store.answered_questions()) == rows(relations.answered(questions.select("id"), answers))
