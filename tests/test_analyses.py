from pyspark.sql import functions as F

from forumlens.operators import relations
from forumlens.plans import analyses


def pairs(df):
    return [tuple(row) for row in df.collect()]


def test_activity(forum):
    questions, answers, _ = forum
    assert pairs(analyses.questions_per_year(questions)) == [(None, 1), (2008, 1), (2009, 2), (2010, 2), (2011, 1)]
    assert pairs(analyses.questions_per_month(questions)) == [(None, 1), (1, 1), (2, 3), (8, 2)]
    assert pairs(analyses.answered_questions_per_month(questions, answers)) == [(1, 1), (2, 1), (8, 2)]


def test_tags(forum):
    questions, answers, tags = forum
    assert pairs(analyses.tag_frequency(questions, tags)) == [("java", 4), ("sql", 3), ("c", 2), (None, 1)]
    assert pairs(analyses.tag_frequency(questions, tags, limit=1)) == [("java", 4)]
    assert pairs(analyses.answered_tag_frequency(questions, answers, tags)) == [("java", 3), ("sql", 3), (None, 1)]
    assert pairs(analyses.unanswered_tag_frequency(questions, answers, tags)) == [("c", 2), ("java", 1)]
    assert pairs(analyses.tag_score_sum(questions, tags)) == [("java", 58), ("sql", 34), ("c", 30), (None, 12)]


def test_tag_counts(forum):
    questions, answers, tags = forum
    assert pairs(analyses.answered_tag_count_histogram(questions, answers, tags)) == [(2, 2), (1, 2)]
    assert pairs(analyses.unanswered_tag_count_histogram(questions, answers, tags)) == [(2, 1), (1, 1)]
    per_question = pairs(analyses.question_score_tag_count(questions, tags))
    assert per_question == [(4, 30, 2), (3, 12, 1), (6, 12, 1), (1, 10, 2), (2, 9, 2), (5, None, 1)]
    assert analyses.mean_tags_per_question(questions, tags).first()[0] == 1.5


def test_joint_run_equals_the_single_analyses(spark, forum, tmp_path):
    questions, answers, tags = forum
    joint = analyses.analyse(questions, answers, tags)
    assert pairs(joint["questions_per_year"]) == pairs(analyses.questions_per_year(questions))
    assert pairs(joint["questions_per_month"]) == pairs(analyses.questions_per_month(questions))
    for name in (
        "answered_tag_frequency",
        "unanswered_tag_frequency",
        "answered_tag_count_histogram",
        "unanswered_tag_count_histogram",
    ):
        assert pairs(joint[name]) == pairs(getattr(analyses, name)(questions, answers, tags)), name
    for name in ("tag_frequency", "tag_score_sum", "question_score_tag_count", "mean_tags_per_question"):
        assert pairs(joint[name]) == pairs(getattr(analyses, name)(questions, tags)), name
    paths = analyses.write_analyses(questions, answers, tags, str(tmp_path), file_format="csv")
    assert set(paths) == set(joint)
    assert spark.read.csv(paths["answered_tag_frequency"]).count() == 3
    assert len(spark.read.csv(paths["question_score_tag_count"]).columns) == 2


def test_answered_and_unanswered_make_up_the_questions(forum):
    questions, answers, _ = forum
    ids = lambda df: sorted(r["id"] for r in df.collect())
    parts = ids(relations.answered(questions, answers)) + ids(relations.unanswered(questions, answers))
    assert sorted(parts) == ids(questions)
    labelled = {r["id"]: r["label"] for r in relations.label_answered(questions, answers).collect()}
    assert labelled == {1: 1, 2: 1, 3: 1, 4: 0, 5: 0, 6: 1, 7: 0}
    union = relations.answered_union_unanswered(questions, answers)
    assert {r["id"]: r["label"] for r in union.collect()} == labelled


def test_histogram_weighs_up_to_the_tag_rows(forum):
    questions, answers, tags = forum
    tags = tags.filter("tag is not null")
    histogram = analyses.answered_tag_count_histogram(questions, answers, tags)
    total = histogram.agg(F.sum(F.col("tags_number") * F.col("count"))).first()[0]
    assert total == analyses.answered_tag_frequency(questions, answers, tags).agg(F.sum("count")).first()[0]
