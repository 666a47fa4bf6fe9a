import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forumlens.operators import selection, splitting

BIG = 2**63 - 1


def ids(df):
    return sorted(row["id"] for row in df.collect())


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.one_of(st.integers(-5, 5), st.integers(-BIG, BIG)), min_size=1, max_size=80),
    st.data(),
)
def test_cut_equals_sorting(spark, values, data):
    k = data.draw(st.integers(1, len(values)))
    df = spark.createDataFrame([(v,) for v in values], "v long")
    cut = selection.find_cut(df, F.col("v"), k)
    value = sorted(values)[k - 1]
    assert (cut.value, cut.below, cut.equal) == (value, sum(v < value for v in values), values.count(value))


@pytest.mark.parametrize("k", [0, 1, 7, 500, 999, 1000, 2000])
def test_highest_scores_equal_sorting(spark, k):
    chance = random.Random(k)
    rows = [(i * 70000 - 9, None if i % 50 == 0 else chance.choice([0, 0, 0, 5, -3, 40])) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, score int").repartition(5)
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))[:k]
    assert ids(selection.highest_scores(df, k)) == sorted(r[0] for r in want)


def test_ambiguous_cut_is_refused(spark):
    df = spark.createDataFrame([(1, 5), (1, 5), (2, 5)], "id long, score int")
    with pytest.raises(ValueError, match="apart"):
        selection.highest_scores(df, 1)


def test_balanced_classes_do_not_depend_on_partitions(spark):
    rows = [(i, i % 4, 1) for i in range(50)] + [(100 + i, 9, 0) for i in range(8)]
    df = spark.createDataFrame(rows, "id long, score int, label int")
    keys = (selection.falling_score(), F.col("id"))
    results = [ids(selection.balance_classes(df.repartition(n), *keys)) for n in (1, 3, 7)]
    assert results[0] == results[1] == results[2]
    balanced = selection.balance_classes(df, *keys)
    assert selection.class_sizes(balanced) == {0: 8, 1: 8}
    assert {r["score"] for r in balanced.filter("label = 1").collect()} == {3}


def test_one_class_is_refused(spark):
    df = spark.createDataFrame([(1, 1, 1), (2, 2, 1)], "id long, score int, label int")
    with pytest.raises(ValueError, match="both classes"):
        selection.balance_classes(df, F.col("id"))


def test_tags_by_rank_and_by_number(spark, forum):
    _, _, tags = forum
    assert [tuple(r) for r in selection.top_tags(tags, 2).collect()] == [("java", 5), ("sql", 3)]
    tie = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c")], "id int, tag string")
    assert [r["tag"] for r in selection.top_tags(tie, 2).collect()] == ["a", "b"]
    assert sorted(r["tag"] for r in selection.frequent_tags(tags, 3).collect()) == ["java", "sql"]
    kept = selection.keep_tags(tags, selection.tag_counts(tags))
    assert kept.filter("tag is null").count() == 0 and kept.count() == tags.count() - 1


def test_score_filter_is_inclusive_and_drops_null(forum):
    questions, _, _ = forum
    assert ids(selection.score_filter(questions)) == [1, 3, 4, 6]


def test_split_and_folds_depend_on_the_id_alone(spark):
    df = spark.range(2000).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    train, test = splitting.hash_split(df, "id", 80)
    again, _ = splitting.hash_split(df.repartition(7), "id", 80)
    assert ids(train) == ids(again)
    assert set(ids(train)) & set(ids(test)) == set()
    assert train.count() + test.count() == 4000
    assert 0.77 < train.count() / 4000 < 0.83
    folds = train.select("id", splitting.fold("id", 5).alias("fold")).distinct().groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in folds) == [0, 1, 2, 3, 4]
    assert min(r["count"] for r in folds) > 250
