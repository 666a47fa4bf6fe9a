import pytest
from pyspark.sql import functions as F

from forumlens.operators.splitting import hash_split
from forumlens.plans import answer_model, tag_model
from forumlens.plans.training import Grid, Settings

WORDS = {"java": "class jvm bean", "sql": "select join table", "css": "color margin float"}
GRID = Grid(reg_param=(0.01, 0.1), elastic_net_param=(0.0,), max_iter=(5, 10))


@pytest.fixture(scope="module")
def corpus(spark):
    rows, tags = [], []
    for n, (tag, words) in enumerate(WORDS.items()):
        vocabulary = words.split()
        for i in range(30):
            key = n * 100 + i
            body = " ".join(vocabulary[(i + j) % 3] for j in range(5))
            rows.append((key, "<b>Question</b>", f"<p>{body}</p>", 10 + i % 3))
            tags.append((key, tag))
    rows.append((900, "low score", "class", 9))
    tags += [(900, "java"), (5, "sql"), (105, "java")]
    questions = spark.createDataFrame(rows, "id int, title string, body string, score int")
    return questions, spark.createDataFrame(tags, "id int, tag string")


@pytest.fixture(scope="module")
def trained(corpus):
    return tag_model.train_tag_model(*corpus, top_n=3)


def test_tag_model_separates_the_corpus(trained):
    report = trained.metrics().first()
    assert report["weighted_f1"] > 0.85 and report["accuracy"] > 0.85
    assert report["skipped_rows"] == 0
    assert (report["reg_param"], report["elastic_net_param"], report["max_iter"]) == (0.1, 0.3, 10)


def test_likely_tags_are_the_three_tags_in_order(trained):
    rows = trained.likely_tags(3).collect()
    held_out = {r["id"] for r in trained.prepared.test.collect()}
    assert {r["id"] for r in rows} == held_out and len(rows) == 3 * len(held_out)
    by_id = {}
    for row in sorted(rows, key=lambda r: (r["id"], r["rank"])):
        by_id.setdefault(row["id"], []).append(row)
    own = list(WORDS)
    for key, ranked in by_id.items():
        assert sorted(r["tag"] for r in ranked) == sorted(WORDS)
        assert [r["probability"] for r in ranked] == sorted((r["probability"] for r in ranked), reverse=True)
        assert ranked[0]["tag"] == own[key // 100]


def test_a_question_is_never_on_both_sides(trained, corpus):
    train = {r["id"] for r in trained.prepared.train.select("id").collect()}
    test = {r["id"] for r in trained.prepared.test.select("id").collect()}
    assert not train & test
    assert 900 not in train | test


def test_cross_validation_reports_the_whole_grid(trained):
    result = trained.cross_validate(tag_model.CLUSTER_SETTINGS, GRID, folds=3)
    rows = result.grid.collect()
    assert len(rows) == 4 and sum(r["best"] for r in rows) == 1
    best = next(r for r in rows if r["best"])
    assert best["avg_metric"] == max(r["avg_metric"] for r in rows)
    assert trained.metrics(result.best).first()["max_iter"] == best["max_iter"]


def test_tags_unseen_in_training_are_skipped(spark, corpus):
    questions, tags = corpus
    _, held_out = hash_split(questions, "id")
    key = held_out.filter("id < 900").select(F.min("id")).first()[0]
    tags = tags.filter(F.col("id") != key).unionByName(spark.createDataFrame([(key, "rare")], "id int, tag string"))
    model = tag_model.train_tag_model(questions, tags, top_n=10)
    assert "rare" not in model.tags
    assert model.metrics().first()["skipped_rows"] == 1
    ranked = {r["id"] for r in model.likely_tags().collect()}
    assert key in ranked and ranked == {r["id"] for r in model.prepared.held_out.collect()}
    untagged = spark.createDataFrame([(1, "select", "a table", None), (2, None, None, 1)], "id int, title string, body string, score int")
    best = {r["id"]: r["tag"] for r in model.rank_tags(untagged).filter("rank = 1").collect()}
    assert best[1] == "sql" and set(best) == {1, 2}


def test_answer_model_needs_and_learns_two_classes(spark):
    rows = [(i, f"topic{i % 3} good" if i % 2 else f"topic{i % 3} bad", i % 7) for i in range(120)]
    questions = spark.createDataFrame(rows, "id int, body string, score int").withColumn("title", F.lit(None).cast("string"))
    answers = questions.filter("id % 2 = 1").select(F.col("id").alias("parent_id"))
    model = answer_model.train_answer_model(questions, answers)
    report = model.metrics().first()
    assert report["area_under_roc"] > 0.95 and report["balanced_accuracy"] > 0.95
    result = model.cross_validate(answer_model.SETTINGS, GRID, folds=3)
    assert result.grid.count() == 4
    everything = questions.select(F.col("id").alias("parent_id"))
    with pytest.raises(ValueError, match="both classes"):
        answer_model.train_answer_model(questions, everything)


def test_tags_by_number_of_rows(corpus):
    kept = tag_model.tagged_questions(*corpus, at_least=31)
    assert {r["tag"] for r in kept.select("tag").distinct().collect()} == {"java", "sql"}


def test_parameter_sets():
    assert len(tag_model.FULL_GRID.elastic_net_param) == 5
    grid = answer_model.FULL_GRID
    assert len(grid.reg_param) * len(grid.elastic_net_param) * len(grid.max_iter) == 48
    assert tag_model.LOCAL_SETTINGS == Settings(10000, 80, 0.01, 0.3)
