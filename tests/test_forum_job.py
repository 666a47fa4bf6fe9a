import csv
import os
import random

from forumlens.plans import forum_job
from forumlens.plans.training import Grid
from forumlens.session import shared_folder
from forumlens.sources.schemas import ANSWERS, QUESTIONS, TAGS

TOPICS = {"java": "class jvm bean", "sql": "select join table", "css": "color margin float"}


def write(path, schema, rows):
    with open(path, "w", newline="") as file:
        writer = csv.writer(file, lineterminator="\n")
        writer.writerow(schema.names)
        writer.writerows(rows)


def test_from_csv_to_metrics(spark, tmp_path):
    chance = random.Random(3)
    questions, answers, tags = [], [], []
    for key in range(150):
        tag = list(TOPICS)[key % 3]
        words = TOPICS[tag].split()
        body = "<p>" + "\n".join(chance.choice(words) for _ in range(6)) + ' "quoted"</p>'
        kind = "please" if key % 5 else "hopeless"
        questions.append((key, "NA", f"20{10 + key % 4}-03-01T00:00:00Z", "NA", 10 + key % 9, kind, body))
        tags.append((key, tag))
        if key % 5:
            answers += [(1000 + key * 3 + i, 1, "2015-01-01T00:00:00Z", key, 0, "yes") for i in range(key % 3 + 1)]
    questions.append(("bad", 1, "NA", "NA", 1, "t", "b"))
    write(tmp_path / "q.csv", QUESTIONS, questions)
    write(tmp_path / "a.csv", ANSWERS, answers)
    write(tmp_path / "t.csv", TAGS, tags)

    store, output = str(tmp_path / "store"), str(tmp_path / "out")
    forum = forum_job.store_forum(
        spark, str(tmp_path / "q.csv"), str(tmp_path / "a.csv"), str(tmp_path / "t.csv"), store
    )
    assert forum.questions.count() == 150 and forum.answers.count() == len(answers)
    assert spark.read.parquet(f"{store}/questions_rejects").count() == 1

    folder = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    forum_job.run(forum, output)
    assert set(os.listdir(folder)) == before
    read = lambda name: spark.read.parquet(f"{output}/{name}")
    assert read("questions_per_year").count() == 4
    assert {tuple(r) for r in read("tag_frequency").collect()} == {(tag, 50) for tag in TOPICS}
    assert read("tag_metrics").first()["weighted_f1"] > 0.9
    assert read("answer_metrics").first()["area_under_roc"] > 0.9
    assert read("likely_tags").filter("rank = 1").count() == read("tag_metrics").first()["rows"]

    grid = Grid(reg_param=(0.01,), elastic_net_param=(0.0, 0.3), max_iter=(5,))
    forum_job.run_answer_prediction(forum, f"{output}/validated", grid=grid, folds=2)
    assert spark.read.parquet(f"{output}/validated/answer_grid").count() == 2
