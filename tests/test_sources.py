import csv
import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from forumlens.session import lifetimes, shared_folder
from forumlens.sources import split_csv, writers
from forumlens.sources.forum_csv import convert_to_parquet, load_table
from forumlens.sources.schemas import ANSWERS, QUESTIONS, TAGS
from forumlens.sources.writers import write_result

QUESTION_CSV = '''Id,OwnerUserId,CreationDate,ClosedDate,Score,Title,Body
1,7,2008-08-31T23:57:07Z,NA,26,"A ""quoted"" title","<p>line ""q""
line2, x</p>"
2,NA,2009-01-01T00:00:00Z,2010-05-06T07:08:09Z,10,plain,body
3,5,NA,NA,9,,body only
4,5,yesterday,NA,NA,title only,
x,5,2009-01-01T00:00:00Z,NA,1,bad key,body
'''
ANSWER_CSV = """Id,OwnerUserId,CreationDate,ParentId,Score,Body
10,1,2008-09-01T00:00:00Z,1,3,yes
11,1,2008-09-01T00:00:00Z,NA,3,orphan
NA,1,2008-09-01T00:00:00Z,1,3,no id
"""
TAG_CSV = "Id,Tag\n7,\n8,java\n8,java\n9,NA\n"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("forum")
    (base / "questions.csv").write_text(QUESTION_CSV)
    (base / "answers.csv").write_text(ANSWER_CSV)
    (base / "tags.csv").write_text(TAG_CSV)
    return base


def by_id(df):
    return {row["id"]: row.asDict() for row in df.collect()}


def test_quotes_newlines_and_na(spark, folder):
    rows = by_id(load_table(spark, str(folder / "questions.csv"), QUESTIONS).rows)
    assert sorted(rows) == [1, 2, 3, 4]
    assert rows[1]["body"] == '<p>line "q"\nline2, x</p>'
    assert rows[1]["title"] == 'A "quoted" title'
    assert rows[2]["owner_user_id"] is None
    assert rows[1]["closed_date"] is None
    assert rows[2]["closed_date"] == datetime.datetime(2010, 5, 6, 7, 8, 9)
    assert rows[3]["creation_date"] is None and rows[4]["creation_date"] is None
    assert rows[3]["title"] is None and rows[4]["body"] is None
    assert rows[4]["score"] is None


def test_rows_without_key_are_rejected(spark, folder):
    rejects = load_table(spark, str(folder / "questions.csv"), QUESTIONS).rejects.collect()
    assert [(r["missing_keys"], r["title"]) for r in rejects] == [("id", "bad key")]
    assert rejects[0]["raw_record"].startswith("x,5,")
    answers = load_table(spark, str(folder / "answers.csv"), ANSWERS)
    assert list(by_id(answers.rows)) == [10]
    assert sorted(r["missing_keys"] for r in answers.rejects.collect()) == ["id", "parent_id"]


def test_null_and_literal_na_tags(spark, folder):
    rows = load_table(spark, str(folder / "tags.csv"), TAGS).rows
    assert sorted((r["id"], r["tag"] or "") for r in rows.collect()) == [(7, ""), (8, "java"), (8, "java"), (9, "NA")]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/Los_Angeles"])
def test_month_does_not_depend_on_the_session_zone(spark, folder, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = load_table(spark, str(folder / "questions.csv"), QUESTIONS).rows
        assert rows.filter("id = 1").select(F.month("creation_date")).first()[0] == 8
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_parquet_copy_is_split_and_whole(spark, folder, tmp_path):
    table = load_table(spark, str(folder / "questions.csv"), QUESTIONS)
    convert_to_parquet(table, str(tmp_path / "rows"), str(tmp_path / "rejects"), 3, "id")
    stored = spark.read.parquet(str(tmp_path / "rows"))
    assert sorted(stored.collect(), key=lambda r: r["id"]) == sorted(table.rows.collect(), key=lambda r: r["id"])
    assert spark.read.parquet(str(tmp_path / "rejects")).count() == 1
    assert len(list((tmp_path / "rows").glob("part-*"))) > 1


def test_csv_sink(spark, tmp_path):
    df = spark.range(20).select("id", F.lit(' "x",\n').alias("text")).repartition(4)
    path = write_result(df, str(tmp_path), "report", file_format="csv", single_file=True)
    assert path.endswith("report.csv")
    assert len(list((tmp_path / "report.csv").glob("part-*"))) == 1
    back = spark.read.option("multiLine", True).option("escape", '"').schema("id long, text string").csv(path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    with pytest.raises(Exception, match="(?i)already exists"):
        write_result(df, str(tmp_path), "report", file_format="csv")
    with pytest.raises(ValueError):
        write_result(df, str(tmp_path), "other", file_format="orc")


@pytest.mark.parametrize("split_bytes, ranges", [("134217728", 50000), ("300", 50000), ("61", 50000), ("300", 0)])
def test_split_scan_equals_the_plain_scan(spark, tmp_path, monkeypatch, split_bytes, ranges):
    """Ranges that cut letters, CR LF and records, records longer than many ranges; and states too many to broadcast."""
    monkeypatch.setattr(split_csv, "RANGES", ranges)
    chance = random.Random(7)
    parts = ["a", '"', "\n", ",", "x y", "\r\n", "é", ""]
    for number, line_end in enumerate(["\n", "\r\n"]):
        with open(tmp_path / f"q{number}.csv", "w", newline="") as file:
            writer = csv.writer(file, lineterminator=line_end)
            writer.writerow(QUESTIONS.names)
            for i in range(120):
                body = "".join(chance.choice(parts) for _ in range(chance.choice([0, 3, 40, 200])))
                title = chance.choice(["", "t", '"t"', "a\nb"])
                writer.writerow([chance.choice([i, i, "x"]), chance.choice([1, "NA", ""]), "2009-01-01T00:00:00Z", "NA", 3, title, body])
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        plain = load_table(spark, str(tmp_path), QUESTIONS)
        split = load_table(spark, str(tmp_path), QUESTIONS, split_files=True)
        rows = lambda df: sorted(map(str, df.collect()))
        assert rows(split.rows) == rows(plain.rows)
        assert rows(split.rejects.drop("raw_record")) == rows(plain.rejects.drop("raw_record"))
        assert split.rows.count() + split.rejects.count() == 240
    finally:
        for key, value in keep.items():
            spark.conf.set(key, value)


def test_split_scan_stores_borders_only(spark, tmp_path):
    """No line is shuffled, and no record is written but those that borders cut."""
    with open(tmp_path / "tags.csv", "w") as file:
        file.write("Id,Tag\n" + "".join(f'{i},"{"x" * 80}\n{i}"\n' for i in range(20000)))
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    place = shared_folder(spark).removeprefix("file:")
    before = set(os.listdir(place))
    try:
        with lifetimes(spark):
            rows = load_table(spark, str(tmp_path / "tags.csv"), TAGS, split_files=True).rows
            assert rows.count() == 20000
            made = {n.rsplit("-", 1)[0]: n for n in set(os.listdir(place)) - before}
            assert set(made) == {"csv-ranges", "csv-borders"}
            stored = sum(os.path.getsize(f"{d}/{f}") for n in made.values() for d, _, files in os.walk(f"{place}/{n}") for f in files)
            assert stored < os.path.getsize(tmp_path / "tags.csv") / 20
            lines = split_csv._lines(spark, str(tmp_path / "tags.csv"))
            whole = split_csv._pieces(lines, spark.read.parquet(f"{place}/{made['csv-ranges']}"), cut=False)
            plan = whole._jdf.queryExecution().executedPlan().toString()
            assert "MapInArrow" in plan and "Exchange hashpartitioning" not in plan
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)


def test_split_scan_of_the_fixture(spark, folder):
    for name, schema in (("questions", QUESTIONS), ("answers", ANSWERS), ("tags", TAGS)):
        plain = load_table(spark, str(folder / f"{name}.csv"), schema)
        split = load_table(spark, str(folder / f"{name}.csv"), schema, split_files=True)
        assert sorted(map(str, split.rows.collect())) == sorted(map(str, plain.rows.collect()))
        assert sorted(map(str, split.rejects.collect())) == sorted(map(str, plain.rejects.collect()))


@pytest.mark.parametrize("split_files", [False, True])
def test_ids_beyond_32_bits(spark, tmp_path, split_files):
    (tmp_path / "tags.csv").write_text("Id,Tag\n5000000000,java\n1,sql\n")
    table = load_table(spark, str(tmp_path / "tags.csv"), TAGS, split_files=split_files)
    assert sorted(r["id"] for r in table.rows.collect()) == [1, 5000000000] and table.rejects.count() == 0


def test_split_scan_names_a_file_with_stray_quotes(spark, tmp_path):
    (tmp_path / "tags.csv").write_text('Id,Tag\n1,a\n2,5" disk\n3,b\n4,c\n5,d\n')
    assert load_table(spark, str(tmp_path / "tags.csv"), TAGS).rows.count() == 5
    with pytest.raises(Exception, match="stray quote.*tags.csv"):
        load_table(spark, str(tmp_path / "tags.csv"), TAGS, split_files=True).rows.collect()
    (tmp_path / "open.csv").write_text('Id,Tag\n1,a\n2,"never closed\n3,b\n')
    with pytest.raises(Exception, match="stray quote.*open.csv"):
        load_table(spark, str(tmp_path / "open.csv"), TAGS, split_files=True).rows.collect()


def csv_lines(path):
    (file,) = [f for f in os.listdir(path) if f.startswith("part-") and not f.endswith(".crc")]
    with open(f"{path}/{file}", newline="") as opened:
        return opened.read()


@pytest.mark.parametrize("header", [False, True])
def test_a_sorted_report_is_joined_in_order(spark, tmp_path, header):
    """Many parts of a few rows each; quotes, line breaks, nulls and non-ASCII letters come through."""
    odd = F.when(F.col("id") % 7 == 0, F.lit('a "b", c\nd')).when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.lit("é, 日"))
    df = spark.range(2000, numPartitions=5).select((F.col("id") * 7919 % 2000).alias("key, x"), odd.alias("text")).repartition(6).orderBy("key, x")
    path = writers.write_joined(df, f"{tmp_path}/report", header=header, part_rows=37)
    whole = csv_lines(path)
    read = spark.read.schema("key long, text string").csv(path, multiLine=True, escape='"', header=header).collect()
    assert [r["key"] for r in read] == list(range(2000))
    assert [r["text"] for r in read] == [r["text"] for r in df.collect()]
    assert whole.startswith('"key, x",text\n0,') if header else whole.startswith("0,")
    assert whole.endswith("\n") and not whole.endswith("\n\n")
    manifest = spark.read.json(f"{path}/_manifest").collect()
    assert len(manifest) >= 2000 / 37 and sum(r["bytes"] for r in manifest) == len(whole.encode()) - (len('"key, x",text\n') if header else 0)
    assert sorted(os.listdir(tmp_path)) == ["report"]


def test_a_failed_attempt_leaves_nothing(spark, tmp_path):
    df = spark.range(100, numPartitions=4)
    path = writers.write_joined(df, f"{tmp_path}/report")
    broken = df.select(F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id").cast("string")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        writers.write_joined(broken, f"{tmp_path}/report", mode="overwrite")
    with pytest.raises(Exception, match="lost"):
        writers.write_joined(broken, f"{tmp_path}/other")
    with pytest.raises(FileExistsError):
        writers.write_joined(df, path)
    assert sorted(os.listdir(tmp_path)) == ["report"] and csv_lines(path).count("\n") == 100
    writers.write_joined(df.limit(0), path, mode="overwrite", header=True)
    assert csv_lines(path) == "id\n"
