"""The three forum tables laid out for joins on the question id.

Questions, tags and the ids of answered questions are stored in the same number of buckets of the id's hash, sorted, so that the
joins of the analyses and models meet bucket by bucket and shuffle nothing. A question with more tag rows than a task should take
would make one bucket large: its tag rows are dealt apart, freely, and meet the few rows of such questions by broadcast (at most
`lookup.HOT_SHARE` of them, whatever the size). Answers are only asked for their parents; their rows are stored as they come.

Layout below the folder: questions, tags, answered (bucketed), hot_tags, hot_questions, answers, and last `layout` with the number of
buckets. A folder without `layout` is an unfinished store.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.operators.lookup import ROWS_PER_TASK, hot_keys
from forumlens.operators.relations import answered_ids
from forumlens.session import stored

BUCKETED = ("questions", "tags", "answered")
PLAIN = ("hot_tags", "hot_questions", "answers")


@dataclass(frozen=True)
class QuestionStore:
    questions: DataFrame
    answers: DataFrame
    tags: DataFrame
    answered: DataFrame
    hot_tags: DataFrame
    hot_questions: DataFrame
    buckets: int
    has_hot: bool

    def all_tags(self) -> DataFrame:
        return self.tags.unionByName(self.hot_tags) if self.has_hot else self.tags

    def answered_questions(self, *columns: str) -> DataFrame:
        return self.questions.select("id", *columns).join(self.answered, "id", "left_semi")

    def unanswered_questions(self, *columns: str) -> DataFrame:
        return self.questions.select("id", *columns).join(self.answered, "id", "left_anti")

    def labelled(self, *columns: str) -> DataFrame:
        """Questions with `label`, 1 for those with an answer."""
        known = self.answered.withColumn("has_answer", F.lit(1))
        return self.questions.select("id", *columns).join(known, "id", "left").withColumn("label", F.coalesce("has_answer", F.lit(0))).drop("has_answer")

    def tagged(self, questions: DataFrame) -> DataFrame:
        """One row per question and tag row; `questions` keeps the layout (made by filters, projections and joins of this store)."""
        met = questions.join(self.tags, "id")
        if not self.has_hot:
            return met
        few = F.broadcast(questions.join(F.broadcast(self.hot_questions), "id", "left_semi"))
        return met.unionByName(self.hot_tags.join(few, "id"))

    def tag_counts(self, questions: DataFrame) -> DataFrame:
        """`questions` with the number of their non-null tags, for those that have tag rows."""
        counts = questions.join(self.tags.groupBy("id").agg(F.count("tag").alias("tag_count")), "id")
        if not self.has_hot:
            return counts
        few = questions.join(F.broadcast(self.hot_questions), "id", "left_semi")
        hot = self.hot_tags.groupBy("id").agg(F.count("tag").alias("tag_count"))
        return counts.unionByName(few.join(F.broadcast(hot), "id"))


def _table_name(path: str) -> str:
    return "forum_" + md5(path.encode()).hexdigest()


def _write_bucketed(df: DataFrame, path: str, buckets: int) -> None:
    placed = df.repartition(buckets, "id").sortWithinPartitions("id")
    placed.write.format("parquet").option("path", path).bucketBy(buckets, "id").sortBy("id").saveAsTable(_table_name(path))


def _open_bucketed(spark: SparkSession, path: str, buckets: int) -> DataFrame:
    """The session's catalog may not know the table, or may be another one than the writer's."""
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        place = path.replace("'", "\\'")
        spark.sql(f"create table {name} ({columns}) using parquet clustered by (id) sorted by (id) into {buckets} buckets location '{place}'")
    return spark.table(name)


def write_store(
    questions: DataFrame,
    answers: DataFrame,
    tags: DataFrame,
    path: str,
    buckets: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> QuestionStore:
    """Lay the tables out below `path`. Without `buckets` there are as many as a shuffle has partitions."""
    spark, path = questions.sparkSession, path.rstrip("/")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tags = stored(tags, "tags")  # read for the counts and for both parts
    hot = hot_keys(tags.groupBy("id").agg(F.count("*").alias("rows")), "id", "rows", rows_per_task).select("id")
    hot.coalesce(1).write.parquet(f"{path}/hot_questions")
    hot = F.broadcast(spark.read.schema(hot.schema).parquet(f"{path}/hot_questions"))
    tags.join(hot, "id", "left_semi").write.parquet(f"{path}/hot_tags")
    _write_bucketed(tags.join(hot, "id", "left_anti"), f"{path}/tags", buckets)
    _write_bucketed(questions, f"{path}/questions", buckets)
    answers.write.parquet(f"{path}/answers")
    _write_bucketed(answered_ids(spark.read.schema(answers.schema).parquet(f"{path}/answers")), f"{path}/answered", buckets)
    layout = spark.range(1).select(F.lit(buckets).alias("buckets"))
    layout.coalesce(1).write.parquet(f"{path}/layout")
    return open_store(spark, path)


def open_store(spark: SparkSession, path: str) -> QuestionStore:
    path = path.rstrip("/")
    buckets = spark.read.parquet(f"{path}/layout").first()["buckets"]
    tables = {name: _open_bucketed(spark, f"{path}/{name}", buckets) for name in BUCKETED}
    tables |= {name: spark.read.parquet(f"{path}/{name}") for name in PLAIN}
    return QuestionStore(**tables, buckets=buckets, has_hot=not tables["hot_questions"].isEmpty())


def close_store(spark: SparkSession, path: str) -> None:
    """Forget the tables in the session's catalog; the files stay."""
    for name in BUCKETED:
        spark.sql(f"drop table if exists {_table_name(path.rstrip('/') + '/' + name)}")
